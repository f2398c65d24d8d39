"""Sales-cycle arithmetic on an integer cycle index.

A cycle is written ``YYYYCC`` with 18 cycles per year.  Inside the engine it is
``index = year * 18 + cc - 1``, so shifting, ordering and distance are plain
integer operations that stay inside generated code and hold across years.

Sets of cycles inside one history window (at most 24 cycles) travel as bits of
a long: a distinct count of cycles becomes ``bit_count(bit_or(..))``, which
combines on the map side and needs no second shuffle, and "listed *and*
ordered" becomes a bitwise AND instead of a join that multiplies rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlens.params import CYCLES_PER_YEAR

Cols = Column | str


def _c(value: Cols) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- text <-> index ----------------------------------------------------------
def parse_cycle(text: Cols) -> Column:
    """``'200110'`` -> index; null or malformed text -> 0."""
    text = _c(text)
    year = F.substring(text, 1, 4).try_cast("int")
    number = F.regexp_replace(F.substring(text, 5, 10), "^0", "").try_cast("int")
    index = year * CYCLES_PER_YEAR + number - 1
    return F.coalesce(index, F.lit(0)).cast("int")


def format_cycle(index: Cols) -> Column:
    """Index -> ``YYYYCC`` text."""
    index = _c(index)
    year = F.floor(index / CYCLES_PER_YEAR).cast("int").cast("string")
    number = (index % CYCLES_PER_YEAR + 1).cast("string")
    return F.concat(year, F.lpad(number, 2, "0"))


def cycle_text(index: int) -> str:
    """Driver-side counterpart of :func:`format_cycle` for run parameters."""
    return f"{index // CYCLES_PER_YEAR}{index % CYCLES_PER_YEAR + 1:02d}"


def cycle_distance(a: Cols, b: Cols) -> Column:
    """Absolute number of cycles between two indexes."""
    return F.abs(_c(a) - _c(b))


def shift_cycle(index: Cols, n: int) -> Column:
    return _c(index) + F.lit(n)


# ---- dates -------------------------------------------------------------------
def cycle_of_date(date: Cols) -> Column:
    """Cycle index of a date: the year cut in 18 equal parts of 366 days."""
    date = _c(date)
    part = F.floor((F.dayofyear(date) - 1) * CYCLES_PER_YEAR / F.lit(366))
    return (F.year(date) * CYCLES_PER_YEAR + part).cast("int")


def first_date(index: int) -> dt.date:
    """First calendar day of a cycle, so cycle ranges become date ranges that a
    parquet scan can use to skip files and row groups."""
    year, number = divmod(index, CYCLES_PER_YEAR)
    return dt.date(year, 1, 1) + dt.timedelta(days=-(-number * 366 // CYCLES_PER_YEAR))


def in_cycles(date: Column, lo: int | None, hi: int | None, as_type: str) -> Column:
    """Date predicate equal to ``lo <= cycle_of_date(date) <= hi``."""
    cond = F.lit(True)
    if lo is not None:
        cond = date >= F.lit(f"{first_date(lo)} 00:00:00").cast(as_type)
    if hi is not None:
        cond = cond & (date < F.lit(f"{first_date(hi + 1)} 00:00:00").cast(as_type))
    return cond


# ---- sets of cycles as bits --------------------------------------------------
def cycle_bit(cycle: str, start: int) -> Column:
    """The bit of ``cycle`` in a window that begins at ``start`` (window < 64)."""
    return F.expr(f"shiftleft(1L, {cycle} - {start})")


def cycle_set(cycle: str, start: int, where: Column | None = None) -> Column:
    """Aggregate: the set of cycles seen (0 when none satisfies ``where``)."""
    bit = cycle_bit(cycle, start)
    if where is not None:
        bit = F.when(where, bit)
    return F.coalesce(F.bit_or(bit), F.lit(0).cast("long"))


def cycle_count(mask: Cols) -> Column:
    """Number of distinct cycles in a set."""
    return F.bit_count(_c(mask)).cast("long")
