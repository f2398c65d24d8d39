"""Ratios, rounding, standardisation and the logistic score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dbl(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """Double division; null instead of an ANSI error when ``den`` is 0."""
    return F.try_divide(dbl(num), dbl(den))


def mean_of(col: Column | str) -> Column:
    """Average in double precision (exact decimal or integer sum first)."""
    col = F.col(col) if isinstance(col, str) else col
    return ratio(F.sum(col), F.count(col))


# ---- statistics that do not depend on the order of the rows --------------------
# Sums of doubles do, in their last digits, and a z-score rounded to 4 can flip on them.
# So values enter as decimals (9 digits behind the point, squares 12), whose sums are exact.
def exact_sum(x: Column) -> Column:
    return F.sum(dbl(x).cast("decimal(28,9)"))


def exact_squares(x: Column) -> Column:
    short = dbl(x).cast("decimal(18,6)")
    return F.sum(short * short)


def deviation(total: Column, squares: Column, n: Column) -> Column:
    """Population deviation from the sums of ``n`` values and of their squares, rounded to 4."""
    spread = dbl(squares) - F.try_divide(dbl(total) * dbl(total), dbl(n))
    return F.round(F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), dbl(n))), 4)


def zscore(x: Column, mean: Column, sd: Column) -> Column:
    """``round((x - mean) / sd, 4)``; 0 when the deviation is 0."""
    return F.when(sd == 0, F.lit(0.0)).otherwise(
        F.round(F.try_divide(x - mean, sd), 4))


def logistic(x: Column) -> Column:
    e = F.exp(x)
    return e / (e + 1)


def row_mean_stats(columns: list[str]) -> Column:
    """One struct of (mean, sd) per column: mean over rows, both rounded to 4."""
    fields = []
    for c in columns:
        total, n = exact_sum(F.col(c)), F.count(c)
        fields.append(F.round(ratio(total, n), 4).alias(f"mean_{c}"))
        fields.append(deviation(total, exact_squares(F.col(c)), n).alias(f"sd_{c}"))
    return F.struct(*fields)


def standardise(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a z-score column per entry (new name -> source column).

    The statistics are one row by construction, so they enter the plan as a
    scalar subquery: no join and no shuffle of ``df``.
    """
    stats = df.agg(row_mean_stats(list(columns.values())).alias("s")).scalar()
    scored = df.withColumn("_stats", stats)
    return scored.withColumns({
        new: zscore(dbl(src), F.col(f"_stats.mean_{src}"), F.col(f"_stats.sd_{src}"))
        for new, src in columns.items()
    }).drop("_stats")
