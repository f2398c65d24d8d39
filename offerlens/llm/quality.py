"""Quality rules whose cutoffs bound the share of good documents they reject.

A rule gives a document a whole number from 0 to 1000 and rejects it from a cutoff on.  For
each stratum (language) and rule, labelled documents of one fold propose the cutoff that
pays best: caught bad documents less ``COST`` times the good ones lost.  Those of the other
fold, the holdout, decide.  From the most lenient cutoff on, in fixed order and no further
than the proposed one, a cutoff holds as long as an exact binomial test tells, at a level
of ``RISK`` over all proposals (Bonferroni), that it rejects at most the rule's share of
``LIMIT``.  The limit of a stratum is shared by the rules proposed there.  So with
probability 1 - ``RISK`` no stratum loses more than ``LIMIT`` of its good documents, however
the rules overlap.  Only documents that pass the base rules are tested, as only they are
judged.  A stratum with too few labelled documents to tell has no cutoffs.

Labels are counted per stratum, rule, fold and value before anything is gathered; windows
run over the at most 1001 values of one stratum and rule.

Defined cases: a null text has no words; a null language is a stratum of its own; labels
without an id or a quality do not count, and of several for one id the lowest does; labels
of absent documents change nothing; rows that repeat a ``doc_id`` are documents of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import texts_of
from .shared import written

LIMIT = 0.05                  # share of a stratum's good documents that may be rejected
RISK = 0.05                   # probability that any stratum loses more
COST = 10                     # bad documents that a good one weighs
LEAST_WORDS = 50              # fixed value of the base rules
SYMBOLS = b"#*$%&|<>"         # fixed value
STRETCH = 1000                # texts a worker measures at a time
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs, k = a[:-1] * len(ids) + a[1:], len(ids)
    if k >= 1 << 21:                                          # three would not fit in a long
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * k + a[2:], return_inverse=True, return_counts=True)
    twice, marked = counts[which] > 1, np.zeros(len(words), bool)
    for shift in range(3):
        marked[shift:len(twice) + shift] |= twice
    return int(marked.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The ``MEASURES`` of a text."""
    words = text.split()                                      # of bytes: ASCII white space alone
    in_words = b"".join(words)
    chars = len(in_words) if in_words.isascii() else int((np.frombuffer(in_words, np.uint8) & 0xC0 != 0x80).sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words),
            sum(map(bytes.isupper, words)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, measures) of every document."""
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, STRETCH):
                part = batch.slice(k, STRETCH)
                rows = [measure(t) for t in texts_of(part.column(2))]
                yield pa.record_batch([part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in zip(*rows)]], ["doc_id", "stratum", *MEASURES])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{stratum_col}`").cast("string").alias("stratum"),
                       F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "doc_id long, stratum string, " + ", ".join(f"{m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _share(part: str, whole: str) -> Column:
    return F.expr(f"if({whole} > 0, 1000 * {part} div {whole}, 0)")


def _length() -> Column:
    return F.expr("if(n_words > 0, least(1000, 10 * word_chars div n_words), 0)")


def rules() -> dict[str, Column]:
    """Each a whole number from 0 to 1000; high is bad."""
    return {"symbols": F.least(_share("n_symbols", "word_chars"), F.lit(1000).cast("long")), "duplicate_lines": _share("n_dup_lines", "n_lines"),
            "repeated_words": _share("n_repeat_words", "n_words"), "capitals": _share("n_capitals", "n_words"),
            "long_words": _length(), "short_words": 1000 - _length()}


def at_most(k: int, n: int, p: float) -> float:
    """The probability of at most ``k`` in ``n`` trials of probability ``p``: an incomplete
    beta function, by its continued fraction."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    least, c = 1e-300, 1.0
    d = 1.0 / (1.0 - (a + b) * x / (a + 1.0) or least)
    out = d
    for m in range(1, 1_000_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + term * d or least)
            c = 1.0 + term / c or least
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def binomial(k: Column, n: Column, p: Column) -> Column:
    def run(ks: pa.Array, ns: pa.Array, ps: pa.Array) -> pa.Array:
        return pa.array([at_most(*r) for r in zip(ks.to_pylist(), ns.to_pylist(), ps.to_pylist())], pa.float64())

    return F.arrow_udf(run, "double")(k, n, p)


def fold(doc_id: Column) -> Column:
    """0: proposes cutoffs; 1: holdout."""
    return F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 8), 16, 10).cast("long") % 2


def cutoffs(features: DataFrame, labels: DataFrame, limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """(stratum, rule, cutoff) for the rules that hold in a stratum."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("marked")).agg(F.min("quality").alias("quality"))
    known = features.where(~base_failed()).join(marks, F.col("doc_id") == F.col("marked"))
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), c.cast("long").alias("value")) for name, c in rules().items()]))
    good, hold = F.col("quality") > 0, fold(F.col("doc_id")) == 1
    counted = (known.select("stratum", good.alias("good"), hold.alias("hold"), values.alias("r")).groupBy("stratum", "r.rule", "r.value")
               .agg(*[F.count_if(c).alias(n) for n, c in (("good", F.col("good") & ~F.col("hold")), ("bad", ~F.col("good") & ~F.col("hold")), ("held", F.col("good") & F.col("hold")))]))
    each = Window.partitionBy("stratum", "rule")
    falling = each.orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    sums = counted.select("stratum", "rule", "value", *[F.sum(c).over(falling).alias(c) for c in ("good", "bad", "held")], F.sum("held").over(each).alias("n_held"))
    gain = F.col("bad") - COST * F.col("good")
    sums = written(sums.withColumn("best", F.max(F.struct(gain.alias("gain"), F.col("value").alias("from"))).over(each))
                   .where((F.col("best.gain") > 0) & (F.col("value") >= F.col("best.from"))), "quality-sums")
    proposals = sums.select("stratum", "rule").distinct()
    tests = proposals.count()
    shares = proposals.groupBy(F.col("stratum").alias("of")).agg((F.lit(limit) / F.count(F.lit(1))).alias("share"))
    tried = sums.join(shares, F.col("stratum").eqNullSafe(F.col("of"))).withColumn("p", binomial(F.col("held"), F.col("n_held"), F.col("share")))
    return tried.where(F.col("p") <= risk / max(1, tests)).groupBy("stratum", "rule").agg(F.min("value").alias("cutoff"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           limit: float = LIMIT, risk: float = RISK) -> DataFrame:
    """One row per document: doc_id, stratum, measures, base_failed, failed (names of the
    calibrated rules that reject it), kept."""
    features = written(measured(docs, id_col, text_col, stratum_col), "quality-measures")
    held = written(cutoffs(features, labels, limit, risk).groupBy(F.col("stratum").alias("of"))
                   .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "quality-cutoffs")
    failed = F.array_compact(F.array(*[F.when(c >= F.element_at("cutoffs", F.lit(name)), F.lit(name)) for name, c in rules().items()]))
    return (features.join(held, F.col("stratum").eqNullSafe(F.col("of")), "left")
            .select("doc_id", "stratum", *MEASURES, base_failed().alias("base_failed"), F.coalesce(failed, F.array()).alias("failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))
