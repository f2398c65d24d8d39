"""Language identification by error-correcting output codes.

Each language has a binary codeword; for each bit a classifier on hashed byte trigrams
tells the languages with a 1 from those with a 0.  Decoding weighs the loss of each bit
by how reliable its classifier was on the learning sample, takes the nearest codeword,
and flags a text as ambiguous when the second is nearly as near.

The classifiers are log-odds of trigram counts, gathered by Spark from a sample of at
most about ``SAMPLE`` texts per language, chosen by a hash of the text; languages times
``BUCKETS`` counts reach the driver.  Only text and a non-null language are learned from.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as are
all texts if nothing can be learned; if one language alone is known, every text with a
letter is of it.  Repeated rows are alike.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

SAMPLE = 2000                 # texts per language, about
BUCKETS = 1 << 15             # of trigrams
SMOOTHING = 0.5
STRETCH = 1 << 17             # trigrams weighed at a time
SHARPNESS = 6.0
AMBIGUOUS = 0.2               # least lead of the first language over the second
UNKNOWN = "und"
_LETTERS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint32)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text in lower case, all else than letters being
    one blank; runs of three blanks are left out."""
    a = _LETTERS[np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)]
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    return (code[code != 0x202020] * np.uint32(2654435761)) >> np.uint32(17)


def codewords(n: int) -> np.ndarray:
    """int [n, bits] of 0 and 1: all ways to split up to five languages in two, beyond
    that the best of some random codes by least distance."""
    if n < 2:
        return np.zeros((n, 0), int)
    if n <= 5:
        return np.array([[int(i != 0 and (k >> (i - 1)) & 1) for k in range(1, 1 << (n - 1))] for i in range(n)])
    rng, bits, best, far = np.random.default_rng(1), 4 * math.ceil(math.log2(n)) + 8, None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (n, bits))
        code[0, code.min(0) == code.max(0)] ^= 1             # no bit the same for all
        least = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(min(n, 200)), 2))
        if least > far:
            best, far = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray              # [languages, bits] of -1 and 1
    weights: np.ndarray           # [BUCKETS, bits]
    trust: np.ndarray             # [bits]

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds per bit."""
        t, total = trigrams(text), np.zeros(self.code.shape[1])
        for a in range(0, len(t), STRETCH):
            total += self.weights[t[a:a + STRETCH]].sum(0, dtype=np.float64)
        return total / max(1, len(t))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        m = np.clip(SHARPNESS * self.margins(text), -50, 50)
        loss = (np.log1p(np.exp(-self.code * m)) * self.trust).sum(1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        first, second = np.argsort(-p, kind="stable")[:2]
        return self.languages[first], float(p[first]), bool(p[first] - p[second] < AMBIGUOUS)


def _counts(batches):
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found.setdefault(lang, np.zeros(BUCKETS, np.int64))
            found[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
    for lang, n in found.items():
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                              ["lang", "bucket", "n"])


def sample_of(labelled: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """(text, lang): about ``per_language`` rows of each language, all of a rarer one.
    Texts, not rows, are drawn, so copies are in or out together; of each text in the
    sample one row stays."""
    h = F.xxhash64("text")
    share = written(labelled.groupBy(F.col("lang").alias("lang_s")).agg(F.approx_count_distinct(h).alias("n"))
                    .withColumn("limit", F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n"))), "langid-share")
    place = F.pmod(F.xxhash64(h, F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (labelled.join(share, F.col("lang") == F.col("lang_s")).where(place < F.col("limit"))
            .select("text", "lang").distinct())


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE) -> Model:
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull())
    sample = written(sample_of(labelled, per_language), "langid-sample")
    counts = sample.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts["lang"].to_pylist()))
    table = np.zeros((len(languages), BUCKETS))
    place = {lang: k for k, lang in enumerate(languages)}
    table[[place[x] for x in counts["lang"].to_pylist()], counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    # Every language weighs the same, however much text it has.
    share = table / np.maximum(1, table.sum(1, keepdims=True)) * 1e5 + SMOOTHING
    code = codewords(len(languages))
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        one, zero = share[code[:, b] == 1].mean(0), share[code[:, b] == 0].mean(0)
        weights[:, b] = np.log(one / one.sum()) - np.log(zero / zero.sum())
    model = Model(languages, 2 * code - 1, weights, np.ones(code.shape[1]))
    if code.shape[1]:
        model.trust = _trust(sample, model)
    return model


def _trust(sample: DataFrame, model: Model) -> np.ndarray:
    """Per bit, the log-odds that its classifier is right on the sample, 1 on average."""
    place = {lang: k for k, lang in enumerate(model.languages)}

    def right(batches):
        for batch in batches:
            m = np.array([model.margins(t) for t in batch.column(0).to_pylist()]).reshape(batch.num_rows, -1)
            truth = model.code[[place[x] for x in batch.column(1).to_pylist()]] if batch.num_rows else m
            ok = ((m > 0) == (truth > 0)).sum(0)
            yield pa.record_batch([pa.array(np.arange(len(ok), dtype=np.int32)), pa.array(ok.astype(np.int64)),
                                   pa.array(np.full(len(ok), batch.num_rows, np.int64))], ["bit", "right", "n"])

    found = sample.mapInArrow(right, "bit int, right long, n long").groupBy("bit").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))
    trust = np.ones(model.code.shape[1])
    for r in found.collect():                                 # one row per bit
        p = (r["right"] + 1) / (r["n"] + 2)
        trust[r["bit"]] = max(0.05, math.log(p / (1 - p)))
    return trust / trust.mean()


def predicted(text: Column, model: Model) -> Column:
    """struct(lang_pred, score, ambiguous)."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([dict(zip(("lang_pred", "score", "ambiguous"), model.predict(t.as_py()))) for t in texts], kind)

    return F.arrow_udf(run, "lang_pred string, score double, ambiguous boolean")(text)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, ambiguous."""
    model = learn(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                        predicted(F.col(text_col), model).alias("p")).select("doc_id", "held_out", "p.*"))


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents in a language that can be told, with the columns of ``docs``."""
    model = learn(docs.where(~held_out(F.col(id_col))), text_col, lang_col)
    return docs.where(predicted(F.col(text_col), model)["lang_pred"] != UNKNOWN)
