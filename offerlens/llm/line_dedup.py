"""Line dedup: an exact set-similarity join of all lines, later matches removed.

A line is the set of its words in lower case.  Lines of the same words are one class,
held by its first line (by doc_id, then line number).  Words are ranked by rarity over
all documents: their counts are kept in ``SLOTS`` hashed slots, a word's id is the
logarithm of its slot's count in the top bits and a 58-bit hash below, so sorting ids
orders any two words the same way everywhere, rarest first.  Two sets with a Jaccard
similarity of at least ``SIMILAR`` share two words of their prefixes, which are one word
longer than a single shared word would need; their lengths and the places of the shared
words bound the overlap.  A bitmap of 64 parities per line bounds it
once more: every word that only one of two sets has flips one bit, so sets
differ in at least as many words as their bitmaps do in bits.  Pairs that are left are
verified on the words themselves.

A line goes if an earlier line of its class, or of a class it matches, comes before it.
So classes first meet the heads of a few of their words, if many classes have such a word
among their own few: these are dealt into ``HEADS`` shares, and a first class of each is
a head.  That costs ``HEADS`` pairs per word at most, however many lines are alike.
Whatever those pairs remove needs no more partners; only for the classes that are left
are all earlier partners looked up, the earliest of these verified first.

All of it is DataFrame work.  Only lines that are left to verify are read again and
shuffled, found by small Bloom filters; neither texts nor word sets of all lines are.

Defined cases: a null text has no lines; a line without words is never removed; words
are ranked by 58-bit hashes and classes told apart by a 64-bit hash of these.  Rows that repeat a ``doc_id`` count as one document if
their text is the same; else their lines are told apart by a hash of the text.  A null
``doc_id`` comes last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, bloom_filter, filter_words, fresh, possibly_in, written

SIMILAR = (4, 5)              # 4/5, as whole numbers so that no bound is rounded
SLOTS = 1 << 18               # of word counts: the largest thing that is sent to every task
KEYS = 3                      # words by which a class meets heads
HEADS = 4                     # of a word: its classes are dealt into as many shares
CROWDED = 8                   # a share of more classes than that has a head
CONTROLS = ("\t", "\v", "\f", "\r")   # white space within a line, besides the space
LONG = "long"


def _slot(h: Column) -> Column:
    return h.bitwiseAND(F.lit(SLOTS - 1).cast(LONG))


def _holds(c: Column, parts: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(c, F.lit(part)) for part in parts])


def words_of(line: Column) -> Column:
    """The words of a line in lower case.  A regular expression is needed only where there
    is other white space than single spaces between words."""
    low = F.lower(line)
    other = (line == "") | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" ")) | _holds(line, ("  ", *CONTROLS))
    return F.when(other, F.array_remove(F.split(low, SPACE), "")).otherwise(F.split(low, " "))


def rarity(docs: DataFrame) -> DataFrame:
    """One row with an array of ``SLOTS`` small numbers, in the top bits: the logarithm of
    the count of the words in each slot."""
    low = F.lower("text")
    split = (F.when(_holds(F.col("text"), CONTROLS), F.split(low, SPACE))
             .otherwise(F.split(F.replace(low, F.lit("\n"), F.lit(" ")), " ")))
    words = docs.select(F.explode(split).alias("w"))
    counts = words.groupBy(_slot(F.xxhash64("w")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    every = docs.sparkSession.range(SLOTS).select(F.col("id").alias("slot"), F.lit(0).cast(LONG).alias("n"))
    level = F.least(F.lit(31), F.floor(F.log2(F.sum("n") + 1) * 1.2)).cast(LONG)
    slots = counts.unionByName(every).groupBy("slot").agg(level.alias("level"))
    packed = F.sort_array(F.collect_list(F.col("slot") * 32 + F.col("level")))
    return slots.agg(F.transform(packed, lambda x: F.shiftleft(x.bitwiseAND(F.lit(31).cast(LONG)), 58)).alias("levels"))


def word_ids(line: Column, levels: Column) -> Column:
    """The distinct words of a line as ids, rarest first; ``levels`` stand in the top bits."""
    def one(h: Column) -> Column:
        # Never null, so that the ids are sorted as plain numbers.
        return F.coalesce(F.get(levels, _slot(h).cast("int")), F.lit(0).cast(LONG)).bitwiseOR(F.shiftrightunsigned(h, 6))

    return F.sort_array(F.transform(F.array_distinct(F.transform(words_of(line), lambda w: F.xxhash64(w))), one))


def source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast(LONG).alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))


def _at_least(size: Column, of: int, by: int) -> Column:
    """ceil(size * of / by), in whole numbers."""
    return F.floor((size * of + (by - 1)) / F.lit(by)).cast("int")


def _overlap(m: Column, n: Column) -> Column:
    """Words that sets of ``m`` and ``n`` words must share."""
    return _at_least(m + n, SIMILAR[0], sum(SIMILAR))


def classified(src: DataFrame, levels: Column) -> DataFrame:
    """Every line with its class, its number of words and its prefix; a document
    without text has one row without a line."""
    length = F.col("size") - _at_least(F.col("size"), SIMILAR[0], SIMILAR[1]) + 2
    parity = F.aggregate("ids", F.lit(0).cast(LONG), lambda a, x: a.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast(LONG), x.bitwiseAND(F.lit(63).cast(LONG)).cast("int"))))
    # For the join, 32 bits of a word are enough: a clash is one more pair to verify.
    short = F.transform(F.slice("ids", F.lit(1), length), lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int"))
    return (src.select("doc_id", "tie", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
            # Levels and ids become one projection: rows never hold the levels.
            .withColumn("levels", levels).select("doc_id", "tie", "line_no", word_ids(F.col("line"), F.col("levels")).alias("ids"))
            .withColumns({"size": F.size("ids"), "parity": parity})
            .select("doc_id", "tie", "line_no", F.xxhash64("ids").alias("cls"), "parity", "size", short.alias("prefix")))


def _place() -> Column:
    """Where a line stands among all lines."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie", "line_no")


def _may_match(m: Column, n: Column, left: Column, x: Column, y: Column) -> Column:
    """Filters of sets with ``m`` and ``n`` words, at most ``left`` of them shared, and
    the parities ``x`` and ``y``."""
    a, b = SIMILAR
    # In whole numbers.  Parities differ in as many bits as words do, or an even number less.
    return ((m * b >= n * a) & (n * b >= m * a) & (left * (a + b) >= (m + n) * a)
            & (F.bit_count(x.bitwiseXOR(y)) * (a + b) <= (m + n) * (b - a)))


def head_pairs(classes: DataFrame) -> DataFrame:
    """(a, b, overlap): classes that may match a head of one of their ``KEYS`` words,
    from (cls, first, parity, size, prefix).  The words are those of the prefix with the
    least hashes, which near copies have in common more often than their rarest ones."""
    doc = F.coalesce("first.doc_id", F.lit((1 << 63) - 1).cast(LONG)).alias("doc")
    keyed = classes.select("cls", doc, F.pmod("cls", F.lit(HEADS)).alias("share"), "parity", "size",
                           F.explode(F.slice(F.sort_array("prefix"), 1, KEYS)).alias("word"))
    # Numbers alone, which are summed up without sorting; all three are those of one class.
    head = [F.min_by(c, "doc").alias(name) for c, name in (("cls", "b"), ("size", "head_size"), ("parity", "head_parity"))]
    heads = written(keyed.groupBy(F.col("word").alias("head_word"), "share").agg(*head, F.count(F.lit(1)).alias("n"))
                    .where(F.col("n") > CROWDED).drop("share", "n"), "line-head")
    m, n = F.col("size"), F.col("head_size")
    return (keyed.join(heads, F.col("word") == F.col("head_word"))
            .where((F.col("cls") != F.col("b")) & _may_match(m, n, F.least(m, n), F.col("parity"), F.col("head_parity")))
            .select(F.col("cls").alias("a"), "b", _overlap(m, n).alias("overlap")).distinct())


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b, overlap): pairs of classes that may match, from (cls, first, parity, size,
    prefix, settled), but for those whose later document has the settled class."""
    doc = F.coalesce("first.doc_id", F.lit((1 << 63) - 1).cast(LONG)).alias("doc")
    # Never null, so that the join, which looks at many more pairs than it keeps, need not ask.
    number = [F.coalesce(c, F.lit(0).cast(kind)).alias(c) for c, kind in (("cls", LONG), ("parity", LONG), ("size", "int"))]
    items = classes.select(*number, doc, F.coalesce("settled", F.lit(False)).alias("settled"), F.posexplode("prefix").alias("at", "word"))
    x, y = items.alias("x"), items.alias("y")
    m, n, p, q = F.col("x.size"), F.col("y.size"), F.col("x.at"), F.col("y.at")
    # Conditions on both sides at once, the most telling first: the two sides stay one exchange
    # of the same rows.  They hold for the first two words that a matching pair shares.
    met = x.join(y, (F.col("x.word") == F.col("y.word"))
                 & (m <= n) & (m * SIMILAR[1] >= n * SIMILAR[0]) & ((m < n) | (F.col("x.cls") < F.col("y.cls")))
                 & _may_match(m, n, F.least(m - p, n - q) + 1, F.col("x.parity"), F.col("y.parity"))
                 & ((~F.col("x.settled") & (F.col("x.doc") >= F.col("y.doc"))) | (~F.col("y.settled") & (F.col("y.doc") >= F.col("x.doc")))))
    return (met.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), _overlap(m, n).alias("overlap"), F.least(m - p, n - q).alias("left"))
            .groupBy("a", "b", "overlap").agg(F.count(F.lit(1)).alias("shared"), F.max("left").alias("left"))
            .where("shared >= 2 and left >= overlap").select("a", "b", "overlap"))


def turned(pairs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs as (late, early, first, overlap), ``first`` being the place of the early
    class, without those of which the late one is settled; and (cls, first) of their classes."""
    wanted = written(pairs.select(F.col("a").alias("w")).unionByName(pairs.select(F.col("b").alias("w"))).distinct()
                     .join(classes, F.col("w") == F.col("cls")).select("cls", "first", "settled"), "line-wanted")
    one, two = [wanted.select(F.col("cls").alias(k), F.col("first").alias(f"f{k}"), F.col("settled").alias(f"s{k}")) for k in ("a", "b")]
    swap = F.col("fb") < F.col("fa")

    def late(a: str, b: str) -> Column:
        return F.when(swap, F.col(a)).otherwise(F.col(b))

    return written(pairs.join(one, "a").join(two, "b").where(~late("sa", "sb"))
                   .select(late("a", "b").alias("late"), late("b", "a").alias("early"), F.least("fa", "fb").alias("first"), "overlap"), "line-turned"), wanted


def texts_at(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, line) of the lines at the places ``wanted`` (cls, first)."""
    places = wanted.select("cls", "first.*")
    doc, line = F.xxhash64("doc_id", "tie"), F.xxhash64("doc_id", "tie", "line_no")
    words = filter_words(places.count())
    docs = written(bloom_filter(places.select(doc.alias("h")), words), "line-filter")
    lines = written(bloom_filter(places.select(line.alias("h")), words), "line-filter")
    found = possibly_in(possibly_in(src, doc, docs, words).select("doc_id", "tie", F.posexplode(F.split("text", "\n")).alias("line_no", "line")),
                        line, lines, words).alias("f")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "tie", "line_no")]
    return found.join(places.alias("p"), same).select("cls", "line").dropDuplicates(["cls"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The classes ``late`` of those pairs (late, early, overlap) that really match."""
    x, y = texts.select(F.col("cls").alias("late"), F.col("line").alias("x")), texts.select(F.col("cls").alias("early"), F.col("line").alias("y"))
    shared = F.size(F.array_intersect(words_of(F.col("x")), words_of(F.col("y"))))
    return pairs.join(x, "late").join(y, "early").where(shared >= F.col("overlap")).select("late").distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tie, n_lines, removed (line numbers from 0, in order)."""
    src = source(docs, id_col, text_col)
    levels = written(rarity(src), "line-levels").scalar()
    rows = written(classified(src, levels), "lines")
    classes = written(rows.groupBy("cls").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"), F.first("parity").alias("parity"), F.first("size").alias("size"),
                                              F.first("prefix").alias("prefix")).where("size > 0"), "line-classes")
    # Classes that match a head of one of their words.
    pairs, wanted = turned(written(head_pairs(classes), "line-heads"), classes.withColumn("settled", F.lit(False)))
    soon = written(verified(pairs, texts_at(src, wanted)), "line-soon")
    # All earlier partners of the others.
    open_ = classes.join(soon, F.col("cls") == F.col("late"), "left").withColumn("settled", F.col("late").isNotNull())
    pairs, wanted = turned(written(candidates(open_), "line-pairs"), open_)
    texts = written(texts_at(src, wanted), "line-texts")
    earliest = pairs.groupBy("late").agg(F.min(F.struct("first", "early", "overlap")).alias("e")).select("late", "e.early", "e.overlap")
    done = written(verified(earliest, texts), "line-done")
    later = (soon.unionByName(done).unionByName(verified(pairs.join(done, "late", "left_anti").select("late", "early", "overlap"), texts))
             .withColumnRenamed("late", "gone"))
    # Classes that matter below: repeated, or removed whole.
    known = written(classes.join(later, F.col("cls") == F.col("gone"), "left").where("n > 1 or gone is not null")
                    .select(F.col("cls").alias("c"), "first", F.col("gone").isNotNull().alias("whole")), "line-known")
    off = F.col("c").isNotNull() & (F.col("whole") | (_place() != F.col("first")))
    return (rows.select("doc_id", "tie", "line_no", "cls", "size").join(known, F.col("cls") == F.col("c"), "left")
            .groupBy("doc_id", "tie").agg(F.count("line_no").alias("n_lines"),
                                          F.array_sort(F.collect_set(F.when(off & (F.col("size") > 0), F.col("line_no")))).alias("removed"),
                                          F.count(F.when(F.col("line_no") == 0, 1)).alias("rows"))
            .withColumn("n_lines", F.when(F.col("rows") > 1, F.floor(F.col("n_lines") / F.col("rows"))).otherwise(F.col("n_lines")))
            .drop("rows"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines taken out of the text."""
    own, removed = fresh(docs, "gone_doc", "gone")
    gone = written(removed_lines(docs, id_col, text_col).where(F.size("removed") > 0)
                   .select(F.xxhash64("doc_id", "tie").alias(own), F.col("removed").alias(removed)), "lines-gone")
    key = F.xxhash64(F.col(id_col).cast(LONG), F.xxhash64(text_col))
    lines = F.filter(F.split(text_col, "\n"), lambda _, k: ~F.array_contains(removed, k))
    text = F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(F.array_join(lines, "\n"))
    return docs.join(gone, key == F.col(own), "left").withColumn(text_col, text).select(*[F.col(f"`{c}`") for c in docs.columns])
