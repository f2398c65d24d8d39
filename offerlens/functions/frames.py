"""Frame-level helpers: update-from, anti-delete, spread join, seller x offer grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The grid's cells: offers are packed in so many chunks, sellers dealt to so many
# slices.  Chunks bound the array a task holds to a 16th of the run's offers.
OFFER_CHUNKS = 16
SELLER_SLICES = 64
# Copies of a short frame, and slices of the sellers, in a spread join.
SPREAD = 16


def update_from(left: DataFrame, right: DataFrame, keys: list[str],
                columns: list[str] | dict[str, str]) -> DataFrame:
    """Overwrite ``columns`` of ``left`` with the values of ``right`` by key.

    Rows without a match, and matches whose new value is null, keep the old
    value.  ``right`` must be unique on ``keys``, so the row count of ``left``
    is preserved.  ``columns`` maps left name -> right name.
    """
    mapping = columns if isinstance(columns, dict) else {c: c for c in columns}
    fresh = right.select(*keys, *[F.col(r).alias(f"_new_{l}") for l, r in mapping.items()])
    return (left.join(fresh, keys, "left")
            .withColumns({l: F.coalesce(F.col(f"_new_{l}"), F.col(l)) for l in mapping})
            .drop(*[f"_new_{l}" for l in mapping])
            .select(*left.columns))


def delete_matching(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the rows of ``df`` whose keys appear in ``doomed``."""
    return df.join(doomed.select(*keys).distinct(), keys, "left_anti")


def spread_join(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                slices: int = SPREAD) -> DataFrame:
    """Join a frame of sellers with a short one on keys of few values.

    Offers, products and peer groups have few values, some of them hot (all sellers without
    a profile share the null group), so rows placed by them alone end in few tasks.  Where
    Spark measures ``small`` as short it broadcasts it and ``large`` does not move.  Beyond
    that limit the rows of a key are dealt over ``slices`` by seller, and ``small``, which is
    short against ``large`` at any size, is repeated for each slice.
    """
    dealt = large.withColumn("_slice", F.pmod(F.xxhash64("seller_id"), F.lit(slices)).cast("int"))
    copies = small.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return dealt.join(copies, [*keys, "_slice"], how).drop("_slice")


def seller_offer_grid(sellers: DataFrame, offers: DataFrame, chunks: int = OFFER_CHUNKS,
                      slices: int = SELLER_SLICES) -> DataFrame:
    """Every seller with every offer row (the scoring grid).

    Offers are packed by hash in one array per chunk, repeated for each slice of
    sellers.  Each seller asks for all chunks and unpacks what it gets.  Spark
    broadcasts the arrays when they measure small; else sellers times chunks (not
    times offers) are shuffled, and no (slice, chunk) cell holds a large share of them.
    """
    packed = (offers.groupBy(F.pmod(F.xxhash64(*offers.columns), F.lit(chunks)).cast("int").alias("_chunk"))
              .agg(F.sort_array(F.collect_list(F.struct(*offers.columns))).alias("_offers"))
              .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    asking = (sellers
              .withColumn("_slice", F.pmod(F.xxhash64(*sellers.columns), F.lit(slices)).cast("int"))
              .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    return (asking.join(packed, ["_slice", "_chunk"]).withColumn("_o", F.explode("_offers"))
            .select(*sellers.columns, *[F.col(f"_o.{c}").alias(c) for c in offers.columns]))
