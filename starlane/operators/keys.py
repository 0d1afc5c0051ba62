"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# 16^4 buckets: the offset table never has more rows than this.
BUCKET_HEX_DIGITS = 4


def natural_key(*columns: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def shown(*columns: str) -> Column:
    """A key as text to read, with a mark for NULL; never to compare by."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def assign_keys(
    rows: DataFrame,
    natural: Column,
    key: str,
    after: DataFrame | None = None,
) -> DataFrame:
    """Number ``rows`` densely, in the order of (md5 of the natural key, natural key).

    The first digits of the digest cut the rows into even buckets whatever the
    keys look like, and the bucket order agrees with the row order. So a row
    number inside each bucket plus the count of all rows in lower buckets is the
    global row number, found without any global sort, and the same after a
    recomputation. ``natural`` must be unique in ``rows``.

    ``after`` is a table already holding keys in column ``key``; numbering
    continues behind its greatest one.
    """
    digest = F.md5(F.coalesce(natural, F.lit("")))
    tagged = rows.select(
        "*",
        natural.alias("_natural"),
        digest.alias("_digest"),
        F.substring(digest, 1, BUCKET_HEX_DIGITS).alias("_bucket"),
    )
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if after is not None:
        # The empty bucket name sorts before all others.
        used = after.agg(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("_n"))
        counts = counts.unionByName(used.select(F.lit("").alias("_bucket"), "_n"))
    lower = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_offset")
    )
    within = W.partitionBy("_bucket").orderBy("_digest", "_natural")
    return (
        tagged.withColumn("_position", F.row_number().over(within).cast("long"))
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_position")).alias(key), *rows.columns)
    )
