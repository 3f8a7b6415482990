"""Facts of chosen keys only, cut at the scan where storage allows and before any shuffle of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

PLACES = 4_096 * 32_768  # bits of 4,096 of Spark's bitmaps, 16 MiB: with 8 million keys one other key in 17 passes


def only_keys(facts: DataFrame, keys: DataFrame | None, key: str = "claim_fact_key") -> DataFrame:
    """Rows of ``facts`` whose ``key`` is among ``keys``; all rows where ``keys`` is None.

    The lowest and the highest key come from scalar subqueries that the scan takes as filters, so
    row groups outside are skipped. The exact test is a semi join: few keys are broadcast by Spark's
    estimate, so nothing of the other claims is shuffled; with more keys, Spark's runtime Bloom filter
    (``spark.sql.optimizer.runtime.bloomFilter``) thins out the facts before their shuffle by the
    key, which the later joins on that key share. No keys, or only NULL ones, give no rows.
    """
    if keys is None:
        return facts
    keys = keys.select(key)
    low = keys.agg(F.min(key)).scalar()
    # Not max(): Spark would merge both aggregates into one row, whose fields no scan takes as filters.
    high = keys.orderBy(F.desc(key)).limit(1).scalar()
    ranged = facts.filter((F.col(key) >= low) & (F.col(key) <= high))
    return ranged.join(keys, key, "left_semi")


def likely_rows(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows of ``rows`` whose ``key`` is among ``keys``, few others, and none without a key.

    For wide rows that a later join with the keys tests exactly: they meet hashed bitmaps of the keys, broadcast and
    bounded in size, so they aren't shuffled here. Only whole and decimal numbers of one type hash
    alike where they are equal; for other keys this is a semi join.
    """
    # Selected, as names resolve without regard to case there.
    kind, other = (frame.select(key).schema[0].dataType for frame in (rows, keys))
    if kind != other or not isinstance(kind, (IntegralType, DecimalType)):
        return rows.join(keys.select(key), key, "left_semi")
    place = F.pmod(F.xxhash64(key), F.lit(PLACES)) + 1
    bucket, position = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    places = keys.filter(F.col(key).isNotNull()).select(bucket.alias("_bucket"), position.alias("_position"))
    # Dealt out before they are gathered, else each task would send bitmaps for all of its keys.
    bits = places.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_position").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = (bucket == F.col("_bucket")) & (F.getbit(byte, (position % 8).cast("int")) == 1)
    return rows.filter(F.col(key).isNotNull()).join(F.broadcast(bits), met, "left_semi")
