"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source, ranked there, sorted over all sources by the
fraction of their source that precedes them, and cut into runs of equal length. Every shard then holds
each source in its share, give or take a row, and shard sizes differ by one row at most.

Both ranks come from range-sorted tables: a rank is a row's place in its partition plus the rows before
that partition, so a source with a third of all rows is spread over as many tasks as any others.

Cases: null sources form a source of their own; null and empty texts count like any other; rows with
equal doc_id tie and take neighbouring ranks; repeated rows are all placed; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.common import stored

_ROW_BITS = 33  # monotonically_increasing_id() has the partition's number above these bits


def ranked(rows: DataFrame, order: list[str], within: str | None, name: str) -> DataFrame:
    """The rows with `place`, from 0: the rank in the total order, or among those of one `within` value.

    `order` begins with `within` if given. The sorted rows are stored, so counting and placing see the
    same partitions. The counts have one row for each partition, or each pair of a partition and a
    value in it: partitions plus values at most, whatever the number of rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    at = F.col("__at")
    kept = stored(
        rows.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__at", F.monotonically_increasing_id()),
        name,
    ).select(
        *rows.columns,
        F.shiftright(at, _ROW_BITS).alias("__part"),
        at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__row"),
    )
    group = F.col(within) if within else F.lit(0)
    counts = kept.groupBy(F.col("__part").alias("__p"), group.alias("__g")).agg(
        F.count("*").alias("__n"), F.min("__row").alias("__first")
    )
    earlier = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).select(
        "__p", "__g", "__before"
    )
    return kept.join(starts, (F.col("__part") == F.col("__p")) & group.eqNullSafe(F.col("__g"))).select(
        *rows.columns, (F.col("__before") + F.col("__row")).alias("place")
    )


def shard(docs: DataFrame, shards: int = 40, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    The law is `rows`: counts of two shards differ by one at most. Slots of a shard run from 0 in the
    interleaved order. With another number of shards all rows may move, so grown_shard is null.
    """
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    narrow = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary")).alias("shuffle"),
    )
    in_source = ranked(narrow, ["source", "shuffle", "doc_id"], "source", "by-source")
    sizes = in_source.groupBy(F.col("source").alias("__s")).agg(F.count("*").alias("__n"))
    fraction = in_source.join(sizes, F.col("source").eqNullSafe(F.col("__s"))).select(
        "doc_id", "source", "size", "text_crc32", "shuffle", ((2 * F.col("place") + 1) / (2 * F.col("__n"))).alias("fraction")
    )
    placed = ranked(fraction, ["fraction", "source", "shuffle", "doc_id"], None, "by-fraction")
    total = max(1, docs.count())
    number = F.expr(f"place * {shards} div {total}L")
    # The first place of shard s is the least p with p * shards >= s * total.
    first = F.expr(f"(__shard * {total}L + {shards} - 1) div {shards}")
    return placed.withColumn("__shard", number).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("__shard").cast("int").alias("shard"),
        (F.col("place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
