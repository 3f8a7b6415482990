"""Join on a key of which a few values may hold a large share of one side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 100_000


def frequent_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Key values with more than ``rows_per_task`` rows, and the number of parts to cut each into.

    There are fewer than ``rows / rows_per_task`` of them. Reads one column and combines counts
    before the shuffle.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int")
    return counts.filter(F.col("_rows") > rows_per_task).select(key, parts.alias("_parts"))


def salted_join(
    small: DataFrame,
    big: DataFrame,
    key: str,
    spread_by: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner join of ``small`` to ``big`` in which a frequent key of ``big`` is cut into parts.

    Rows of ``big`` with a frequent key get a salt below its number of parts; the matching rows of
    ``small`` are repeated once per part. Every other row keeps salt 0 and is not repeated, and the
    matches are those of a plain join. The frequent keys are joined without a hint: they grow with
    ``big``, so the optimizer decides by their size whether to broadcast them.
    """
    hot = frequent_keys(big.select(key), key, rows_per_task)
    parts = F.coalesce("_parts", F.lit(1))
    spread = big.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), parts).cast("int")
    ).drop("_parts")
    repeated = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))
    ).drop("_parts")
    return repeated.join(spread, [key, "_salt"], "inner").drop("_salt")
