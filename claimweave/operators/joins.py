"""Joins against versioned history and soft-deleted lookup tables.

Every join here is an equi-join, so Spark picks a broadcast or a shuffle join from real sizes and
can split a skewed partition at run time. No side is forced to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.rules import in_version, not_deleted, not_in_workbasket

VERSION_RANGE = ("version_eff_date_key", "version_exp_date_key")
EFFECTIVE_RANGE = ("effective_start_date_key", "effective_end_date_key")


#: Date keys from here on mean that a version has no end.
OPEN_END = 99990000
#: Versions of a key beyond which its versions are met by time cells, and how many such keys are.
MANY_VERSIONS, HOT_KEYS = 256, 256


def asof_join(
    left: DataFrame,
    history: DataFrame,
    on: tuple[str, str],
    values: Sequence[Column | str],
    as_of: str = "statement_start_date_key",
    how: str = "inner",
    span: tuple[str, str] = VERSION_RANGE,
    status: str | None = None,
    spread_by: str = "claim_fact_key",
    by_time: bool = True,
) -> DataFrame:
    """Join each left row to the history rows in force at its own ``as_of`` key.

    The history side is filtered before the join, which for a left join means the same as
    testing it in the join condition. Both sides meet on the key and a time cell, see
    ``time_cells``; the range test stays as a residual of the hash or merge join. ``by_time=False``
    gives every key one cell, for histories too small to have a key of very many versions.
    """
    left_key, right_key = on
    live = history.filter(not_deleted(F.col("deleted_flag")))
    if status is not None:
        live = live.filter(not_in_workbasket(F.col(status)))
    versions = live.select(
        F.col(right_key).alias("_key"), F.col(span[0]).alias("_from"), F.col(span[1]).alias("_to"),
        *values,
    ).filter(F.col("_from") < F.col("_to"))
    if by_time:
        left, versions = time_cells(left, versions, left_key, as_of, spread_by)
    else:
        spread = F.expr(f"CASE WHEN {left_key} IS NULL THEN xxhash64({spread_by}) ELSE 0L END")
        left, versions = left.withColumn("_cell", spread), versions.withColumn("_in_cell", F.expr("0L"))
    matches = (
        (left[left_key] == versions["_key"])
        & (left["_cell"] == versions["_in_cell"])
        & in_version(left[as_of], versions["_from"], versions["_to"])
    )
    return left.join(versions, matches, how).drop("_key", "_from", "_to", "_cell", "_in_cell")


def time_cells(
    left: DataFrame, versions: DataFrame, left_key: str, as_of: str, spread_by: str
) -> tuple[DataFrame, DataFrame]:
    """Give both sides a ``_cell`` / ``_in_cell`` to join on, so no key's versions are all tested.

    A key with many versions has cells as wide as its versions last on average. A version stands in
    each cell it touches, which makes at most three rows of one on average; a left row has the one
    cell of its date, and meets there about twice as many versions as are in force on a day. So the
    work grows with rows and matches, and a hot key is met in as many tasks as it has cells. Other
    keys have one cell. A NULL key, which matches nothing, gets any cell, so that those rows are
    spread over all tasks.

    The widths of the hottest keys (``HOT_KEYS`` at most; the others are tested version by version)
    come from a scalar subquery, so that nothing runs before the join does.
    """
    spans = versions.selectExpr(
        "_key", f"{_time('_from')} AS s", f"{_time('_to')} AS e", f"_to >= {OPEN_END} AS open"
    )
    hot = spans.groupBy("_key").agg(
        F.expr("count(*) AS n"),
        F.expr("greatest(max(s), max(e) FILTER (WHERE NOT open)) AS last"),
        F.expr("sum(CASE WHEN open THEN 0 ELSE e END - s) AS spans"),
        F.expr("count_if(open) AS open_n"),
    ).filter(f"n > {MANY_VERSIONS}").orderBy(F.desc("n"), "_key").limit(HOT_KEYS)
    # An open end counts as the last date of the key.
    width = "bigint(greatest(1, ceil((spans + open_n * last) / n)))"
    widths = hot.agg(
        F.expr(f"map_from_entries(collect_list(struct(_key, struct({width} AS width, last)))) AS w")
    ).scalar()

    def cell(time: str) -> str:
        return f"bigint(floor(least({time}, _w.last) / _w.width))"

    cells = f"sequence({cell(_time('_from'))}, {cell(_time('_to'))})"
    versions = versions.withColumn("_w", F.try_element_at(widths, F.col("_key"))).withColumn(
        "_in_cell", F.expr(f"explode(CASE WHEN _w IS NULL THEN array(0L) ELSE {cells} END)")
    )
    left = left.withColumn("_w", F.try_element_at(widths, F.col(left_key))).withColumn(
        "_cell",
        F.expr(
            f"CASE WHEN {left_key} IS NULL THEN xxhash64({spread_by}) WHEN _w IS NULL THEN 0L "
            f"ELSE {cell(_time(as_of))} END"
        ),
    )
    return left.drop("_w"), versions.drop("_w")


def _time(day_key: str) -> str:
    """A number that grows with the key, in which the months of a ``yyyymmdd`` key leave small gaps."""
    return f"bigint(floor({day_key} / 10000) * 4000 + least(3999, floor(pmod({day_key}, 10000) * 3.2D)))"


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: tuple[str, str],
    values: Sequence[Column | str],
    how: str = "left",
    when: Column | None = None,
    spread_by: str | None = None,
) -> DataFrame:
    """Join the live rows of a lookup table; ``when`` is an extra test on left columns.

    ``spread_by`` names a column that deals out the rows with a NULL key, for tables too large to broadcast.
    """
    left_key, right_key = on
    live = table.filter(not_deleted(F.col("deleted_flag"))).select(
        F.col(right_key).alias("_key"), *values
    )
    matches = left[left_key] == live["_key"]
    if when is not None:
        matches = matches & when
    if spread_by is not None:
        left = left.withColumn("_spread", F.coalesce(left_key, spread_by))
        matches = matches & (left["_spread"] == live["_key"])
    return left.join(live, matches, how).drop("_key", "_spread")


def spread_null_join(
    left: DataFrame, right: DataFrame, on: tuple[str, str], spread_by: str
) -> DataFrame:
    """Left join for a key that is mostly NULL.

    NULL keys never match, yet a plain shuffle would send all of them to one task. A second join
    column, the key itself or ``spread_by`` where the key is NULL, spreads them over all tasks.
    """
    left_key, right_key = on
    spread = left.withColumn("_spread", F.coalesce(left_key, spread_by))
    keyed = right.withColumnRenamed(right_key, "_key")
    matches = (spread[left_key] == keyed["_key"]) & (spread["_spread"] == keyed["_key"])
    return spread.join(keyed, matches, "left").drop("_spread", "_key")
