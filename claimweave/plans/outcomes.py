"""A wide table and its rejected rows, written by one run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimweave.plans.assemble import REJECT_REASON
from claimweave.plans.layouts import LAYOUTS

OUTCOME = "outcome"
ACCEPTED, REJECTED = "accepted", "rejected"


def write_outcomes(rows: DataFrame, path: str, mode: str = "errorifexists") -> dict[str, int]:
    """Write a build's rows to a folder per outcome and claim type; returns the rows of each outcome.

    The build runs once for both outcomes, where ``accepted`` and ``rejected`` written one after the
    other run it twice. Rejected rows are kept whole, the numbers that do not fit as NULL, with their
    reason. The counts are gathered while the rows are written.
    """
    kept = F.col(REJECT_REASON).isNull()
    marked = rows.withColumn(OUTCOME, F.when(kept, ACCEPTED).otherwise(REJECTED))
    counts = Observation()
    observed = marked.observe(
        counts, F.count_if(kept).alias(ACCEPTED), F.count_if(~kept).alias(REJECTED)
    )
    observed.write.mode(mode).partitionBy(OUTCOME, "CLAIM_TYPE_NAME").parquet(path)
    return {name: counts.get.get(name, 0) for name in (ACCEPTED, REJECTED)}


def read_outcome(spark: SparkSession, path: str, kind: str, outcome: str) -> DataFrame:
    """The rows of one outcome in their layout's column order, rejected ones with their reason."""
    columns = [c.name for c in LAYOUTS[kind.upper()]]
    reason = [REJECT_REASON] if outcome == REJECTED else []
    rows = spark.read.parquet(path).filter(F.col(OUTCOME) == outcome)
    return rows.select(*columns, *reason)
