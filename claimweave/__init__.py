"""Set-based claim staging and payer extracts on Spark."""

from claimweave.plans.assemble import (
    BuildOptions,
    ClaimBuild,
    accepted,
    build_claims,
    rejected,
)
from claimweave.plans.bridge import stage_claims
from claimweave.plans.extract import extract_records
from claimweave.plans.header import HeaderOptions
from claimweave.plans.outcomes import read_outcome, write_outcomes
from claimweave.sources import Staging, Warehouse
from claimweave.sources.sinks import (
    damaged_files,
    publish_records,
    read_published,
    write_claims,
    write_records,
    write_staging,
)

__all__ = [
    "BuildOptions",
    "ClaimBuild",
    "HeaderOptions",
    "Staging",
    "Warehouse",
    "accepted",
    "build_claims",
    "damaged_files",
    "extract_records",
    "publish_records",
    "read_outcome",
    "read_published",
    "rejected",
    "stage_claims",
    "write_claims",
    "write_outcomes",
    "write_records",
    "write_staging",
]
