"""Readers for the claims warehouse and for the staging tables of the extracts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.rules import not_deleted
from claimweave.operators.broadcast import broadcast_if_small, source_bytes
from claimweave.sources.schemas import STAGING_TABLES, WAREHOUSE_COLUMNS, conform


#: Files of this size hold some 50,000 versions at least, of which one key may have very many.
LARGE_HISTORY = 4 << 20


class Warehouse(Mapping[str, DataFrame]):
    """The source tables by lower-case name, each loaded on first use."""

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        names: Iterable[str] = tuple(WAREHOUSE_COLUMNS),
    ):
        self._load = load
        self._names = tuple(names)
        self._frames: dict[str, DataFrame] = {}
        self._codes: dict[str, DataFrame] = {}
        self._large: dict[str, bool] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = conform(self._load(name), name)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def codes(self, name: str) -> DataFrame:
        """A table of codes or dates, marked for broadcast where its size allows."""
        if name not in self._codes:
            self._codes[name] = broadcast_if_small(self[name])
        return self._codes[name]

    def large(self, name: str) -> bool:
        """Whether a history's files are large enough for as-of joins to meet its keys by time cells."""
        if name not in self._large:
            self._large[name] = source_bytes(self[name]) >= LARGE_HISTORY
        return self._large[name]

    def live(self, name: str) -> DataFrame:
        """Rows of a table that are not soft-deleted."""
        table = self[name]
        return table.filter(not_deleted(F.col("deleted_flag"))).drop("deleted_flag")

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, fmt: str = "parquet") -> Warehouse:
        """One folder or file per table below ``root``, in any format Spark reads."""
        return cls(lambda name: spark.read.format(fmt).load(f"{root}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> Warehouse:
        """Tables of one catalog database."""
        return cls(lambda name: spark.table(f"{database}.{name}"))

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Warehouse:
        names = [n for n in WAREHOUSE_COLUMNS if n in frames]
        return cls(lambda name: frames[name], names)


@dataclass(frozen=True)
class Staging:
    """Inputs of one extract: audit log, staged claims, staged lines, and the code lookup."""

    audit: DataFrame
    claims: DataFrame
    lines: DataFrame
    lookup: DataFrame | None = None

    @classmethod
    def from_files(
        cls, spark: SparkSession, root: str, claim_type: str, fmt: str = "parquet"
    ) -> Staging:
        kind = claim_type.lower()

        def read(name: str) -> DataFrame:
            if name not in STAGING_TABLES:
                raise ValueError(f"unknown staging table {name!r}")
            return spark.read.format(fmt).load(f"{root}/{name}")

        return cls._from(read, kind)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, claim_type: str) -> Staging:
        """Staging tables of a database of the session's catalog, under the names that files have."""
        return cls._from(lambda name: spark.table(f"{database}.{name}"), claim_type.lower())

    @classmethod
    def _from(cls, read: Callable[[str], DataFrame], kind: str) -> Staging:
        lookup = read("lookup") if kind == "institutional" else None
        return cls(read("audit"), read(f"claims_{kind}"), read(f"lines_{kind}"), lookup)
