"""Helpers shared by the operators: tables, stored intermediates, Arrow row mapping, let-bindings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and Python form of a word: a run of anything but space, tab, line and page breaks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only on a local master without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a parquet table in the shared folder: lineage ends here and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_name(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's name, never null: the digest of its text, after its doc_id where there is one.

    Rows that repeat a doc_id with another text have other names; rows without one are named by their text.
    """
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    named = F.concat(F.lit("id:"), F.col(doc_id).cast("string"), F.lit(":"), digest)
    return F.coalesce(named, F.concat(F.lit("text:"), digest))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def map_batches(
    df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str, rows: int = 512
) -> DataFrame:
    """Run a function of column lists over slices of at most `rows` rows, in Arrow batches.

    make() runs once per task, so that tables and caches are built there. Only one slice of input and
    its output are alive as Python objects at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(target)
    names = target.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = apply({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[n], type=arrow.field(n).type) for n in names], schema=arrow
                )

    return df.mapInArrow(run, target)
