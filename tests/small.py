"""Hand-made warehouse rows (every table present, columns not given are NULL), and rows as values."""

from claimweave.sources import Warehouse
from claimweave.sources.schemas import WAREHOUSE_COLUMNS, column_type


def table(spark, name, *rows):
    columns = WAREHOUSE_COLUMNS[name].split()
    unknown = {key for row in rows for key in row} - set(columns)
    assert not unknown, unknown
    schema = ", ".join(f"{c} {column_type(c)}" for c in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def warehouse(spark, **rows):
    """A warehouse from keyword arguments, one list of row dictionaries per table."""
    return Warehouse.from_frames(
        {name: table(spark, name, *rows.get(name, [])) for name in WAREHOUSE_COLUMNS}
    )


FOREVER = {"version_eff_date_key": 19900101, "version_exp_date_key": 99991231}


def values(df, *columns):
    """Rows as plain tuples, sorted with NULL first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))
