"""Planning sheets: read, clean, type and load by full refresh.

Sheets arrive as CSV or Parquet files (one per sheet; workbook decoding is
outside this library). Cleaning is metadata work on the driver (column
names) plus two DataFrame operations (drop all-NULL rows, NaN to NULL).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.store import TableStore

# Identifiers of at most 63 characters; longer names keep 54 and a hash of 8.
MAX_IDENTIFIER = 63
KEPT_OF_LONG = 54
# Runs of anything but letters and digits separate the words of a name.
_SEPARATORS = re.compile(r"[\W_]+")
SHEET_PREFIX = "excel_"

LOAD_SCHEMA = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("sheet", T.StringType(), True),
    T.StructField("table_name", T.StringType(), True),
    T.StructField("view_name", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
])


def normalize_table_name(name: str) -> str:
    """Lower case, non-alphanumerics to ``_``, collapsed, stripped; long names get an md5 suffix."""
    out = _SEPARATORS.sub("_", name.lower()).strip("_")
    if len(out) <= MAX_IDENTIFIER:
        return out
    return f"{out[:KEPT_OF_LONG]}_{hashlib.md5(name.encode()).hexdigest()[:MAX_IDENTIFIER - KEPT_OF_LONG - 1]}"


def clean_column_name(name) -> str:
    """Column name usable as an identifier: ``col_`` before a leading digit, ``unnamed_column`` if empty."""
    out = _SEPARATORS.sub("_", str(name).lower()).strip("_")
    return re.sub(r"^(?=\d)", "col_", out) or "unnamed_column"


def clean_sheet(df: DataFrame) -> DataFrame:
    """Cleaned column names, NaN as NULL in floating columns, all-NULL rows dropped."""
    names = [clean_column_name(c) for c in df.columns]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"cleaned column names collide: {dupes}")
    out = df.toDF(*names)
    fixed = [
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in out.schema.fields
    ]
    return out.select(*fixed).na.drop(how="all")


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("mode", "FAILFAST")
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    elif schema is not None:
        r = r.schema(schema)
    return r.load(path)


def view_name_for(table_name: str) -> str:
    """View name: the table name without the ``excel_`` prefix; equal names are refused."""
    view = table_name.removeprefix(SHEET_PREFIX)
    if view == table_name:
        raise ValueError(f"table {table_name!r} has no {SHEET_PREFIX!r} prefix; its view would replace it")
    return view


def load_sheet(store: TableStore, table_name: str, df: DataFrame) -> tuple[str, str, int]:
    """Full refresh: publish the cleaned sheet as the table's next version and register its view."""
    table = normalize_table_name(table_name)
    view = view_name_for(table)
    store.publish(table, df)
    stored = store.read(table)
    stored.createOrReplaceTempView(view)
    return table, view, stored.count()


@dataclass
class SheetFile:
    """One file holding one sheet, and the table prefix to load it under."""

    path: str
    sheet: str
    fmt: str = "csv"
    schema: T.StructType | str | None = None


def sync_sheet_files(spark: SparkSession, store: TableStore, files: Sequence[SheetFile],
                     table_prefix: str = SHEET_PREFIX, skip_empty: bool = True) -> DataFrame:
    """Load many sheet files; a failing sheet is recorded and the other files go on."""
    rows: list = []
    for f in files:
        try:
            df = clean_sheet(read_sheet(spark, f.path, f.fmt, f.schema))
            if skip_empty and df.isEmpty():
                rows.append((f.path, f.sheet, None, None, "skipped", 0, "empty sheet"))
                continue
            table, view, n = load_sheet(store, f"{table_prefix}{f.sheet}", df)
            rows.append((f.path, f.sheet, table, view, "ok", n, None))
        except Exception as exc:
            rows.append((f.path, f.sheet, None, None, "failed", None, f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(rows, LOAD_SCHEMA)
