"""Schema and contents of tables, one row per column: type, nullability, key, NULL cells, extremes, distinct values, sample.

All statistics of a table come from one aggregate over it; the key is checked
for uniqueness on its own columns, the sample is read in key order, and the
bytes on disk come from the file system's listing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of the sample (the number of rows is the feature).
SAMPLE_ROWS = 3


def as_text(column: str, kind: T.DataType) -> Column:
    """A value as text of one form: decimals with six places, timestamps with microseconds, NULL for nested values."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.round(c.cast("double"), 6).cast("decimal(38,6)").cast("string")
    if isinstance(kind, T.DecimalType):
        return c.cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        return F.lit(None).cast("string")
    return c.cast("string")


def is_unique(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether no key value occurs twice, and none has a NULL."""
    null = F.lit(False)
    for c in key:
        null = null | F.col(c).isNull()
    return df.groupBy(*key).count().where((F.col("count") > 1) | null).isEmpty()


def column_rows(name: str, df: DataFrame, key: Sequence[str] = (), distinct: bool = True) -> DataFrame:
    """The profile of one table.

    ``is_key`` holds for the columns of ``key`` if it is unique. ``min_value`` and ``max_value`` are texts, NULL for
    nested columns; ``distinct_about`` is an estimate (left out without ``distinct``); ``sample`` joins the column's
    values in the first rows by key (by all plain columns without one).
    """
    fields = df.schema.fields
    nested = lambda f: isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_if(c.isNull()).alias(f"_null{i}"))
        if not nested(f):
            aggs += [F.min(c).alias(f"_min{i}"), F.max(c).alias(f"_max{i}")]
        if distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_some{i}"))
    key_holds = bool(key) and is_unique(df, key)
    order = list(key) or [f"`{f.name}`" for f in fields if not nested(f)]
    first = df.orderBy(*order).limit(SAMPLE_ROWS)
    texts = F.struct(*[as_text(f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(fields)])
    sample = first.select(F.struct(*order).alias("_o"), texts.alias("_t")).agg(F.array_sort(F.collect_list(F.struct("_o", "_t"))).alias("_s"))
    one = df.agg(*aggs).withColumn("_s", sample.scalar())

    def row(i: int, f: T.StructField) -> Column:
        text = lambda at: F.lit(None).cast("string") if nested(f) else as_text(f"{at}{i}", f.dataType)
        values = F.transform("_s", lambda x: F.coalesce(x["_t"][f"c{i}"], F.lit("NULL")))
        cells = [
            F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.lit(key_holds and f.name in key).alias("is_key"),
            F.col("_rows").alias("row_count"), F.col(f"_null{i}").alias("null_cells"),
            text("_min").alias("min_value"), text("_max").alias("max_value"),
            F.when(F.lit(nested(f)), F.lit(None).cast("string")).otherwise(F.array_join(values, " | ")).alias("sample"),
        ]
        if distinct:
            cells.append(F.col(f"_some{i}").alias("distinct_about"))
        return F.struct(*cells)

    return one.select(F.explode(F.array(*[row(i, f) for i, f in enumerate(fields)])).alias("r")).select(
        F.lit(name).alias("table_name"), "r.*")


def schema_profile(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], distinct: bool = True) -> DataFrame:
    """One row per column of every table."""
    out = None
    for name, df in tables.items():
        one = column_rows(name, df, keys.get(name, ()), distinct)
        out = one if out is None else out.unionByName(one)
    return out


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a table, from the file system's listing; hidden files do not count."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files, total = fs.listFiles(at, True), 0
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            total += f.getLen()
    return total


def table_sizes(spark: SparkSession, paths: Mapping[str, str], top: int = 20) -> DataFrame:
    """(table_name, bytes) of the ``top`` largest tables, largest first."""
    rows = sorted(((n, table_bytes(spark, p)) for n, p in paths.items()), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "table_name string, bytes long")
