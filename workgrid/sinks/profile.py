"""Table profile: columns, types, nullability, null counts, row counts, sample.

Row and NULL counts of one table come from a single aggregate pass
(``count`` + one ``count_if(col IS NULL)`` per column), so the profile costs
one scan per table whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_PROFILE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("nullable", T.BooleanType(), False),
])


def column_profile(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: table, ordinal, name, type, nullability (schema metadata only)."""
    rows = [
        (name, i + 1, f.name, f.dataType.simpleString(), bool(f.nullable))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, COLUMN_PROFILE_SCHEMA)


def table_counts(name: str, df: DataFrame) -> DataFrame:
    """(table_name, row_count, column_count, null_cells) in one aggregate over the table."""
    nulls = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = nulls[0] if nulls else F.lit(0)
    for n in nulls[1:]:
        total = total + n
    return df.agg(F.count(F.lit(1)).alias("row_count"), total.cast("bigint").alias("null_cells")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "null_cells",
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_counts`` for every table, as one DataFrame."""
    frames = [table_counts(n, df) for n, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sample_rows(df: DataFrame, n: int = 3) -> list[list[str]]:
    """``n`` rows as text, all columns and whole values (the number of rows is the feature)."""
    return [["NULL" if v is None else str(v) for v in r] for r in df.limit(n).collect()]


def column_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, ordinal, column_name, row_count, null_cells) per column; one aggregate per table, unpivoted."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
        cells = F.array(*[
            F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_cells"))
            for i, c in enumerate(df.columns)
        ])
        rows = one.select("_rows", F.explode(cells).alias("c")).select(
            F.lit(name).alias("table_name"), "c.ordinal", "c.column_name", F.col("_rows").alias("row_count"), "c.null_cells")
        out = rows if out is None else out.unionByName(rows)
    return out

