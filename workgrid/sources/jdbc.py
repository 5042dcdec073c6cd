"""Relational source over JDBC: discover tables, columns and keys; read in parallel.

Reads go through Spark's JDBC data source on the executors. When the table
has an integer column to split on, the read is range-partitioned
(``partitionColumn`` / ``lowerBound`` / ``upperBound`` / ``numPartitions``),
so no single task pulls the whole table. The bounds come from one
``min``/``max`` query pushed to the database.

No database is started by this library or its tests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scd2_store import SourceTable

# ---------------------------------------------------------------------------
# Source column type (lower case) -> Spark SQL type.
# Unknown types fall back to string.
# ---------------------------------------------------------------------------
SOURCE_TYPES = {
    "varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string",
    "text": "string", "ntext": "string", "xml": "string", "time": "string",
    "int": "int", "integer": "int", "bigint": "bigint", "smallint": "smallint", "tinyint": "smallint",
    "bit": "boolean",
    "money": "decimal(19,4)", "smallmoney": "decimal(19,4)",
    "float": "double", "real": "double",
    "datetime": "timestamp_ntz", "datetime2": "timestamp_ntz", "smalldatetime": "timestamp_ntz",
    "date": "date", "datetimeoffset": "timestamp",
    "binary": "binary", "varbinary": "binary", "image": "binary",
    "uniqueidentifier": "string",
}
SYSTEM_SCHEMAS = ("INFORMATION_SCHEMA", "sys")
# ---------------------------------------------------------------------------


def spark_type(data_type: str, precision: int | None = None, scale: int | None = None) -> str:
    t = (data_type or "").lower()
    if t in ("decimal", "numeric"):
        return f"decimal({precision or 18},{scale or 0})"
    return SOURCE_TYPES.get(t, "string")


def typed_column(name: str, data_type: str, precision: int | None = None, scale: int | None = None) -> Column:
    """Cast one source column; identifiers (uniqueidentifier) are lower-cased once here."""
    c = F.col(name).cast(spark_type(data_type, precision, scale))
    if (data_type or "").lower() == "uniqueidentifier":
        c = F.lower(c)
    return c.alias(name)


def typed_projection(df: DataFrame, columns: Sequence[Mapping]) -> DataFrame:
    """Select the source columns in ordinal order with their mapped types.

    ``columns``: rows with ``name``, ``data_type`` and optionally ``precision``/``scale``.
    """
    return df.select(*[typed_column(c["name"], c["data_type"], c.get("precision"), c.get("scale")) for c in columns])


def literal(name: str) -> str:
    """A name as a quoted SQL string."""
    return "'" + name.replace("'", "''") + "'"


def identifier(name: str) -> str:
    """A name as a quoted SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


def _reader(spark: SparkSession, url: str, props: Mapping[str, str]):
    r = spark.read.format("jdbc").option("url", url)
    for k, v in props.items():
        r = r.option(k, v)
    return r


def query(spark: SparkSession, url: str, sql: str, props: Mapping[str, str] | None = None) -> DataFrame:
    return _reader(spark, url, props or {}).option("query", sql).load()


def list_tables(spark: SparkSession, url: str, props: Mapping[str, str] | None = None,
                schemas: Sequence[str] | None = None) -> DataFrame:
    """Base tables (schema, table), system schemas excluded, optional schema filter, ordered."""
    df = query(spark, url, "SELECT TABLE_SCHEMA AS table_schema, TABLE_NAME AS table_name FROM INFORMATION_SCHEMA.TABLES "
                           "WHERE TABLE_TYPE = 'BASE TABLE'", props)
    df = df.where(~F.col("table_schema").isin(*SYSTEM_SCHEMAS))
    if schemas:
        df = df.where(F.col("table_schema").isin(*schemas))
    return df.orderBy("table_schema", "table_name")


def table_columns(spark: SparkSession, url: str, schema: str, table: str,
                  props: Mapping[str, str] | None = None) -> DataFrame:
    """Column metadata in ordinal order."""
    sql = ("SELECT COLUMN_NAME AS name, DATA_TYPE AS data_type, NUMERIC_PRECISION AS precision, "
           "NUMERIC_SCALE AS scale, IS_NULLABLE AS nullable, ORDINAL_POSITION AS ordinal "
           f"FROM INFORMATION_SCHEMA.COLUMNS WHERE TABLE_SCHEMA = {literal(schema)} AND TABLE_NAME = {literal(table)}")
    return query(spark, url, sql, props).orderBy("ordinal")


def primary_key(spark: SparkSession, url: str, schema: str, table: str, props: Mapping[str, str] | None = None,
                default_key: str = "id", column_names: Sequence[str] = ()) -> list[str]:
    """Primary-key columns in order; else ``default_key`` when such a column exists; else none."""
    sql = ("SELECT k.COLUMN_NAME AS name, k.ORDINAL_POSITION AS ordinal FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS c "
           "JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE k ON c.CONSTRAINT_NAME = k.CONSTRAINT_NAME "
           "AND c.TABLE_SCHEMA = k.TABLE_SCHEMA AND c.TABLE_NAME = k.TABLE_NAME "
           f"WHERE c.CONSTRAINT_TYPE = 'PRIMARY KEY' AND c.TABLE_SCHEMA = {literal(schema)} AND c.TABLE_NAME = {literal(table)}")
    keys = [r["name"] for r in query(spark, url, sql, props).orderBy("ordinal").collect()]
    if keys:
        return keys
    return [default_key] if default_key in column_names else []


#: Hash of a column's value, and of a row, as a signed integer in the source's SQL.
VALUE_HASH, ROW_HASH = "CHECKSUM({})", "CHECKSUM(*)"


def scan_predicates(column: str | None, parts: int, value_hash: str = VALUE_HASH, row_hash: str = ROW_HASH) -> list[str]:
    """Conditions that cut a table into ``parts`` disjoint parts and, with a column, one more for its NULLs.

    For keys without a numeric range (text, decimal, date, uuid) by a hash of
    the column, without any key by a hash of the row. Every row meets exactly
    one condition, whatever its values.
    """
    if column is None:
        # A widened hash: the smallest integer has no absolute value of its own type.
        return [f"ABS(CAST({row_hash} AS BIGINT)) % {parts} = {i}" for i in range(parts)]
    name = identifier(column)
    hashed = f"ABS(CAST({value_hash.format(name)} AS BIGINT)) % {parts}"
    return [f"{name} IS NULL", *(f"{name} IS NOT NULL AND {hashed} = {i}" for i in range(parts))]


def range_predicates(column: str, low: int, high: int, parts: int) -> list[str]:
    """Conditions that cut a table by ranges of an integer column; the outer ranges are open, one more part holds the NULLs."""
    name = identifier(column)
    step = max(1, -(-(high - low + 1) // parts))
    cuts = list(range(low + step, high + 1, step))
    if not cuts:
        return [f"{name} IS NULL", f"{name} IS NOT NULL"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{name} IS NULL", f"{name} < {cuts[0]}", *inner, f"{name} >= {cuts[-1]}"]


INTEGER_KINDS = ("int", "bigint", "smallint")


def read_table(spark: SparkSession, url: str, table: str, props: Mapping[str, str] | None = None,
               partition_column: str | None = None, partition_kind: str | None = None, num_partitions: int = 64,
               fetch_size: int = 10_000) -> DataFrame:
    """Full scan of one table in ``num_partitions`` parts.

    By ranges of ``partition_column`` where its ``partition_kind`` is an
    integer, by a hash of it for any other kind, and by a hash of the row
    without a column; NULL keys are one more part.
    """
    props = {**(props or {}), "fetchsize": str(fetch_size)}
    predicates = scan_predicates(partition_column, num_partitions)
    if partition_column and partition_kind in INTEGER_KINDS:
        name = identifier(partition_column)
        b = query(spark, url, f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {table}", props).first()
        if b is not None and b["lo"] is not None:
            predicates = range_predicates(partition_column, int(b["lo"]), int(b["hi"]), num_partitions)
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def source_tables(spark: SparkSession, url: str, props: Mapping[str, str] | None = None,
                  schemas: Sequence[str] | None = None, prefix: str = "sync", default_key: str = "id") -> list[SourceTable]:
    """Every base table as an entry of the multi-table sync: typed scan, key from the database's own constraints.

    Only metadata (a row per table and column) reaches the driver. The first
    key column partitions the scan, or the whole row where there is no key.
    """
    out = []
    for t in list_tables(spark, url, props, schemas).collect():
        schema, table = t["table_schema"], t["table_name"]
        columns = [r.asDict() for r in table_columns(spark, url, schema, table, props).collect()]
        keys = primary_key(spark, url, schema, table, props, default_key, [c["name"] for c in columns])
        kinds = {c["name"]: spark_type(c["data_type"], c.get("precision"), c.get("scale")) for c in columns}
        by = keys[0] if keys else None

        def load(schema=schema, table=table, columns=columns, by=by, kind=kinds.get(by)):
            name = f"{identifier(schema)}.{identifier(table)}"
            return typed_projection(read_table(spark, url, name, props, partition_column=by, partition_kind=kind), columns)

        out.append(SourceTable(f"{prefix}_{schema}_{table}".lower(), load, keys or None))
    return out
