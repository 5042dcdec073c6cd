"""Oracle SQL for the ingest and publish queries."""

from __future__ import annotations

from workgrid.config import Params
from workgrid.plans.model import CONTENT_COLUMNS
from workgrid.queries_ingest import DRIVER_KEYS, SHEET_CONTENT, SYNCED_CONTENT, batch_times

from . import build

SRC_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "cents")

# Driver table columns (FIXTURES.md part 3), for the profile oracle.
DRIVER_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": ("event_id", "ts", "user_id", "event_type", "value", "props"),
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "embeddings": ("vec_id", "embedding", "label"),
    "pages": ("page_id", "url", "html"),
    "benchmark": ("item_id", "text"),
    "labels": ("doc_id", "quality", "toxic"),
    "conversations": ("conv_id", "turn", "role", "text"),
}


def _hash(prefix: str = "") -> str:
    parts = ", ".join(f"coalesce(cast({prefix}{c} AS VARCHAR), 'NULL')" for c in SRC_COLS)
    return f"md5(concat_ws('|', {parts}))"


def _content(cols) -> str:
    """Sum of the first 32 md5 bits of every row's joined columns."""
    parts = ", ".join(f"coalesce(cast({c} AS VARCHAR), 'NULL')" for c in cols)
    return f"cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {parts})), 1, 8) AS BIGINT)), 0) AS BIGINT)"


def _history(table: str) -> str:
    """The stored history after both batches, as far as its checksum reads it."""
    if table == "sync_dbo_ordersnap":
        return "x_h2"
    source = {"sync_dbo_customersnap": "customer", "sync_dbo_suppliersnap": "supplier", "sync_dbo_nationsnap": "nation"}[table]
    one = f"SELECT *, true AS _scd_is_current FROM {source}"
    return f"({one} UNION ALL {one})" if table == "sync_dbo_suppliersnap" else f"({one})"


def scd_ctes() -> list[tuple[str, str]]:
    t1, t2 = batch_times()
    s1, s2 = t1.isoformat(sep=" "), t2.isoformat(sep=" ")
    cols = ", ".join(SRC_COLS)
    return [
        ("x_b1", f"SELECT {cols}, {_hash()} AS _scd_source_hash FROM scd_batch1"),
        ("x_b2", f"SELECT {cols}, {_hash()} AS _scd_source_hash FROM scd_batch2"),
        ("x_h1", f"""SELECT {cols}, md5('{s1}' || '|' || _scd_source_hash) AS _scd_id,
  TIMESTAMP '{s1}' AS _scd_valid_from, cast(NULL AS TIMESTAMP) AS _scd_valid_to, true AS _scd_is_current,
  _scd_source_hash FROM x_b1"""),
        ("x_cls", """SELECT b.o_orderkey, b.o_custkey, b.o_orderstatus, b.cents, b._scd_source_hash,
  CASE WHEN h._scd_id IS NULL THEN 'new' WHEN h._scd_source_hash = b._scd_source_hash THEN 'unchanged'
       ELSE 'changed' END AS _change,
  CASE WHEN h._scd_id IS NOT NULL AND h._scd_source_hash <> b._scd_source_hash THEN h._scd_id END AS _old_id
FROM x_b2 b LEFT JOIN x_h1 h ON h._scd_is_current AND h.o_orderkey IS NOT DISTINCT FROM b.o_orderkey"""),
        ("x_h2", f"""SELECT h.o_orderkey, h.o_custkey, h.o_orderstatus, h.cents, h._scd_id, h._scd_valid_from,
  CASE WHEN c._old_id IS NOT NULL THEN TIMESTAMP '{s2}' ELSE h._scd_valid_to END AS _scd_valid_to,
  CASE WHEN c._old_id IS NOT NULL THEN false ELSE h._scd_is_current END AS _scd_is_current, h._scd_source_hash
FROM x_h1 h LEFT JOIN (SELECT DISTINCT _old_id FROM x_cls WHERE _change = 'changed') c ON c._old_id = h._scd_id
UNION ALL
SELECT {cols}, md5('{s2}' || '|' || _scd_source_hash), TIMESTAMP '{s2}', cast(NULL AS TIMESTAMP), true, _scd_source_hash
FROM x_cls WHERE _change <> 'unchanged'"""),
        ("x_h2_nokey", f"""SELECT * FROM x_h1
UNION ALL
SELECT {cols}, md5('{s2}' || '|' || _scd_source_hash), TIMESTAMP '{s2}', cast(NULL AS TIMESTAMP), true, _scd_source_hash
FROM x_b2"""),
    ]


def _sync_rows() -> str:
    def row(table, new, changed, unchanged, batch):
        return (f"SELECT '{table}' AS table_name, 'ok' AS status, cast(({new}) AS BIGINT) AS new, "
                f"cast(({changed}) AS BIGINT) AS changed, cast(({unchanged}) AS BIGINT) AS unchanged, "
                f"cast(NULL AS VARCHAR) AS error, {batch} AS batch, (SELECT count(*) FROM {_history(table)}) AS history_rows, "
                f"(SELECT count(*) FROM {_history(table)} WHERE _scd_is_current) AS current_rows, "
                f"(SELECT {_content(SYNCED_CONTENT[table])} FROM {_history(table)}) AS content_hash")
    n = lambda t: f"SELECT count(*) FROM {t}"
    c = lambda k: f"SELECT count(*) FROM x_cls WHERE _change = '{k}'"
    rows = [
        row("sync_dbo_ordersnap", n("scd_batch1"), "0", "0", 1),
        row("sync_dbo_customersnap", n("customer"), "0", "0", 1),
        row("sync_dbo_suppliersnap", n("supplier"), "0", "0", 1),
        row("sync_dbo_nationsnap", n("nation"), "0", "0", 1),
        row("sync_dbo_ordersnap", c("new"), c("changed"), c("unchanged"), 2),
        row("sync_dbo_customersnap", "0", "0", n("customer"), 2),
        row("sync_dbo_suppliersnap", n("supplier"), "0", "0", 2),
        row("sync_dbo_nationsnap", "0", "0", n("nation"), 2),
    ]
    return "\nUNION ALL\n".join(rows)


def _profile() -> str:
    parts = []
    for t, cols in DRIVER_COLUMNS.items():
        nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
        parts.append(f"SELECT '{t}' AS table_name, count(*) AS row_count, cast({len(cols)} AS BIGINT) AS column_count, "
                     f"cast({nulls} AS BIGINT) AS null_cells FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _columns() -> str:
    parts = []
    for t, cols in DRIVER_COLUMNS.items():
        parts += [f"SELECT '{t}' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, count(*) AS row_count, "
                  f"count(*) - count({c}) AS null_cells FROM {t}" for i, c in enumerate(cols)]
    return "\nUNION ALL\n".join(parts)


# Column types of the driver tables as Spark names them, by DuckDB's name.
TYPE_NAMES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
              "FLOAT[]": "array<float>"}
TEXT_FORMS = {  # columns whose text form is not the plain cast
    "cents": "cast(cast(round({c}, 6) AS DECIMAL(38, 6)) AS VARCHAR)", "time": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')", "nested": "NULL",
}
FORM = {
    **dict.fromkeys(("c_acctbal", "s_acctbal", "p_retailprice", "o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "value"), "cents"),
    **dict.fromkeys(("o_orderdate", "l_shipdate", "ts"), "time"), "embedding": "nested",
}


def _schema() -> str:
    kinds = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_NAMES.items())
    parts = []
    for t, cols in DRIVER_COLUMNS.items():
        key = DRIVER_KEYS[t]
        order = ", ".join(key)
        unique = f"(SELECT count(*) = count(DISTINCT ({order})) AND " + " AND ".join(f"count({k}) = count(*)" for k in key) + f" FROM {t})"
        for i, c in enumerate(cols):
            form = TEXT_FORMS.get(FORM.get(c), "cast({c} AS VARCHAR)")
            text = lambda x: form.format(c=x)
            nested = FORM.get(c) == "nested"
            sample = "NULL" if nested else (f"(SELECT string_agg(coalesce({text(c)}, 'NULL'), ' | ' ORDER BY {order}) "
                                            f"FROM (SELECT * FROM {t} ORDER BY {order} LIMIT 3))")
            ends = ["CAST(NULL AS VARCHAR)"] * 2 if nested else [text(f"min({c})"), text(f"max({c})")]
            parts.append(
                f"SELECT '{t}' AS table_name, {i + 1} AS ordinal, '{c}' AS column_name, CASE typeof(any_value({c})) {kinds} END AS data_type, "
                f"true AS nullable, {unique if c in key else 'false'} AS is_key, count(*) AS row_count, count(*) - count({c}) AS null_cells, "
                f"{ends[0]} AS min_value, {ends[1]} AS max_value, {sample} AS sample FROM {t}")
    return "\nUNION ALL\n".join(parts)


STAGE_ORACLE = (
    ("leave_status", "o_leave"), ("job_task_details", "o_jtd"), ("timesheet", "o_ts"),
    ("job_task_staff", "o_jts"), ("allocation_by_day", "o_alloc"), ("staff_performance", "o_perf"),
)


def ingest_statements(p: Params) -> dict[str, str]:
    from .doubles import DOUBLES

    x = scd_ctes()
    cols = ", ".join(SRC_COLS)
    sheets = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS sheet, 'excel_{n}' AS table_name, '{n}' AS view_name, 'ok' AS status, "
        f"(SELECT count(*) FROM {n}) AS row_count, cast(NULL AS VARCHAR) AS error, "
        f"(SELECT {_content(cols)} FROM {n}) AS content_hash"
        for n, cols in SHEET_CONTENT.items()
    )
    chain = "\nUNION ALL\n".join(
        f"SELECT {i + 1} AS step, '{name}' AS table_name, 'ok' AS status, (SELECT count(*) FROM {cte}) AS row_count, "
        f"(SELECT {_content(CONTENT_COLUMNS[name])} FROM {cte}) AS content_hash, cast(NULL AS VARCHAR) AS error"
        for i, (name, cte) in enumerate(STAGE_ORACLE)
    )
    views = "\nUNION ALL\n".join(
        f"SELECT 'pbi_{name}' AS view_name, (SELECT count(*) FROM {cte}) AS row_count, "
        f"(SELECT {_content(CONTENT_COLUMNS[name])} FROM {cte}) AS content_hash" for name, cte in STAGE_ORACLE
    )
    return {
        "row_hash": build("SELECT * FROM x_b1", p=p, extra=x),
        "scd2_classify": build("SELECT * FROM x_cls", p=p, extra=x),
        "scd2_apply": build("SELECT * FROM x_h2", p=p, extra=x),
        "scd2_no_key": build("SELECT * FROM x_h2_nokey", p=p, extra=x),
        "scd2_current": build(f"SELECT {cols} FROM x_h2 WHERE _scd_is_current", p=p, extra=x),
        "scd2_summary": build("""SELECT count(*) FILTER (WHERE _change = 'new') AS new,
  count(*) FILTER (WHERE _change = 'changed') AS changed,
  count(*) FILTER (WHERE _change = 'unchanged') AS unchanged FROM x_cls""", p=p, extra=x),
        "multi_table_sync": build(_sync_rows(), p=p, extra=x),
        "sheet_clean": build(
            "SELECT staffname AS staff_name, day_of_week, working_day, adjustment_factor FROM workable_days",
            ("adjustment_factor",), p=p),
        "full_refresh": build(sheets, p=p),
        "materialise_unique": build("SELECT * FROM o_leave", DOUBLES.get("leave_status", ()), p=p),
        "refresh_chain": build(chain, p=p),
        "bi_views": build(views, p=p),
        "table_profile": build(_profile(), p=p),
        "column_profile": _columns(),
        "schema_profile": _schema(),
    }
