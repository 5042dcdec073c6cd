"""Oracle statement per registered query key."""

from __future__ import annotations

from workgrid.config import fixture_params

from . import build
from .doubles import DOUBLES

# Final SELECT over the oracle CTEs, per query key.
FINAL = {
    "staff": "SELECT * FROM o_staff",
    "task_type": "SELECT * FROM o_tasktype",
    "task_name": "SELECT * FROM o_taskname",
    "job": "SELECT * FROM o_job",
    "leave_status": "SELECT * FROM o_leave",
    "calendar_counts": """SELECT b.job_task_staff_id, coalesce(k.wdb_cnt, 0) AS wdb_cnt, coalesce(k.tlh_hrs, 0) AS tlh_hrs,
  coalesce(k.ttl_cnt, 0) AS ttl_cnt, coalesce(k.wdl_cnt, 0) AS wdl_cnt, coalesce(k.arwd_cnt, 0) AS arwd_cnt,
  coalesce(k.rttl_cnt, 0) AS rttl_cnt, coalesce(k.pwdl_cnt, 0) AS pwdl_cnt, coalesce(k.pttl_cnt, 0) AS pttl_cnt
FROM o_base b LEFT JOIN o_counts k ON k.job_task_staff_id = b.job_task_staff_id""",
    "recorded_minutes": "SELECT * FROM o_rec",
    "job_task_details": "SELECT * FROM o_jtd",
    "timesheet": "SELECT * FROM o_ts",
    "invoice_timing": """SELECT timesheet_uuid, invoice_task_id, invoice_number, month_time_recorded, month_time_invoiced,
  month_invoiced_on, recorded_hours_invoiced FROM o_ts""",
    "keys_time": "SELECT * FROM o_keys_time",
    "job_task_staff": "SELECT * FROM o_jts",
    "recorded_task_hours": "SELECT * FROM o_task_hours",
    "allocation_by_day": "SELECT * FROM o_alloc",
    "is_billable": "SELECT DISTINCT billable_selector FROM o_alloc",
    "allocation_hours_agg": "SELECT * FROM o_alloc_agg",
    "timesheet_hours_agg": "SELECT * FROM o_ts_agg",
    "targets": "SELECT * FROM o_targets",
    "staff_performance": "SELECT * FROM o_perf",
}


def oracle_statements() -> dict[str, str]:
    p = fixture_params()
    out = {k: build(v, DOUBLES.get(k, ()), p) for k, v in FINAL.items()}
    try:
        from .ingest_sql import ingest_statements
    except ImportError:  # pragma: no cover
        return out
    out.update(ingest_statements(p))
    return out
