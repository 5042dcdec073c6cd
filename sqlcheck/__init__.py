"""DuckDB oracle SQL for the driver's side-by-side correctness check."""

from __future__ import annotations

from workgrid.config import Params, fixture_params

from .fixtures_sql import fixture_ctes
from .model_sql import model_ctes


# Read by several later CTEs: computed once.
SHARED = {
    "o_cal", "o_workdays", "o_staff", "o_taskname", "o_job1", "o_leave_rows", "o_leave_mpd", "o_leave", "o_base", "o_counts",
    "o_rec", "o_jtd", "o_ts1", "o_ts", "o_jts", "o_task_hours", "o_alloc",
}


def with_clause(p: Params, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = fixture_ctes(p) + model_ctes(p) + (extra or [])
    return "WITH " + ",\n".join(f"{name} AS {'MATERIALIZED ' * (name in SHARED)}(\n{body}\n)" for name, body in ctes)


def build(final_select: str, doubles: tuple[str, ...] = (), p: Params | None = None,
          extra: list[tuple[str, str]] | None = None) -> str:
    """Full statement; double columns are rounded to 6 places like the Spark side."""
    p = p or fixture_params()
    body = final_select
    if doubles:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({rep}) FROM (\n{final_select}\n) _r"
    return with_clause(p, extra) + "\n" + body
