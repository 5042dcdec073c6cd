"""Column expressions for the business rules shared by several tables.

All of them are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (
    CATEGORY_ADMIN,
    CATEGORY_BILLABLE,
    CATEGORY_LEAVE,
    HOLIDAY_PATTERN,
    LEAVE_PATTERNS,
    OTHER_LEAVE_PATTERNS,
    Params,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ilike_any(col, patterns) -> Column:
    """Case-insensitive containment of any constant fragment (SQL ILIKE '%p%')."""
    c = _c(col)
    out = None
    for p in patterns:
        term = c.ilike(f"%{p}%")
        out = term if out is None else (out | term)
    return out


def is_leave_name(name) -> Column:
    return ilike_any(name, LEAVE_PATTERNS)


def is_holiday_name(name) -> Column:
    return ilike_any(name, (HOLIDAY_PATTERN,))


def is_other_leave_name(name) -> Column:
    return ilike_any(name, OTHER_LEAVE_PATTERNS)


def is_admin(name, client, params: Params) -> Column:
    """Admin task: name holds the admin task, or the client is the admin client.

    Three-valued like SQL: NULL when the client is NULL and the name does not match.
    """
    return _c(name).ilike(f"%{params.admin_task}%") | (_c(client) == params.admin_client)


def task_category(name, client, params: Params) -> Column:
    """Leave / Admin / Billable; NULL conditions fall through to Billable."""
    return (
        F.when(is_leave_name(name), F.lit(CATEGORY_LEAVE))
        .when(is_admin(name, client, params), F.lit(CATEGORY_ADMIN))
        .otherwise(F.lit(CATEGORY_BILLABLE))
    )


def window_start(task_start, job_start) -> Column:
    return F.coalesce(_c(task_start), _c(job_start))


def window_end(task_due, job_completed, job_due) -> Column:
    """Task due date, else the earlier of the job's completed and due dates."""
    jc, jd = _c(job_completed), _c(job_due)
    return F.coalesce(_c(task_due), F.when(jc.isNull(), jd).otherwise(F.least(jc, jd)))


def week_of_month(d) -> Column:
    """1 + week(date) - week(first of month), weeks starting Sunday, week 1 holds Jan 1."""
    d = _c(d)
    jan1_dow = (F.dayofweek(F.trunc(d, "year")) - 1).cast("double")
    wk = lambda doy: F.ceil((doy.cast("double") + jan1_dow) / 7.0).cast("int")
    return (F.lit(1) + wk(F.dayofyear(d)) - wk(F.dayofyear(F.trunc(d, "month")))).cast("int")
