"""Model parameters.

Every date the model compares against is a parameter (``as_of`` replaces a
wall-clock "today"), so a rerun over the same inputs gives the same rows.
People and company labels are configuration, never code.
"""

from __future__ import annotations

import calendar as _calendar
from dataclasses import dataclass, replace
from datetime import date

# ---------------------------------------------------------------------------
# These must equal the values the source model uses, because
# task names and metric labels in the data are matched against them.
# ---------------------------------------------------------------------------
# Task-name fragments that mark a leave task (case-insensitive containment).
LEAVE_PATTERNS = ("Holiday", "Sick leave", "Other leave")
# Fragment for annual holiday; the other two fragments count as "other leave".
HOLIDAY_PATTERN = "Holiday"
OTHER_LEAVE_PATTERNS = ("Sick leave", "Other leave")
# Minutes that make a full working day, and hours per working day.
FULL_DAY_MINUTES = 480
HOURS_PER_DAY = 8
# Task names that keep their own name as task type.
ONLINE_TASK_NAMES = ("Online content creation", "Online content management")
# Incentive display metrics, in order.
DISPLAY_METRICS = (
    "1. Allocated Billable Hours",
    "2. Recorded Billable Hours",
    "3. Invoiced Billable Hours",
    "4. % Allocated to Billable Hours",
    "5. % Recorded to Billable Hours",
    "6. % Invoiced to Billable Hours",
)
# Target metric label per display metric position (1-based), others: invoiced.
TARGET_METRIC_ALLOCATED = "Target Metric: Hours to be Allocated"
TARGET_METRIC_RECORDED = "Target Metric: Hours to be Recorded"
TARGET_METRIC_INVOICED = "Target Metric: Hours to be Invoiced"
METRIC_NAME_PREFIX = "Selected Metric: "
# Category labels.
CATEGORY_LEAVE = "Leave Tasks"
CATEGORY_ADMIN = "Admin Tasks"
CATEGORY_BILLABLE = "Billable Tasks"
# Invoicing labels.
INVOICED = "Invoiced"
UN_INVOICED = "Un-Invoiced"
BILLABLE = "Billable"
NOT_BILLABLE = "Not Billable"
JOB_COMPLETED_STATE = "Completed"
TIMING_UN_INVOICED = "5_Un-Invoiced"
TIMING_SAME = "1_Same Month"
TIMING_FOLLOWING = "2_Following Month"
TIMING_THIRD = "3_Third Month"
TIMING_FOURTH_PLUS = "4_Fourth Month +"
# ---------------------------------------------------------------------------


def end_of_month(d: date) -> date:
    return d.replace(day=_calendar.monthrange(d.year, d.month)[1])


def add_months(d: date, n: int) -> date:
    m = d.month - 1 + n
    y = d.year + m // 12
    m = m % 12 + 1
    return date(y, m, min(d.day, _calendar.monthrange(y, m)[1]))


@dataclass(frozen=True)
class Params:
    """Everything the gold model needs besides its input tables."""

    as_of: date
    calendar_start: date = date(2020, 1, 1)
    timesheet_cutoff: date = date(2020, 1, 1)
    admin_cutoff: date = date(2021, 2, 1)
    invoicing_floor: date = date(2020, 4, 30)
    admin_client: str = "Internal Admin"
    admin_task: str = "Admin - Non-billable"
    coaching_type: str = "Coaching"
    internal_time_label: str = "Internal Time"
    excluded_staff: tuple[str, ...] = ()
    excluded_task_staff: tuple[str, ...] = ()
    # Months after as_of's month that the calendar still covers.
    calendar_months_ahead: int = 3

    @property
    def calendar_end(self) -> date:
        """Last day of the third month after as_of's month."""
        return end_of_month(add_months(self.as_of.replace(day=1), self.calendar_months_ahead))

    @property
    def as_of_month_end(self) -> date:
        return end_of_month(self.as_of)

    @property
    def calendar_days(self) -> int:
        return (self.calendar_end - self.calendar_start).days + 1

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


def fixture_params() -> Params:
    """Parameters that go with the fixture tables derived from the driver data."""
    return Params(
        # The calendar then ends on 2001-09-30, after the latest task window.
        as_of=date(2001, 6, 1),
        calendar_start=date(1995, 1, 1),
        timesheet_cutoff=date(1995, 1, 1),
        admin_cutoff=date(1997, 2, 1),
        invoicing_floor=date(1995, 4, 30),
        admin_client="Internal Admin",
        excluded_staff=("Supplier#000000007", "Supplier#000000009"),
        excluded_task_staff=("Supplier#000000007",),
    )
