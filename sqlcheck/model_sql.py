"""The gold model as plain set-based SQL for DuckDB.

Written independently of the Spark plans: calendar range joins with
BETWEEN, correlated subqueries and EXISTS for per-row counts, DISTINCT ON
with an explicit, NULLS FIRST tie order for lookups, and FILTER clauses for
conditional aggregates. The Spark side explodes windows and uses equi
joins, so agreement of the two is a real check.
"""

from __future__ import annotations

from workgrid.config import Params


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(xs) -> str:
    return ", ".join(_q(x) for x in xs) if xs else "NULL"


def model_ctes(p: Params) -> list[tuple[str, str]]:
    as_of = f"date '{p.as_of.isoformat()}'"
    admin_task, admin_client = _q(p.admin_task), _q(p.admin_client)
    coaching = _q(p.coaching_type)

    def leave_name(x: str) -> str:
        return f"({x} ILIKE '%Holiday%' OR {x} ILIKE '%Sick leave%' OR {x} ILIKE '%Other leave%')"

    def category(name: str, client: str) -> str:
        return (f"CASE WHEN {leave_name(name)} THEN 'Leave Tasks' "
                f"WHEN {name} ILIKE '%' || {admin_task} || '%' OR {client} = {admin_client} THEN 'Admin Tasks' "
                f"ELSE 'Billable Tasks' END")

    def window_end(task_due: str, j: str) -> str:
        return (f"coalesce({task_due}, CASE WHEN {j}.completed_date IS NULL THEN {j}.due_date "
                f"ELSE least({j}.completed_date, {j}.due_date) END)")

    return [
        # calendar -----------------------------------------------------------
        ("o_cal", f"""
SELECT cast(g AS date) AS date,
       cast(g AS date) IN (SELECT date FROM public_holidays) AS public_holiday,
       isodow(g) % 7 + 1 AS weekday,
       isodow(g) IN (6, 7) AS weekend,
       cast(date_trunc('month', g) AS date) AS start_of_month,
       last_day(cast(g AS date)) AS end_of_month,
       last_day(cast(g AS date)) <= last_day({as_of}) AND last_day(cast(g AS date)) > date '{p.invoicing_floor.isoformat()}'
         AS is_range_for_invoicing
FROM generate_series(date '{p.calendar_start.isoformat()}',
                     cast(date_trunc('month', {as_of}) + INTERVAL 4 MONTH - INTERVAL 1 DAY AS date),
                     INTERVAL 1 DAY) s(g)"""),
        ("o_workdays", "SELECT DISTINCT staffname, day_of_week FROM workable_days WHERE working_day"),
        ("o_staff", f"""
SELECT DISTINCT ON (name) staff_id AS staff_uuid, name AS staff_name
FROM jobtaskassignee
WHERE name IS NOT NULL AND name NOT IN ({_in_list(p.excluded_staff)})
ORDER BY name, staff_id NULLS FIRST"""),
        ("o_tasktype", "SELECT uuid AS tasktype_uuid, name FROM task"),
        ("o_taskname", """
SELECT task_name, task_type1,
       CASE WHEN task_name IN ('Online content creation', 'Online content management') THEN task_name ELSE task_type1 END
         AS task_type
FROM (
  SELECT n.task_name,
         coalesce(nullif(trim((SELECT string_agg(tt.name, ' ' ORDER BY tt.name) FROM o_tasktype tt
                               WHERE n.task_name ILIKE '%' || tt.name || '%')), ''), n.task_name) AS task_type1
  FROM (SELECT DISTINCT name AS task_name FROM jobtask) n
) x"""),
        ("o_job", """
SELECT jd.uuid AS job_uuid, jd.id AS job_id, jd.name AS job_name, jd.description AS job_description,
       jd.client_uuid, cd.name AS client_name, ja.uuid AS staff_uuid, ja.name AS staff_name,
       jd.state AS job_state, jd.start_date, jd.due_date, jd.completed_date
FROM jobdetails jd
LEFT JOIN clientdetails cd ON cd.uuid = jd.client_uuid
LEFT JOIN jobassignee ja ON ja.job_id = jd.remote_id"""),
        ("o_job1", """
SELECT DISTINCT ON (job_id) job_id, job_name, client_name, job_state FROM o_job
ORDER BY job_id, job_name NULLS FIRST, client_name NULLS FIRST, job_state NULLS FIRST"""),
        # leave --------------------------------------------------------------
        ("o_leave_rows", f"""
SELECT a.name AS staff_name, a.allocated_minutes,
       coalesce(t.start_date, j.start_date) AS ws, {window_end('t.due_date', 'j')} AS we
FROM jobtask t
JOIN jobtaskassignee a ON a.job_task_id = t.remote_id
LEFT JOIN jobdetails j ON j.remote_id = t.job_remote_id
WHERE t.is_deleted = false AND a.allocated_minutes > 0 AND {leave_name('t.name')}"""),
        ("o_leave_mpd", """
SELECT r.staff_name, r.ws, r.we,
       cast(r.allocated_minutes AS DOUBLE) / nullif((
         SELECT count(*) FROM o_cal c
         WHERE c.date BETWEEN r.ws AND r.we AND NOT c.weekend AND NOT c.public_holiday
           AND EXISTS (SELECT 1 FROM o_workdays w WHERE w.staffname = r.staff_name AND w.day_of_week = c.weekday)
       ), 0) AS mpd
FROM o_leave_rows r"""),
        ("o_leave", """
SELECT m.staff_name, c.date,
       coalesce(bool_or(m.mpd = 480), false) AS is_full_day,
       coalesce(bool_or(m.mpd <> 480), false) AS has_partial_leave,
       coalesce(sum(m.mpd / 60.0) FILTER (WHERE m.mpd <> 480), 0) AS partial_leave_hrs_per_day
FROM o_leave_mpd m JOIN o_cal c ON c.date BETWEEN m.ws AND m.we
GROUP BY m.staff_name, c.date"""),
        # task details -------------------------------------------------------
        ("o_base", f"""
SELECT t.job_remote_id || t.uuid || a.uuid AS job_task_staff_id, t.job_remote_id AS job_id, t.uuid AS task_uuid,
       t.name AS task_name, t.estimated_minutes, t.actual_minutes, t.billable AS task_billable,
       t.completed AS task_completed, a.uuid AS staff_uuid, a.name AS staff_name, cd.name AS client_name,
       t.start_date, t.due_date, a.allocated_minutes AS task_allocated_mins, tn.task_type,
       coalesce(t.start_date, j.start_date) AS start_date_adjusted, {window_end('t.due_date', 'j')} AS due_date_adjusted,
       {leave_name('t.name')} AS is_task_a_leave
FROM jobtask t
LEFT JOIN jobtaskassignee a ON a.job_task_id = t.remote_id
LEFT JOIN jobdetails j ON j.remote_id = t.job_remote_id
LEFT JOIN clientdetails cd ON cd.uuid = j.client_uuid
LEFT JOIN o_taskname tn ON tn.task_name = t.name
WHERE t.is_deleted = false AND a.name IS NOT NULL AND a.name NOT IN ({_in_list(p.excluded_task_staff)})"""),
        ("o_counts", f"""
SELECT b.job_task_staff_id,
       count(*) FILTER (WHERE NOT f) AS wdb_cnt,
       sum(ph) FILTER (WHERE NOT f) AS tlh_hrs,
       count(*) FILTER (WHERE NOT pt AND NOT f AND NOT ac) AS ttl_cnt,
       count(*) FILTER (WHERE pt AND NOT f) AS wdl_cnt,
       count(*) FILTER (WHERE pt AND NOT f AND date >= {as_of}) AS arwd_cnt,
       count(*) FILTER (WHERE NOT pt AND NOT f AND date >= {as_of} AND NOT ac) AS rttl_cnt,
       count(*) FILTER (WHERE pt AND NOT f AND date <= {as_of}) AS pwdl_cnt,
       count(*) FILTER (WHERE NOT pt AND NOT f AND date <= {as_of} AND NOT ac) AS pttl_cnt
FROM (
  SELECT b.job_task_staff_id, c.date,
         coalesce(l.is_full_day, false) AS f, coalesce(l.has_partial_leave, false) AS pt,
         l.partial_leave_hrs_per_day AS ph,
         (b.task_name = {admin_task} AND c.date >= date '{p.admin_cutoff.isoformat()}') AS ac
  FROM (SELECT job_task_staff_id, staff_name, task_name,
               unnest(generate_series(greatest(start_date_adjusted, date '{p.calendar_start.isoformat()}'),
                                      least(due_date_adjusted, date '{p.calendar_end.isoformat()}'), INTERVAL 1 DAY)) AS on_day
        FROM o_base WHERE start_date_adjusted IS NOT NULL AND due_date_adjusted IS NOT NULL) b
  JOIN o_cal c ON c.date = cast(b.on_day AS date)
  JOIN o_workdays w ON w.staffname = b.staff_name AND w.day_of_week = c.weekday
  LEFT JOIN o_leave l ON l.staff_name = b.staff_name AND l.date = c.date
  WHERE NOT c.weekend AND NOT c.public_holiday
) b
GROUP BY b.job_task_staff_id"""),
        ("o_rec", f"""
SELECT b.job_task_staff_id, cast(coalesce(m.mins, 0) AS BIGINT) AS recorded_mins
FROM o_base b
LEFT JOIN (SELECT job_id, task_uuid, staff_uuid, sum(minutes) AS mins FROM time_entries
           WHERE date >= date '{p.timesheet_cutoff.isoformat()}' GROUP BY job_id, task_uuid, staff_uuid) m
  ON m.job_id = b.job_id AND m.task_uuid = b.task_uuid AND m.staff_uuid = b.staff_uuid"""),
        ("o_jt1", f"""
SELECT b.*,
       coalesce(k.wdb_cnt, 0) AS wdb, coalesce(k.tlh_hrs, 0) AS tlh, coalesce(k.ttl_cnt, 0) AS ttl,
       coalesce(k.wdl_cnt, 0) AS wdl, coalesce(k.arwd_cnt, 0) AS arwd, coalesce(k.rttl_cnt, 0) AS rttl,
       coalesce(k.pwdl_cnt, 0) AS pwdl, coalesce(k.pttl_cnt, 0) AS pttl, r.recorded_mins AS rec,
       (b.task_name ILIKE '%' || {admin_task} || '%' OR b.client_name = {admin_client}) AS adm
FROM o_base b
LEFT JOIN o_counts k ON k.job_task_staff_id = b.job_task_staff_id
LEFT JOIN o_rec r ON r.job_task_staff_id = b.job_task_staff_id"""),
        ("o_jt2", "SELECT *, (wdb * 8 - tlh) / 8.0 AS rev FROM o_jt1"),
        ("o_jt3", "SELECT *, ttl * cast(task_allocated_mins AS DOUBLE) / nullif(rev, 0) AS ttl_mins FROM o_jt2"),
        ("o_jt4", "SELECT *, task_allocated_mins - ttl_mins AS remaining FROM o_jt3"),
        ("o_jt5", f"""
SELECT *,
       arwd * remaining / nullif(wdl, 0) AS arwd_mins,
       greatest(0, task_allocated_mins - rec)
         - CASE WHEN NOT adm THEN coalesce(arwd * remaining / nullif(wdl, 0), 0) ELSE 0 END AS remain,
       CASE WHEN rec > task_allocated_mins OR due_date_adjusted < {as_of} THEN task_allocated_mins ELSE rec END AS twa,
       CASE WHEN NOT adm THEN pwdl * remaining / nullif(wdl, 0) END AS pam
FROM o_jt4"""),
        ("o_jt6", "SELECT *, CASE WHEN pam > twa THEN twa ELSE pam END AS aw FROM o_jt5"),
        ("o_jtd", f"""
SELECT job_task_staff_id, job_id, task_uuid, task_name, estimated_minutes, actual_minutes, task_billable,
       task_completed, staff_uuid, staff_name, client_name, start_date, due_date, task_allocated_mins, task_type,
       start_date_adjusted, due_date_adjusted, is_task_a_leave,
       wdb AS workable_days_between_task,
       wdb * 8 AS workable_hrs_between_task,
       task_allocated_mins / nullif(wdb, 0) AS initial_avg_mins_per_work_day,
       CASE WHEN NOT is_task_a_leave THEN tlh END AS total_leave_hrs_between_workable_days,
       CASE WHEN NOT is_task_a_leave THEN rev END AS rev_workable_days_between_task,
       CASE WHEN NOT is_task_a_leave THEN task_allocated_mins / nullif(rev, 0) END AS avg_mins_per_work_day_without_leave,
       CASE WHEN NOT is_task_a_leave THEN ttl_mins END AS total_task_mins_work_days_without_leave,
       CASE WHEN NOT is_task_a_leave THEN remaining END AS remaining_allocated_task_mins,
       CASE WHEN NOT is_task_a_leave THEN wdl END AS work_days_with_leaves_between_task,
       CASE WHEN NOT is_task_a_leave THEN remaining / nullif(wdl, 0) END AS avg_mins_per_work_day_with_leaves,
       CASE WHEN NOT is_task_a_leave THEN rec END AS task_mins_worked_till_date,
       CASE WHEN NOT is_task_a_leave THEN rec > task_allocated_mins END AS is_task_mins_worked_gt_allocated,
       CASE WHEN NOT is_task_a_leave THEN greatest(0, task_allocated_mins - rec) END AS task_mins_remain_until_due,
       CASE WHEN NOT is_task_a_leave AND NOT adm THEN arwd_mins END AS allo_mins_during_remaining_work_days_with_leave,
       CASE WHEN NOT is_task_a_leave THEN remain END AS remain_mins_allo_to_remain_work_days_without_leave,
       CASE WHEN NOT is_task_a_leave THEN rttl END AS remain_work_days_without_leave,
       CASE WHEN NOT is_task_a_leave THEN remain / nullif(rttl, 0) END AS avg_remain_mins_per_remain_workday_without_leave,
       CASE WHEN NOT is_task_a_leave THEN
         CASE WHEN remain > 0 THEN rttl >= 1 AND remain / nullif(rttl, 0) <= 480 ELSE true END
       END AS is_task_within_allo_time_imp,
       CASE WHEN NOT is_task_a_leave THEN due_date_adjusted < {as_of} END AS is_task_due_date_over,
       CASE WHEN NOT is_task_a_leave THEN twa END AS task_mins_worked_adjusted,
       CASE WHEN NOT is_task_a_leave THEN pwdl END AS prior_work_days_with_leave,
       CASE WHEN NOT is_task_a_leave THEN pttl END AS prior_work_days_without_leave,
       CASE WHEN NOT is_task_a_leave THEN pam END AS allo_mins_during_prior_work_days_with_leave,
       CASE WHEN NOT is_task_a_leave THEN pam > twa END AS is_mins_prior_work_days_with_leave_gt_task_mins_worked,
       CASE WHEN NOT is_task_a_leave THEN aw END AS adj_worked_mins_prior_work_days_with_leave,
       CASE WHEN NOT is_task_a_leave THEN twa - aw END AS adj_worked_mins_prior_work_days_without_leave,
       CASE WHEN NOT is_task_a_leave THEN aw / nullif(pwdl, 0) END AS avg_worked_mins_per_prior_days_with_leave,
       CASE WHEN NOT is_task_a_leave THEN (twa - aw) / nullif(pttl, 0) END AS avg_worked_mins_per_prior_days_without_leave
FROM o_jt6"""),
        # timesheet ----------------------------------------------------------
        ("o_ts1", f"""
SELECT te.job_id || te.task_uuid || te.staff_uuid AS job_task_staff_id, te.uuid AS timesheet_uuid, te.job_id,
       te.task_uuid AS task_id, te.staff_uuid AS staff_id, s.staff_name, te.note AS timesheet_notes, te.billable,
       te.invoice_uuid AS invoice_id, te.invoice_task_uuid AS invoice_task_id, te.date, te.minutes AS recorded_minutes,
       coalesce(d.task_name, e.task) AS task_name, coalesce(d.client_name, e.client) AS client_name,
       coalesce(d.task_type, e.task) AS task_type, d.task_completed,
       it.invoice_id AS invoice_number, cast(date_trunc('month', te.date) AS date) AS month_time_recorded,
       cast(date_trunc('month', inv.date) AS date) AS month_time_invoiced, e.invoiced_mins AS invoiced_minutes,
       jn.job_name
FROM time_entries te
JOIN o_staff s ON s.staff_uuid = te.staff_uuid
LEFT JOIN (SELECT DISTINCT ON (job_task_staff_id) job_task_staff_id, task_name, client_name, task_type, task_completed
           FROM o_jtd ORDER BY job_task_staff_id, task_name NULLS FIRST, client_name NULLS FIRST,
                               task_type NULLS FIRST, task_completed NULLS FIRST) d
  ON d.job_task_staff_id = te.job_id || te.task_uuid || te.staff_uuid
LEFT JOIN (SELECT DISTINCT ON (timesheet_uuid) timesheet_uuid, task, client, invoiced_mins FROM recorded_invoiced_hours
           ORDER BY timesheet_uuid, task NULLS FIRST, client NULLS FIRST, invoiced_mins NULLS FIRST) e
  ON e.timesheet_uuid = te.uuid
LEFT JOIN invoicetask it ON it.uuid = te.invoice_task_uuid AND it.is_deleted = false
LEFT JOIN invoice inv ON inv.id = it.invoice_id AND inv.is_deleted = false
LEFT JOIN o_job1 jn ON jn.job_id = te.job_id
WHERE te.date >= date '{p.timesheet_cutoff.isoformat()}'"""),
        ("o_ts2", f"""
SELECT *,
       NOT (client_name = {admin_client} OR task_type = {admin_task}) AS is_client,
       CASE WHEN invoice_number IS NULL THEN NULL
            WHEN date_diff('month', month_time_recorded, month_time_invoiced) = -1 THEN 1
            ELSE cast(date_diff('month', month_time_recorded, month_time_invoiced) + 1 AS INTEGER) END AS month_invoiced_on,
       NOT ({leave_name('task_name')} OR task_name ILIKE '%' || {admin_task} || '%' OR client_name = {admin_client})
         AS billable_task
FROM o_ts1"""),
        ("o_ts", f"""
SELECT job_task_staff_id, timesheet_uuid, job_id, task_id, staff_id, staff_name, timesheet_notes, billable, invoice_id,
       invoice_task_id, date, recorded_minutes, task_name, client_name, task_type, task_completed, is_client,
       CASE WHEN invoice_task_id IS NULL AND is_client THEN 'Un-Invoiced'
            WHEN invoice_task_id IS NULL THEN {_q(p.internal_time_label)} ELSE 'Invoiced' END AS invoiced_time,
       is_client AND task_type <> {coaching} AS is_billable,
       CASE WHEN is_client AND task_type <> {coaching} THEN 'Billable' ELSE 'Not Billable' END AS billable_selector,
       {category('task_name', 'client_name')} AS task_category,
       invoice_number, month_time_recorded, month_time_invoiced, invoiced_minutes, month_invoiced_on,
       CASE WHEN billable_task THEN
         CASE WHEN invoice_task_id IS NULL AND is_client THEN '5_Un-Invoiced'
              WHEN month_invoiced_on = 1 THEN '1_Same Month' WHEN month_invoiced_on = 2 THEN '2_Following Month'
              WHEN month_invoiced_on = 3 THEN '3_Third Month' ELSE '4_Fourth Month +' END
       END AS recorded_hours_invoiced,
       job_name
FROM o_ts2"""),
        ("o_keys_time", "SELECT job_task_staff_id, job_id, task_id, staff_name, staff_id AS staff_uuid FROM o_ts"),
        # key table ------------------------------------------------------------
        ("o_jts", f"""
SELECT DISTINCT u.job_task_staff_id, u.job_id, u.staff_name, d.task_name, j.client_name, j.job_name,
       {category('d.task_name', 'j.client_name')} AS task_category,
       coalesce((SELECT min(tt.name) FROM o_tasktype tt WHERE d.task_name ILIKE '%' || tt.name || '%'), d.task_name)
         AS task_type1
FROM (SELECT job_task_staff_id, job_id, staff_name FROM o_jtd
      UNION ALL SELECT job_task_staff_id, job_id, staff_name FROM o_keys_time) u
LEFT JOIN o_jtd d ON d.job_task_staff_id = u.job_task_staff_id
LEFT JOIN o_job j ON j.job_id = u.job_id"""),
        # allocation by day ----------------------------------------------------
        ("o_task_hours", """
SELECT job_task_staff_id, date, sum(recorded_minutes) / 60.0 AS recorded_hrs FROM o_ts GROUP BY job_task_staff_id, date"""),
        ("o_alloc1", f"""
SELECT c.*, k.*, jt.start_date_adjusted, jt.due_date_adjusted,
       NOT c.weekend AND NOT c.public_holiday AS wk,
       coalesce(w.working_day, false) AS wd,
       coalesce(l.is_full_day, false) AS f,
       coalesce(l.has_partial_leave, false) AS pt,
       coalesce(jt.is_task_a_leave, false) AS lt,
       (k.task_type1 = {admin_task} OR k.client_name = {admin_client}) AS adm,
       k.task_type1 = {coaching} AS coach,
       jt.initial_avg_mins_per_work_day, jt.avg_mins_per_work_day_without_leave, jt.avg_mins_per_work_day_with_leaves,
       jt.avg_remain_mins_per_remain_workday_without_leave, jt.avg_worked_mins_per_prior_days_with_leave,
       jt.avg_worked_mins_per_prior_days_without_leave, jt.is_task_within_allo_time_imp, j6.job_state, th.recorded_hrs
FROM o_jts k
JOIN o_jtd jt ON jt.job_task_staff_id = k.job_task_staff_id
JOIN o_cal c ON c.date BETWEEN jt.start_date_adjusted AND jt.due_date_adjusted
LEFT JOIN (SELECT DISTINCT ON (staffname, day_of_week) staffname, day_of_week, working_day FROM workable_days
           ORDER BY staffname, day_of_week, working_day NULLS FIRST) w
  ON w.staffname = k.staff_name AND w.day_of_week = c.weekday
LEFT JOIN o_leave l ON l.staff_name = k.staff_name AND l.date = c.date
LEFT JOIN o_job1 j6 ON j6.job_id = k.job_id
LEFT JOIN o_task_hours th ON th.job_task_staff_id = k.job_task_staff_id AND th.date = c.date
WHERE jt.start_date_adjusted IS NOT NULL"""),
        ("o_alloc", f"""
SELECT date, public_holiday, weekday, weekend, start_of_month, end_of_month, is_range_for_invoicing,
       job_task_staff_id, job_id, staff_name, task_name, client_name, job_name, task_category, task_type1,
       CASE WHEN adm THEN false ELSE true END AS is_client,
       CASE WHEN adm OR coach THEN false ELSE true END AS is_billable,
       CASE WHEN adm OR coach THEN 'Not Billable' ELSE 'Billable' END AS billable_selector,
       start_date_adjusted, due_date_adjusted,
       wk AS is_workable_day,
       date >= start_date_adjusted AND date <= due_date_adjusted AS is_date_between_task_days,
       date >= {as_of} AS is_date_between_today_and_due,
       date < {as_of} AS is_date_between_start_and_today,
       lt AS is_task_a_leave, f AS is_full_day_leave,
       task_name = {admin_task} AND date >= date '{p.admin_cutoff.isoformat()}' AS admin_task_to_be_removed,
       wd AS is_staff_workable_day_of_week, pt AS is_day_with_a_leave,
       CASE WHEN wk AND wd AND NOT f AND NOT adm THEN initial_avg_mins_per_work_day / 60.0 END
         AS initial_allo_hrs_per_work_day_kpi01,
       CASE WHEN wk AND wd AND NOT pt AND NOT lt AND NOT f AND NOT adm THEN avg_mins_per_work_day_without_leave / 60.0 END
         AS allo_hrs_per_workday_without_leave_kpi02,
       CASE WHEN wk AND wd AND pt AND NOT lt AND NOT f AND NOT adm THEN avg_mins_per_work_day_with_leaves / 60.0 END
         AS allo_hrs_per_workday_with_leave_kpi03,
       CASE WHEN date >= {as_of} AND task_category = 'Billable Tasks' AND wk AND wd AND pt AND NOT lt AND NOT f
            THEN avg_mins_per_work_day_with_leaves / 60.0 END AS allo_hrs_per_remaining_work_day_with_leave_kpi04,
       CASE WHEN date >= {as_of} AND task_category = 'Billable Tasks' AND wk AND wd AND NOT pt AND NOT lt AND NOT f
            THEN avg_remain_mins_per_remain_workday_without_leave / 60.0 END
         AS allo_hrs_per_remaining_work_day_without_leave_kpi05,
       CASE WHEN date < {as_of} AND task_category = 'Billable Tasks' AND wk AND wd AND pt AND NOT lt AND NOT f
            THEN avg_mins_per_work_day_with_leaves / 60.0 END AS initial_allo_hrs_per_prior_work_days_with_leave,
       CASE WHEN date < {as_of} AND task_category = 'Billable Tasks' AND wk AND wd AND pt AND NOT lt AND NOT f
            THEN avg_worked_mins_per_prior_days_with_leave / 60.0 END AS act_allo_hrs_per_prior_work_days_with_leave_kpi06,
       CASE WHEN date < {as_of} AND task_category = 'Billable Tasks' AND wk AND wd AND NOT pt AND NOT lt AND NOT f
            THEN avg_worked_mins_per_prior_days_without_leave / 60.0 END
         AS act_allo_hrs_per_prior_work_days_without_leave_kpi07,
       is_task_within_allo_time_imp AS is_task_within_allo_time,
       coalesce(job_state, '') = 'Completed' AS is_job_complete,
       recorded_hrs AS recorded_task_hours,
       CASE WHEN lt AND wk AND wd THEN initial_avg_mins_per_work_day / 60.0 END AS allo_hrs_per_work_day_leave,
       cast(NULL AS DOUBLE) AS allo_hrs_per_work_day_adj_leaves_remain_days_fin02,
       cast(NULL AS DOUBLE) AS allo_hrs_per_work_day_adj_leaves_prior_days_fin03,
       cast(NULL AS DOUBLE) AS allo_hrs_per_work_day_adj_leaves_fin01,
       cast(NULL AS DOUBLE) AS allo_hrs_per_workable_day_final_output
FROM o_alloc1"""),
        # staff performance ----------------------------------------------------
        ("o_alloc_agg", f"""
SELECT staff_name, date,
       sum(allo_hrs_per_work_day_leave) FILTER (WHERE task_name ILIKE '%Holiday%') AS hol_hrs,
       sum(allo_hrs_per_work_day_leave) FILTER (WHERE task_name ILIKE '%Sick leave%' OR task_name ILIKE '%Other leave%')
         AS lvl_hrs,
       sum(allo_hrs_per_workable_day_final_output) FILTER (WHERE task_category = 'Admin Tasks') AS adm_hrs,
       sum(allo_hrs_per_work_day_adj_leaves_fin01) FILTER (WHERE task_category = 'Billable Tasks') AS bil_orig_hrs,
       sum(allo_hrs_per_workable_day_final_output) FILTER (WHERE task_category = 'Billable Tasks') AS bil_cap_hrs,
       sum(allo_hrs_per_workable_day_final_output) FILTER (WHERE task_category IN ('Admin Tasks', 'Billable Tasks'))
         AS anl_hrs
FROM o_alloc GROUP BY staff_name, date"""),
        ("o_ts_agg", """
SELECT staff_name, date,
       cast(sum(recorded_minutes) FILTER (WHERE task_name ILIKE '%Holiday%') AS BIGINT) AS alr_mins,
       cast(sum(recorded_minutes) FILTER (WHERE task_name ILIKE '%Sick leave%' OR task_name ILIKE '%Other leave%')
            AS BIGINT) AS olr_mins,
       cast(sum(recorded_minutes) FILTER (WHERE task_category = 'Admin Tasks') AS BIGINT) AS dar_mins,
       cast(sum(recorded_minutes) FILTER (WHERE task_category = 'Billable Tasks') AS BIGINT) AS bhr_mins,
       sum(invoiced_minutes) FILTER (WHERE invoiced_time = 'Invoiced' AND task_category = 'Billable Tasks') AS bhi_mins,
       cast(sum(recorded_minutes) FILTER (WHERE invoiced_time = 'Un-Invoiced' AND task_category = 'Billable Tasks')
            AS BIGINT) AS btu_mins
FROM o_ts GROUP BY staff_name, date"""),
        ("o_targets", """
SELECT DISTINCT ON (staff_name, cast(month_year AS date)) staff_name, cast(month_year AS date) AS month_date,
       target_billable_hours, target_recorded_2_billable_hrs, target_allocated_2_billable_hrs,
       target_invoiced_2_billable_hrs
FROM incentive_targets
ORDER BY staff_name, cast(month_year AS date), target_billable_hours NULLS FIRST,
         target_recorded_2_billable_hrs NULLS FIRST, target_allocated_2_billable_hrs NULLS FIRST,
         target_invoiced_2_billable_hrs NULLS FIRST"""),
        ("o_perf1", f"""
SELECT c.*, s.*,
       NOT c.public_holiday AND NOT c.weekend AND NOT coalesce(l.is_full_day, false) AS workable,
       wd.working_day AS wday, coalesce(adj.adjustmentfactor, 0) AS factor, wd.adjustment_factor AS day_factor,
       CASE WHEN NOT c.public_holiday AND NOT c.weekend AND NOT coalesce(l.is_full_day, false)
                 AND coalesce(wd.working_day, false)
            THEN round_even(8.0 * coalesce(adj.adjustmentfactor, 0), 0) ELSE 0 END AS orh,
       aa.hol_hrs, aa.lvl_hrs, aa.adm_hrs, aa.bil_orig_hrs, aa.bil_cap_hrs, aa.anl_hrs,
       it.target_billable_hours AS tbh, it.target_recorded_2_billable_hrs AS t_rec,
       it.target_allocated_2_billable_hrs AS t_all, it.target_invoiced_2_billable_hrs AS t_inv,
       pt.target_billable_hours AS p_bil, pt.target_recorded_2_billable_hrs AS p_rec,
       pt.target_allocated_2_billable_hrs AS p_all, pt.target_invoiced_2_billable_hrs AS p_inv,
       ta.alr_mins, ta.olr_mins, ta.dar_mins, ta.bhr_mins, ta.bhi_mins, ta.btu_mins
FROM o_cal c
CROSS JOIN o_staff s
LEFT JOIN o_leave l ON l.staff_name = s.staff_name AND l.date = c.date
LEFT JOIN (SELECT DISTINCT ON (staffname, day_of_week) staffname, day_of_week, working_day, adjustment_factor
           FROM workable_days ORDER BY staffname, day_of_week, working_day NULLS FIRST, adjustment_factor NULLS FIRST) wd
  ON wd.staffname = s.staff_name AND wd.day_of_week = c.weekday
LEFT JOIN (SELECT DISTINCT ON (staffname, cast(month AS date)) staffname, cast(month AS date) AS month_date,
                  adjustmentfactor
           FROM staff_adjustment ORDER BY staffname, cast(month AS date), adjustmentfactor NULLS FIRST) adj
  ON adj.staffname = s.staff_name AND adj.month_date = c.start_of_month
LEFT JOIN o_alloc_agg aa ON aa.staff_name = s.staff_name AND aa.date = c.date
LEFT JOIN o_targets it ON it.staff_name = s.staff_name AND it.month_date = c.start_of_month
LEFT JOIN o_targets pt ON pt.staff_name = s.staff_name AND pt.month_date = c.date
LEFT JOIN o_ts_agg ta ON ta.staff_name = s.staff_name AND ta.date = c.date"""),
        ("o_perf2", """
SELECT *,
       CASE WHEN orh = 0 THEN 0 ELSE orh - coalesce(hol_hrs, 0) - coalesce(lvl_hrs, 0) END AS nlr,
       CASE WHEN orh = 0 THEN 0 ELSE orh - coalesce(hol_hrs, 0) - coalesce(lvl_hrs, 0) - coalesce(adm_hrs, 0) END AS avb,
       coalesce(alr_mins, 0) / 60.0 + coalesce(olr_mins, 0) / 60.0 + coalesce(bhr_mins, 0) / 60.0
         + coalesce(dar_mins, 0) / 60.0 AS overall_rec
FROM o_perf1"""),
        ("o_perf3", "SELECT *, CASE WHEN orh = 0 THEN 0 ELSE avb * tbh END AS tb FROM o_perf2"),
        ("o_perf", f"""
SELECT date, public_holiday, weekday, weekend, start_of_month, end_of_month, is_range_for_invoicing,
       staff_uuid, staff_name,
       workable AS is_workable_day, wday AS is_staff_workable_day_of_week, factor AS adjustment_factor_by_month,
       cast(1 + cast(strftime(date, '%U') AS INTEGER) - cast(strftime(start_of_month, '%U') AS INTEGER) AS INTEGER)
         AS week_of_month,
       orh AS overall_recordable_hours,
       CASE WHEN orh = 0 THEN NULL ELSE -coalesce(hol_hrs, 0) END AS allocated_holiday_hours,
       CASE WHEN orh = 0 THEN NULL ELSE -coalesce(lvl_hrs, 0) END AS allocated_other_leave_hours,
       nlr AS non_leave_recordable_hours,
       CASE WHEN orh = 0 THEN NULL ELSE adm_hrs END AS allocated_admin_hours,
       avb AS available_billable_hours,
       CASE WHEN orh = 0 THEN NULL ELSE bil_orig_hrs END AS allocated_billable_hours_original,
       CASE WHEN orh = 0 THEN NULL ELSE bil_cap_hrs END AS allocated_billable_hours_capacity_planning,
       tb AS target_billable_hours,
       CASE WHEN nlr * tbh <= 0 THEN NULL ELSE nlr * tbh END AS target_non_leave_hours,
       CASE WHEN date >= {as_of} THEN NULL ELSE orh END AS m2date_overall_recordable_hours,
       CASE WHEN date >= {as_of} THEN NULL ELSE tb END AS m2date_target_billable_hours,
       -alr_mins / 60.0 AS annual_leave_hours_recorded,
       -olr_mins / 60.0 AS other_leave_hours_recorded,
       dar_mins / 60.0 AS admin_hours_recorded,
       bhr_mins / 60.0 AS billable_hours_recorded,
       overall_rec AS overall_hours_recorded,
       bhi_mins / 60.0 AS billable_hours_invoiced,
       btu_mins / 60.0 AS billable_hours_to_be_invoiced,
       CASE WHEN date >= {as_of} THEN NULL ELSE overall_rec END AS m2date_overall_hours_recorded,
       CASE WHEN orh = 0 THEN NULL ELSE anl_hrs END AS allocated_non_leave_hours_capacity_planning_check_variables,
       coalesce(day_factor, 0) AS adjustment_factor_by_day,
       year(date) = year({as_of}) AND month(date) = month({as_of}) AS is_current_month,
       CASE WHEN tb * t_rec <= 0 THEN NULL ELSE tb * t_rec END AS target_hours_to_be_recorded,
       CASE WHEN tb * t_all <= 0 THEN NULL ELSE tb * t_all END AS target_hours_to_be_allocated,
       CASE WHEN tb * t_inv <= 0 THEN NULL ELSE tb * t_inv END AS target_hours_to_be_invoiced,
       nullif(p_bil, 0) AS target_billable_percent,
       nullif(p_rec, 0) AS target_recordable_percent,
       nullif(p_all, 0) AS target_allocation_percent,
       nullif(p_inv, 0) AS target_invoice_percent
FROM o_perf3"""),
    ]
