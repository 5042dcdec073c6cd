"""Domain tables derived from the driver's TPC-H-like tables.

The source model reads a practice-management database and planning sheets
that are not available here, so the tables it needs are derived, row for
row, from the driver data by the rules in FIXTURES.md. Every derivation is
a lazy DataFrame over the whole input tables (no sampling, no id subsets).
Generated sets (days, weekdays, months) come from ``sequence`` + ``explode``
per row, never from a cross join.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Params, add_months
from ..session import dropped_shuffles, scratch_path
from .driver import read_table

FIXTURE_TABLES = (
    "public_holidays", "workable_days", "staff_adjustment", "incentive_targets",
    "recorded_invoiced_hours", "task", "clientdetails", "jobdetails", "jobassignee",
    "jobtask", "jobtaskassignee", "time_entries", "invoicetask", "invoice",
    "scd_batch1", "scd_batch2",
)


def _s(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def _task_id() -> Column:
    return F.concat(F.lit("t"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber"))


def _leave_part(partkey: Column) -> Column:
    return partkey % 40 < 3


class FixtureTables:
    """Lazy accessors for every derived table; each is built once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params):
        self.spark = spark
        self.sf_dir = sf_dir
        self.params = params
        self._memo: dict[str, DataFrame] = {}
        self._kept: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = getattr(self, f"_build_{name}")()
        return self._memo[name]

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in FIXTURE_TABLES}

    def keep(self, name: str) -> None:
        """Write a derived table that is read several times, once; the readers to come read the files."""
        if name not in self._kept:
            path = scratch_path(self.spark, "tables", name)
            with dropped_shuffles(self.spark):
                self[name].write.option("compression", "zstd").parquet(path)
            self._memo[name] = self.spark.read.parquet(path)
            self._kept.add(name)

    def raw(self, name: str) -> DataFrame:
        key = f"raw:{name}"
        if key not in self._memo:
            self._memo[key] = read_table(self.spark, self.sf_dir, name)
        return self._memo[key]

    # -- generated calendars -------------------------------------------------
    def _one_row(self) -> DataFrame:
        return self.spark.range(1)

    def _days_frame(self) -> DataFrame:
        p = self.params
        return self._one_row().select(
            F.explode(F.sequence(F.lit(p.calendar_start), F.lit(p.calendar_end), F.expr("INTERVAL 1 DAY"))).alias("d")
        )

    def _month_starts(self) -> tuple[date, date]:
        p = self.params
        first = p.calendar_start if p.calendar_start.day == 1 else add_months(p.calendar_start.replace(day=1), 1)
        return first, p.calendar_end.replace(day=1)

    def _with_months(self, df: DataFrame) -> DataFrame:
        first, last = self._month_starts()
        return df.withColumn("m", F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH"))))

    # -- sheets --------------------------------------------------------------
    def _build_public_holidays(self) -> DataFrame:
        d = F.col("d")
        return self._days_frame().where((F.month(d) * 100 + F.dayofmonth(d)).isin(101, 425, 1225, 1226)).select(
            d.alias("date")
        )

    def _build_workable_days(self) -> DataFrame:
        k, w = F.col("s_suppkey"), F.col("weekday")
        return (
            self.raw("supplier")
            .select("s_suppkey", "s_name", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("weekday"))
            .select(
                F.col("s_name").alias("staffname"),
                w.alias("day_of_week"),
                (w.between(2, 6) & (((k + w) % 6) != 0)).alias("working_day"),
                (((k + w) % 5).cast("double") / 4).alias("adjustment_factor"),
            )
        )

    def _build_staff_adjustment(self) -> DataFrame:
        k = F.col("s_suppkey")
        sup = self.raw("supplier").where(k % 10 != 0).select("s_suppkey", "s_name")
        return self._with_months(sup).select(
            F.col("s_name").alias("staffname"),
            F.col("m").alias("month"),
            ((k + F.month("m")) % 17).cast("double").alias("f") ,
        ).select("staffname", "month", (F.col("f") / 16).alias("adjustmentfactor"))

    def _build_incentive_targets(self) -> DataFrame:
        k = F.col("s_suppkey")
        sup = self.raw("supplier").where(k % 7 != 0).select("s_suppkey", "s_name")
        return self._with_months(sup).select(
            F.col("s_name").alias("staff_name"),
            F.col("m").alias("month_year"),
            F.when(k % 11 == 0, F.lit(0.0)).otherwise((9 - k % 4).cast("double") / 10).alias("target_billable_hours"),
            (F.lit(95).cast("double") / 100).alias("target_recorded_2_billable_hrs"),
            F.lit(1.0).alias("target_allocated_2_billable_hrs"),
            ((90 - k % 3 * 10).cast("double") / 100).alias("target_invoiced_2_billable_hrs"),
        )

    def _build_recorded_invoiced_hours(self) -> DataFrame:
        m = F.col("minutes")
        return self["time_entries"].where(F.col("note") == "A").select(
            F.col("uuid").alias("timesheet_uuid"),
            F.when(m % 9 == 0, F.lit("Coaching")).otherwise(F.lit("Manual entry")).alias("task"),
            F.when(m % 7 == 0, F.lit(None).cast("string")).otherwise(F.lit("Sheet Client")).alias("client"),
            (m.cast("double") * 9 / 10).alias("invoiced_mins"),
        )

    # -- practice-management tables -----------------------------------------
    def _build_task(self) -> DataFrame:
        types = self.raw("part").select("p_type").distinct()
        extra = self.spark.createDataFrame(
            [("tt-coaching", "Coaching"), ("tt-admin", "Admin - Non-billable"), ("tt-holiday", "Holiday")],
            "uuid string, name string",
        )
        return types.select(F.concat(F.lit("tt-"), F.lower("p_type")).alias("uuid"), F.col("p_type").alias("name")).unionByName(extra)

    def _build_clientdetails(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.raw("customer").select(
            F.concat(F.lit("c"), _s(k)).alias("uuid"),
            F.when(k % 25 == 0, F.lit(self.params.admin_client)).otherwise(F.col("c_name")).alias("name"),
        )

    def _build_jobdetails(self) -> DataFrame:
        k, od, st = F.col("o_orderkey"), F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
        jid = F.concat(F.lit("j"), _s(k))
        return self.raw("orders").select(
            jid.alias("uuid"),
            jid.alias("id"),
            jid.alias("remote_id"),
            F.concat(F.lit("Job "), _s(k)).alias("name"),
            F.col("o_orderpriority").alias("description"),
            F.when(k % 41 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("c"), _s("o_custkey"))).alias("client_uuid"),
            F.when(st == "F", "Completed").when(st == "O", "In Progress").otherwise("Planned").alias("state"),
            od.alias("start_date"),
            F.when(k % 11 == 0, F.lit(None).cast("date")).otherwise(_days(od, k % 30 + 3)).alias("due_date"),
            F.when(st == "F", _days(od, k % 20)).alias("completed_date"),
        )

    def _build_jobassignee(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey")
        sup = self.raw("supplier").select("s_suppkey", "s_name")
        return (
            li.join(sup, li.l_suppkey == sup.s_suppkey)
            .select(
                F.concat(F.lit("s"), _s("l_suppkey")).alias("uuid"),
                F.col("s_name").alias("name"),
                F.concat(F.lit("j"), _s("l_orderkey")).alias("job_id"),
            )
            .distinct()
        )

    def _lines(self, *columns: str) -> DataFrame:
        """Lines of an order, dealt by the order once: grouping them and meeting their order need no further shuffle."""
        return self.raw("lineitem").where(F.col("l_orderkey").isNotNull()).select("l_orderkey", *columns).repartition("l_orderkey")

    def _line_keys(self, *more: Column) -> DataFrame:
        lines = self._lines("l_linenumber", "l_partkey", "l_quantity", *(["l_suppkey"] if more else []))
        return lines.groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("partkey"), F.sum("l_quantity").cast("int").alias("qty"), *more
        )

    def _task_base(self) -> DataFrame:
        if "task_base" not in self._memo:
            lk = self._line_keys()
            o = self.raw("orders").select("o_orderkey", "o_orderdate")
            p = self.raw("part").select("p_partkey", "p_name", "p_type")
            pk = F.col("partkey")
            self._memo["task_base"] = (
                lk.join(o, lk.l_orderkey == o.o_orderkey)
                .join(p, p.p_partkey == lk.partkey)
                .select(
                    "l_orderkey", "l_linenumber", "partkey", "qty",
                    F.col("o_orderdate").cast("date").alias("od"),
                    _leave_part(pk).alias("leave_flag"),
                    _task_id().alias("task_id"),
                    F.when(pk % 40 == 0, "Annual Holiday")
                    .when(pk % 40 == 1, "Sick leave")
                    .when(pk % 40 == 2, "Other leave")
                    .when(pk % 40 == 3, "Admin - Non-billable")
                    .when(pk % 40 == 4, "Coaching")
                    .when(pk % 40 == 5, "Online content creation")
                    .otherwise(F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")))
                    .alias("name"),
                )
            )
        return self._memo["task_base"]

    def _build_jobtask(self) -> DataFrame:
        pk, ln, od, lf = F.col("partkey"), F.col("l_linenumber"), F.col("od"), F.col("leave_flag")
        start = _days(od, ln)
        return self._task_base().select(
            F.col("task_id").alias("remote_id"),
            F.col("task_id").alias("uuid"),
            F.concat(F.lit("j"), _s("l_orderkey")).alias("job_remote_id"),
            "name",
            (F.col("qty") * 90).alias("estimated_minutes"),
            (F.col("qty") * 60).alias("actual_minutes"),
            (pk % 3 != 0).alias("billable"),
            (pk % 2 == 0).alias("completed"),
            (pk % 97 == 0).alias("is_deleted"),
            F.when(lf, start).when(ln % 3 == 0, F.lit(None).cast("date")).otherwise(start).alias("start_date"),
            F.when(lf, _days(start, pk % 3))
            .when(ln % 4 == 0, F.lit(None).cast("date"))
            .otherwise(_days(start, pk % 45))
            .alias("due_date"),
        )

    def _build_jobtaskassignee(self) -> DataFrame:
        # The distinct suppliers of a line come from the aggregate that gives its part and quantity; with
        # every lookup reduced to distinct rows first, the result is distinct and needs no shuffle for it.
        lines = self._line_keys(F.collect_set("l_suppkey").alias("suppkeys")).where(F.col("l_linenumber").isNotNull())
        k = F.col("s_suppkey")
        sup = self.raw("supplier").select(
            k, F.when(k % 50 == 13, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("name")).distinct()
        sid = F.concat(F.lit("s"), _s(k))
        return (
            lines.join(self.raw("orders").select("o_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
            .join(self.raw("part").select("p_partkey"), F.col("p_partkey") == F.col("partkey"), "left_semi")
            .withColumn("suppkey", F.explode("suppkeys"))
            .join(sup, F.col("s_suppkey") == F.col("suppkey"))
            .select(
                _task_id().alias("job_task_id"),
                sid.alias("uuid"),
                sid.alias("staff_id"),
                "name",
                F.when(_leave_part(F.col("partkey")), F.when(k % 2 == 0, F.lit(480)).otherwise(F.lit(240)))
                .otherwise(F.col("qty") * 60)
                .alias("allocated_minutes"),
            )
        )

    def _build_time_entries(self) -> DataFrame:
        lines = self._lines(
            "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_linestatus", "l_returnflag", "l_quantity")
        tb = lines.groupBy(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_shipdate").cast("date").alias("sd")
        ).agg(
            F.min("l_linestatus").alias("ls"),
            F.min("l_returnflag").alias("rf"),
            (F.sum("l_quantity").cast("int") * 6).alias("minutes"),
        )
        o = self.raw("orders").select("o_orderkey", "o_orderdate")
        ok = F.col("l_orderkey")
        fin = F.col("ls") == "F"
        return tb.join(o, o.o_orderkey == tb.l_orderkey).select(
            F.concat_ws("-", _s(ok), _s("l_linenumber"), _s("l_suppkey"), _s("l_partkey"), _s("sd")).alias("uuid"),
            F.concat(F.lit("j"), _s(ok)).alias("job_id"),
            F.concat(F.lit("t"), _s(ok), F.lit("-"), _s("l_linenumber")).alias("task_uuid"),
            F.concat(F.lit("s"), _s("l_suppkey")).alias("staff_uuid"),
            F.col("rf").alias("note"),
            (F.col("rf") != "R").alias("billable"),
            F.when(fin, F.concat(F.lit("inv"), _s(ok))).alias("invoice_uuid"),
            F.when(fin, F.concat(F.lit("it"), _s(ok))).alias("invoice_task_uuid"),
            _days(F.col("o_orderdate").cast("date"), F.col("l_partkey") % 40).alias("date"),
            "minutes",
        )

    def _build_invoicetask(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").select(
            F.concat(F.lit("it"), _s(k)).alias("uuid"),
            F.concat(F.lit("inv"), _s(k)).alias("invoice_id"),
            (k % 50 == 0).alias("is_deleted"),
        )

    def _build_invoice(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").select(
            F.concat(F.lit("inv"), _s(k)).alias("id"),
            _days(F.col("o_orderdate").cast("date"), k % 120).alias("date"),
            (k % 70 == 0).alias("is_deleted"),
        )

    # -- two snapshots of one source table for the SCD2 operators ------------
    def _build_scd_batch1(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 13 != 0).select(
            "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
        )

    def _build_scd_batch2(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 17 != 0).select(
            "o_orderkey",
            "o_custkey",
            F.when(k % 10 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
            F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        )
