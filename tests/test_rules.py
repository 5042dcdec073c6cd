"""Unit tests on small hand-made frames: NULL rules, tie rules, window rules."""

from collections import Counter
from datetime import date, timedelta

from pyspark.sql import functions as F

from workgrid.config import Params
from workgrid.functions.keys import composite_id, row_hash
from workgrid.functions.rules import is_admin, is_leave_name, task_category, week_of_month, window_end
from workgrid.operators.containment import containment_pairs
from workgrid.operators.lookup import first_per_key, left_join_sparse
from workgrid.operators.ranges import explode_days, window_index

P = Params(as_of=date(2024, 5, 15), admin_client="Admin Client")


def test_leave_and_category_rules(spark):
    df = spark.createDataFrame(
        [("Annual HOLIDAY", "X"), ("sick leave day", None), ("Admin - Non-billable", "X"), ("Build", "Admin Client"),
         ("Build", None), (None, None)],
        "name string, client string",
    )
    rows = df.select(is_leave_name("name").alias("l"), task_category("name", "client", P).alias("c"),
                     is_admin("name", "client", P).alias("a")).collect()
    assert [r.l for r in rows] == [True, True, False, False, False, None]
    assert [r.c for r in rows] == ["Leave Tasks", "Leave Tasks", "Admin Tasks", "Admin Tasks", "Billable Tasks",
                                   "Billable Tasks"]
    # NOT(name matches OR client = admin) is NULL when the client is NULL and the name does not match
    assert rows[4].a is None


def test_window_end_prefers_task_then_earlier_job_date(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 5), date(2024, 1, 9), date(2024, 1, 20)),
         (None, date(2024, 1, 9), date(2024, 1, 20)),
         (None, None, date(2024, 1, 20)),
         (None, date(2024, 1, 30), None)],
        "task_due date, done date, due date",
    )
    got = [r.e for r in df.select(window_end("task_due", "done", "due").alias("e")).collect()]
    assert got == [date(2024, 1, 5), date(2024, 1, 9), date(2024, 1, 20), date(2024, 1, 30)]


def test_week_of_month_counts_sunday_weeks(spark):
    # January 2022 starts on a Saturday: the 1st is week 1, Sunday the 2nd starts week 2.
    df = spark.createDataFrame([(date(2022, 1, 1),), (date(2022, 1, 2),), (date(2022, 1, 5),), (date(2022, 1, 31),),
                                (date(2022, 2, 1),), (date(2022, 2, 6),)], "d date")
    got = [r.w for r in df.select(week_of_month("d").alias("w")).collect()]
    assert got == [1, 2, 2, 6, 1, 2]


def test_composite_id_is_null_propagating(spark):
    df = spark.createDataFrame([("j1", "t1", "s1"), ("j1", None, "s1")], "a string, b string, c string")
    assert [r.i for r in df.select(composite_id("a", "b", "c").alias("i")).collect()] == ["j1t1s1", None]


def test_row_hash_writes_null_as_text(spark):
    import hashlib

    df = spark.createDataFrame([(1, None, "x")], "a bigint, b string, c string")
    got = df.select(row_hash(["a", "b", "c"]).alias("h")).first().h
    assert got == hashlib.md5(b"1|NULL|x").hexdigest()


def test_explode_days_clips_and_drops_bad_windows(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 30), date(2024, 2, 2)),   # clipped at the calendar end
         (2, date(2024, 1, 5), date(2024, 1, 3)),    # reversed: no days
         (3, None, date(2024, 1, 3)),                # open start: no days
         (4, date(2023, 12, 30), date(2024, 1, 1))],  # clipped at the calendar start
        "id int, s date, e date",
    )
    out = explode_days(df, "s", "e", date(2024, 1, 1), date(2024, 1, 31)).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in out} == {1: 2, 4: 1}


def test_first_per_key_takes_smallest_payload_nulls_first(spark):
    df = spark.createDataFrame([("a", "z", 1), ("a", None, 5), ("b", "y", 2), ("b", "x", 9), ("c", "q", None)],
                               "k string, p string, q int")
    got = {r.k: (r.p, r.q) for r in first_per_key(df, ["k"], ["p", "q"]).collect()}
    assert got == {"a": (None, 5), "b": ("x", 9), "c": ("q", None)}


def test_containment_equals_brute_force(spark):
    names = ["Review", "review board", "Online review content", "ab", "", "a%b_c", "a" * 50 + "xyz", None, "prefix one", "prefix two"]
    types = ["rev", "Review", "a", "%b", "_c", "xyz", "prefix", "", None, "nothing here", "rev", "ab"]
    got = Counter(tuple(r) for r in containment_pairs(
        spark.createDataFrame([(x,) for x in names], "n string"), "n", spark.createDataFrame([(x,) for x in types], "t string"), "t").collect())
    assert got == Counter((x, y) for x in names for y in types if x is not None and y is not None and y.lower() in x.lower())


def test_left_join_with_null_keys(spark):
    left = spark.createDataFrame([(i, None if i % 3 else i % 5) for i in range(60)], "id int, k int")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(4)] + [(None, "never")], "rk int, v string")
    got = sorted(tuple(r) for r in left_join_sparse(left, right, "k", "rk", "id").select("id", "k", "v").collect())
    assert got == [(i, None if i % 3 else i % 5, None if i % 3 or i % 5 == 4 else f"v{i % 5}") for i in range(60)]


def test_null_keys_are_spread(spark):
    left = spark.range(20_000).select("id", F.lit(None).cast("int").alias("k"))
    spread = left.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(1024)).cast("int") + 1)
    parts = [r["n"] for r in spread.repartition(8, "k", "s").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(parts) < 0.25 * 20_000


def test_datetime_windows_equal_the_range_join(spark, duck):
    rows = [("2020-01-05 09:00:00", "2020-01-08 00:00:00"), ("2020-01-05 00:00:00", "2020-01-08 17:30:00"), ("2020-01-05 09:00:00", "2020-01-05 18:00:00"),
            ("2019-12-20 10:00:00", "2020-01-02 10:00:00"), ("2020-01-08 00:00:00", "2020-01-05 00:00:00"), (None, "2020-01-05 00:00:00"), ("2020-01-29 01:00:00", "2020-03-05 00:00:00")]
    lo, hi = date(2020, 1, 1), date(2020, 1, 31)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, s string, e string").selectExpr(
        "id", "cast(s as timestamp_ntz) s", "cast(e as timestamp_ntz) e")
    first, last = window_index("s", "e", lo, hi)
    got = {(r.id, r.date) for r in explode_days(df, "s", "e", lo, hi).collect()}
    by_index = {(r.id, lo + timedelta(i)) for r in df.select("id", first.alias("a"), last.alias("b")).collect() for i in range(r.a, r.b + 1)}
    values = ", ".join(f"({i}, {'NULL' if s is None else repr(s)}::timestamp, {e!r}::timestamp)" for i, (s, e) in enumerate(rows))
    want = set(duck.execute(
        f"SELECT id, cast(d AS date) FROM (VALUES {values}) t(id, s, e) JOIN generate_series(date '2020-01-01', date '2020-01-31', INTERVAL 1 DAY) g(d) ON d BETWEEN s AND e").fetchall())
    assert got == want == by_index
    assert {d.day for i, d in got if i == 0} == {6, 7, 8}



def test_weekday_mask_is_exists_and_arrays_take_first_row(spark):
    from workgrid.operators.staff_lookups import weekday_arrays, working_weekday_mask

    wd = spark.createDataFrame(
        [("a", 2, False, 0.5), ("a", 2, True, 0.25), ("a", 3, None, 1.0), ("b", 7, True, 0.75)],
        "staffname string, day_of_week int, working_day boolean, adjustment_factor double",
    )
    mask = {r._ww_staff: r._ww_mask for r in working_weekday_mask(wd).collect()}
    assert mask["a"] == [False, True, False, False, False, False, False]  # any TRUE counts
    assert mask["b"][6] is True
    arr = {r._wk_staff: (r._wk_working_day, r._wk_adjustment_factor)
           for r in weekday_arrays(wd, ["working_day", "adjustment_factor"]).collect()}
    work, factor = arr["a"]
    assert work[1] is False and factor[1] == 0.5  # first row of (a, Monday): smallest payload
    assert work[2] is None and factor[2] == 1.0
    assert work[0] is None and factor[0] is None


def test_month_array_keeps_calendar_months_and_first_row(spark):
    from workgrid.operators.staff_lookups import day_list, month_array

    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), 0.5), ("a", date(2024, 1, 1), 0.25), ("a", date(2023, 6, 1), 9.0),
         ("a", None, 1.0), ("a", date(2024, 2, 15), 2.0), ("b", date(2024, 3, 1), 4.0), ("c", date(2024, 2, 2), 5.0)],
        "staffname string, month date, f double",
    )
    lo, hi = date(2024, 1, 10), date(2024, 3, 31)
    months = {r._mm_staff: [x and x.f for x in r._m] for r in month_array(df, "staffname", "month", ["f"], lo, hi, "_m").collect()}
    assert months == {"a": [0.25, None, None], "b": [None, None, 4.0]}
    days = {r._mm_staff: [(x.i, x.x.f) for x in r._d] for r in day_list(df, "staffname", "month", ["f"], lo, hi, "_d").collect()}
    assert days == {"a": [(36, 2.0)], "b": [(51, 4.0)], "c": [(23, 5.0)]}


def test_spread_merges_sorted_elements_with_the_window(spark):
    from workgrid.operators.sparse import inside, spread

    rows = [(1, [(2, 20), (3, 30), (7, 70)], 1, 7), (2, [(2, 20)], 3, 4), (3, None, 0, 2), (4, [], 5, 5), (5, [(0, 1)], 0, 0),
            (6, [(1, 10), (9, 90)], 2, 8), (7, [(1, 10)], 3, 2)]
    df = spark.createDataFrame(rows, "id int, s array<struct<i:int,v:int>>, a int, b int")
    own = inside(F.col("s"), F.col("a"), F.col("b"))
    out = spread(own, F.col("a"), F.col("b"), lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v")),
                 lambda i: F.struct(i.alias("i"), F.lit(None).cast("int").alias("v")))
    got = {r.id: r.x and [tuple(y) for y in r.x] for r in df.select("id", out.alias("x")).collect()}
    for k, s, a, b in rows:
        held = dict(s or [])
        assert got[k] == ([(i, held.get(i)) for i in range(a, b + 1)] if b >= a else None), k


def test_person_days_counts_by_plain_loops(spark):
    """Running counts against loops: holidays, working weekdays, full and partial leave, a person without a sheet."""
    from workgrid.operators import person_days as P

    p = Params(as_of=date(2024, 1, 31), calendar_start=date(2024, 1, 1), calendar_months_ahead=1)
    n, days = p.calendar_days, [p.calendar_start + timedelta(i) for i in range(p.calendar_days)]
    cal = spark.createDataFrame([(d, d.day == 9, d.weekday() >= 5, d.isoweekday() % 7 + 1) for d in days],
                                "date date, public_holiday boolean, weekend boolean, weekday int")
    sheet = [("a", k, True) for k in (2, 3, 5)] + [("a", 3, False), ("b", 2, False), ("b", 6, True)]
    leave = [("a", date(2024, 1, 8), True, False, 0.0), ("a", date(2024, 1, 10), False, True, 2.5), ("a", date(2024, 1, 11), True, True, 1.0),
             ("a", date(2024, 1, 16), False, True, 3.0), ("c", date(2024, 1, 2), False, True, 4.0), (None, date(2024, 1, 2), True, False, 0.0)]
    table = P.person_days(cal, spark.createDataFrame(sheet, "staffname string, day_of_week int, working_day boolean"),
                          spark.createDataFrame(leave, "staff_name string, date date, is_full_day boolean, has_partial_leave boolean, "
                                                       "partial_leave_hrs_per_day double"), p)
    works = {"a": {2, 3, 5}, "b": {6}, "c": set()}
    at = {(s, d): (f, h, hrs) for s, d, f, h, hrs in leave}
    wins = [(0, n - 1), (7, 7), (5, 20), (9, 9), (3, 2), (20, n - 1)]
    cols = [c for a, b in wins for c in (P.plain_days(F.lit(a), F.lit(b)), P.partial_days(F.lit(a), F.lit(b)), P.partial_hours(F.lit(a), F.lit(b)))]
    got = {r[0]: r[1:] for r in table.select("_pd_staff", *cols).collect()}
    codes = {r[0]: r[1] for r in table.select("_pd_staff", F.transform("_pd_days", lambda x, i: P.leave_code(i))).collect()}
    assert set(got) == {"a", "b", "c"}
    for s in got:
        want = []
        for a, b in wins:
            plain = part = 0
            hrs = 0.0
            for d in days[a : b + 1]:
                full, some, h = at.get((s, d), (False, False, 0.0))
                if d.weekday() < 5 and d.day != 9 and d.isoweekday() % 7 + 1 in works[s] and not full:
                    plain, part, hrs = plain + (not some), part + some, hrs + (h if some else 0.0)
            want += [plain, part, hrs]
        assert list(got[s]) == want, s
        assert codes[s] == [at.get((s, d), (0, 0, 0))[1] + 2 * at.get((s, d), (0, 0, 0))[0] for d in days]
