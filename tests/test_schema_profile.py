"""Schema profile: keys, extremes, samples and sizes against plain Python."""

import os
from datetime import date

from workgrid.session import scratch_path
from workgrid.sinks import schema_profile as S


def test_profile_of_odd_tables(spark):
    rows = [(3, "b", 1.5, [1], date(2020, 1, 2)), (1, "a", None, None, None), (2, "b", -2.0, [2], date(2019, 1, 1)), (4, None, 0.25, [], None)]
    df = spark.createDataFrame(rows, "`my id` int, name string, x double, list array<int>, on date").repartition(3)
    got = {r.column_name: r for r in S.column_rows("t", df, ("`my id`",)).collect()}
    assert [got[c].ordinal for c in df.columns] == [1, 2, 3, 4, 5]
    r = got["x"]
    assert (r.data_type, r.row_count, r.null_cells, r.min_value, r.max_value) == ("double", 4, 1, "-2.000000", "1.500000")
    assert r.sample == "NULL | -2.000000 | 1.500000" and r.distinct_about == 3
    assert (got["on"].min_value, got["on"].sample) == ("2019-01-01", "NULL | 2019-01-01 | 2020-01-02")
    assert got["list"].sample is None and got["list"].null_cells == 1 and got["list"].data_type == "array<int>"
    keys = {r.column_name: r.is_key for r in S.column_rows("t", df, ("name",)).collect()}
    assert not any(keys.values())  # twice b, and a NULL
    plain = df.withColumnRenamed("my id", "id")
    assert {r.column_name for r in S.column_rows("t", plain, ("id",)).collect() if r.is_key} == {"id"}
    empty = S.column_rows("t", plain.limit(0), ("id",), distinct=False).collect()
    assert [(r.row_count, r.min_value, r.sample) for r in empty][:2] == [(0, None, ""), (0, None, "")]


def test_sizes_come_from_the_listing(spark):
    path = scratch_path(spark, "t_size")
    spark.range(1000).repartition(3).write.parquet(f"{path}/a")
    spark.range(10).write.parquet(f"{path}/b")
    local = path.removeprefix("file:")
    want = {t: sum(os.path.getsize(f"{local}/{t}/{f}") for f in os.listdir(f"{local}/{t}") if not f.startswith(("_", "."))) for t in "ab"}
    got = [tuple(r) for r in S.table_sizes(spark, {t: f"{path}/{t}" for t in "ab"}).collect()]
    assert got == sorted(want.items(), key=lambda r: -r[1])
