import __spark_entry__ as entry


def test_every_oracle_is_sql_that_duckdb_plans(duck):
    oracles = entry.oracle_sql()
    assert set(oracles) <= set(entry.queries())
    for name, sql in oracles.items():
        assert isinstance(sql, str), name
        duck.execute(f"EXPLAIN {sql}")
    assert {"op5_line_dedup", "op6_topk", "op8_decontamination"} <= set(oracles)
