"""Every registered query against its DuckDB oracle on the smallest driver tables.

The same comparison the driver makes at sf0.01: column names, row counts and
the order-insensitive multiset of rows (doubles rounded to 6 places on both
sides by the entry point and the oracle SQL).
"""

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001

KEYS = sorted(entry.gold_queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.gold_queries()[key](spark, SF0001)
    oracle = entry.oracle_sql()
    assert key in oracle, f"{key} has no oracle SQL"
    res = duck.execute(oracle[key])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = [ocols.index(c) for c in sdf.columns]
    srows = Counter(tuple(_norm(v) for v in r) for r in sdf.collect())
    orows = Counter(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
    assert sum(srows.values()) == sum(orows.values())
    assert srows == orows


def test_entry_returns_staff_performance(spark):
    df = entry.entry(spark)
    assert "overall_recordable_hours" in df.columns
    assert df.count() > 0
