"""Containment join: which type names occur inside which task names.

SQL writes this as ``name ILIKE '%' || type || '%'``, a theta join. Here it
is an exact equi join on character grams: a name that contains a type holds
every gram of the type. Each type is looked up under the one of its
three-character grams that the fewest names hold, so types that share a
common beginning do not meet under one hot key; ``contains`` then verifies
the pair. A type shorter than three characters is its own gram.

The comparison is literal and case-insensitive (``lower`` on both sides),
so ``%``, ``_`` and ``\\`` in a type name are ordinary characters. An empty
type name is in every name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QGRAM = 3


def _grams(col: str, size: int):
    """All substrings of ``size`` characters (none in a shorter text)."""
    at = f"transform(sequence(1, length({col}) - {size} + 1), i -> substring({col}, i, {size}))"
    return F.expr(f"CASE WHEN length({col}) >= {size} THEN {at} ELSE array() END")


def containment_pairs(names: DataFrame, name_col: str, types: DataFrame, type_col: str) -> DataFrame:
    """Rows (name_col, type_col) for every type row contained in each distinct non-NULL name.

    ``names`` should already be distinct on ``name_col``. Duplicate type rows
    yield duplicate pairs, as the SQL join would.
    """
    n = names.select(F.col(name_col)).where(F.col(name_col).isNotNull()).withColumn("_lname", F.lower(name_col))
    t = types.select(F.col(type_col)).where(F.col(type_col).isNotNull()).withColumn("_ltype", F.lower(type_col))
    every = F.array_distinct(F.concat(F.array(F.lit("")), *[_grams("_lname", k) for k in range(1, QGRAM + 1)]))
    held = n.withColumn("_g", F.explode(every))
    own = F.when(F.length("_ltype") < QGRAM, F.array("_ltype")).otherwise(_grams("_ltype", QGRAM))
    offered = t.select("_ltype").distinct().withColumn("_g", F.explode(own))
    spread = held.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        offered.join(spread, "_g", "left")
        .groupBy("_ltype")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_g")).alias("_r"))
        .select("_ltype", F.col("_r._g").alias("_g"))
    )
    keyed = t.join(rarest, "_ltype")
    return held.join(keyed, "_g").where(F.col("_lname").contains(F.col("_ltype"))).select(name_col, type_col)
