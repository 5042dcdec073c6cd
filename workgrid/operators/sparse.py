"""Sparse per-key values laid out over a window of positions, without searching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread(sparse: Column, first: Column, last: Column, body, empty) -> Column:
    """``body(x)`` for every element of ``sparse`` and ``empty(i)`` for every other position from ``first`` to ``last``.

    ``sparse`` is an array of structs sorted by their field ``i``, distinct
    and inside the window; NULL is no element. Both results have one type.
    The gaps between the elements are filled one after the other (a merge of
    two sorted lists), so the cost is the window's length. NULL where the
    window is empty.
    """
    def gap(a: Column, b: Column) -> Column:
        return F.when(a <= b, F.transform(F.sequence(a, b), empty)).otherwise(F.slice(F.transform(F.sequence(a, a), empty), 1, 0))

    def merged(items: Column) -> Column:
        before = lambda k: F.when(k > 0, F.get(items, k - 1)["i"] + 1).otherwise(first)
        parts = F.transform(items, lambda x, k: F.concat(gap(before(k), x["i"] - 1), F.array(body(x))))
        tail = F.coalesce(F.element_at(items, -1)["i"] + 1, first)
        return F.concat(F.flatten(parts), gap(tail, last))

    known = F.when(F.size(sparse) > 0, F.get(F.transform(F.array(sparse), merged), 0)).otherwise(gap(first, last))
    return F.when(last >= first, known)


def inside(sparse: Column, first: Column, last: Column) -> Column:
    """The elements of a sorted sparse array whose position is in the window."""
    return F.filter(sparse, lambda x: (x["i"] >= first) & (x["i"] <= last))
