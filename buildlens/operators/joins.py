"""Joins that stay balanced when a few keys hold most of a side. One form at every size."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_grouped(left: DataFrame, grouped: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join with a right side that is already grouped by the key.

    Spark splits a frequent left key at run time, but only when both sides come straight from a plain shuffle. A grouped
    side would keep the grouping of its aggregate; it is dealt out anew here, at one short row per key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    return left.join(grouped.hint("rebalance"), keys, how)


def children_or_none(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of parents to their children, where one parent may own most of the children.

    An outer join cannot be split on its optional side, so it is taken apart: an inner join, which Spark splits on
    either side, and the parents without children. ``children`` is read twice: pass a written table.
    """
    matched = parents.join(children, keys)
    childless = parents.join(children.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(childless, allowMissingColumns=True)
