"""Joins to a unique side whose keys may be hot on the other.

A key of more than one in HOT_KEYS rows is hot; at most HOT_KEYS keys can be, so their rows of the unique
side are broadcast, whatever the sizes. All other rows join by shuffle, where no key is large. The hot side
is never gathered by its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.session import materialize

HOT_KEYS = 1000
HOT_ROWS = 100_000


def join_unique(left: DataFrame, right: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Inner join on key, of which right has each value once. left is read several times if it is large.

    at_most: a known bound of left's rows, which saves counting them.
    """
    if at_most is not None and at_most <= HOT_ROWS:  # no task gets more
        return left.join(right, key)
    rows = left.count()
    if rows <= HOT_ROWS:
        return left.join(right, key)
    hot = left.groupBy(key).count().filter(F.col("count") > max(HOT_ROWS, rows // HOT_KEYS)).select(key)
    known = materialize(hot.join(right, key), "hot-keys")
    if known.isEmpty():
        return left.join(right, key)
    warm = left.join(F.broadcast(known.select(key)), key, "left_anti").join(right, key)
    return left.join(F.broadcast(known), key).unionByName(warm)
