"""Exact samples by a threshold on hashes: rows are counted by range and filtered, never sorted in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.sources.staging import Staging

#: Hex digits of a level, and of a hash that are used at most.
DIGITS, WHOLE = 3, 15
#: So many rows of the boundary range may be ranked at once.
FEW = 10_000


def smallest(df: DataFrame, n: int, hashed: Column) -> DataFrame:
    """The min(n, rows) rows of ``df`` with the smallest ``hashed``, a hexadecimal text of at least 15 digits, evenly spread.

    Rows are counted by the first three digits, at most 4,096 counts for the driver; then only the range that the n-th
    row is in, by the next three, until it holds few rows, of which the smallest are ranked. Everything below is one
    filter. If many rows share all 15 digits, which hashes of different keys won't, these are told apart by
    their place in a staged table: any of them are taken, but exactly as many as are wanted."""
    low, left = "", n  # rows that begin with less than ``low`` are in; ``left`` more of those that begin with it
    while True:
        counts = df.where(hashed.startswith(low)).groupBy(F.substring(hashed, len(low) + 1, DIGITS).alias("digits")).count().collect() if left > 0 else []
        upto = 0
        for row in sorted(counts, key=lambda r: r.digits):
            if upto + row["count"] >= left:
                low, left, held = low + row.digits, left - upto, row["count"]
                break
            upto += row["count"]
        else:  # no more rows than wanted, or none are
            return df if left > 0 else df.limit(0)
        if held == left:
            return df.where(F.substring(hashed, 1, len(low)) <= low)
        below = df.where(F.substring(hashed, 1, len(low)) < low)
        edge = df.where(hashed.startswith(low))
        if held <= FEW:
            return below.unionByName(edge.orderBy(hashed).limit(left))
        if len(low) >= WHOLE:
            edge, _ = Staging(df.sparkSession).table(edge.withColumn("__place", F.md5(F.monotonically_increasing_id().cast("string").cast("binary"))), "tied")
            return below.unionByName(smallest(edge, left, F.col("__place")).drop("__place"))
