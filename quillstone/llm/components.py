"""Connected components of links too many for one machine.

Tasks first shrink their own links to spanning stars by union-find. If no more than HELD links are left, one task joins
them; else large-star and small-star steps alternate, each a minimum per node and a join, until every node hangs on the
smallest node of its component. Both ways give the same result, and nothing is collected.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.session import arrow_map, cut

#: Links that a task holds in its union-find; with more, it hands the stars on, and no single task joins them.
HELD = 1 << 19


def _stars(batches, most: int | None = None):
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def emit():
        nodes = [x for x in parent if find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "low"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
        if most and len(parent) > most:
            yield emit()
            parent.clear()
    yield emit()


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for every node of links (two columns of non-null longs).

    Loops, repeated links and links in both directions don't matter. No links give no rows. Hubs are no burden: minima are
    taken before the shuffle, and the joins' hot keys can be split.
    """
    a, b = links.columns
    pairs = links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    held = HELD
    stars = cut(arrow_map(pairs, lambda batches: _stars(batches, held), "node long, low long").distinct())
    small_enough = stars.count() <= held
    if small_enough:
        stars = cut(arrow_map(stars.repartition(1), _stars, "node long, low long"))
    while not small_enough:
        ends = stars.groupBy("node").agg(F.min("low").alias("least"), F.max("low").alias("most"))
        loose = ends.where("least <> most").select("node").limit(1).union(stars.join(ends.select(F.col("node").alias("low")), "low", "left_semi").select("node").limit(1))
        if not loose.take(1):
            break
        # Small star: lower neighbours and the node itself move to the least of them.
        least = stars.groupBy("node").agg(F.min("low").alias("least"))
        small = stars.join(least, "node").where("low <> least").select(F.col("low").alias("node"), F.col("least").alias("low")).union(least.select("node", F.col("least").alias("low"))).distinct()
        # Large star: higher neighbours move to the least neighbour.
        both = small.union(small.select(F.col("low").alias("node"), F.col("node").alias("low")))
        least = both.groupBy("node").agg(F.least(F.min("low"), F.first("node")).alias("least"))
        large = both.where("low > node").join(least, "node").select(F.col("low").alias("node"), F.col("least").alias("low"))
        stars = cut(large.where("node <> low").distinct())
    return stars.select("node", F.col("low").alias("label")).union(stars.select("low", "low").distinct())
