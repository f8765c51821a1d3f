"""Connected components of an edge table by repeated contraction.

Every round each node hooks onto the neighbour (or itself) that a hash, other each round, puts first; edges are relabelled, loops and
repeats dropped, until no edge is left. The hooks are composed backwards. Each table of a round is written to the shared folder, so a
lost executor repeats one round at most, and joins on a hub's key have a plain shuffle below them that adaptive execution can split.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episoda.llm import common


def components(edges: DataFrame) -> DataFrame | None:
    """edges(u, v) of bigint, loops ignored: (node, root) for every node that has a link; None if there is no link."""
    left = common.materialise(edges.select("u", "v").where("u <> v"), "links")
    hooks: list[DataFrame] = []
    for k in count():
        if not left.head(1):
            break
        first = lambda c: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        both = left.select("u", first("v").alias("c")).union(left.select(F.col("v").alias("u"), first("u").alias("c")))
        best = both.groupBy("u").agg(F.min("c").alias("c")).select("u", F.least("c", first("u")).getField("n").alias("to"))
        hook = common.materialise(best, "hooks")
        hooks.append(hook)
        half = left.join(hook, "u").select(F.col("to").alias("a"), F.col("v").alias("u"))
        both_ends = half.join(hook, "u").select("a", F.col("to").alias("b")).where("a <> b")
        left = common.materialise(both_ends.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links")
    if not hooks:
        return None
    root = hooks[-1].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for hook in reversed(hooks[:-1]):
        up = hook.join(root.withColumnRenamed("node", "to"), "to", "left")
        root = common.materialise(up.select(F.col("u").alias("node"), F.coalesce("root", "to").alias("root")), "roots")
    return root
