"""Connected components and reachability in the model's graphs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import salted_join
from gridloom.session import cut, drop

#: Edges up to which one task finds the components by union-find (under 100 MB); beyond it they are found by star rounds.
ONE_TASK_EDGES = 400_000


@contextmanager
def distributed() -> Iterator[None]:
    """Within it no graph is solved in one task, however small."""
    global ONE_TASK_EDGES
    before, ONE_TASK_EDGES = ONE_TASK_EDGES, 0
    try:
        yield
    finally:
        ONE_TASK_EDGES = before


def components(edges: DataFrame, a: str, b: str, scope: Sequence[str] = (), one_task: int | None = None) -> DataFrame:
    """(*scope, node, component): the least node of the component of every node named in a or b, scope by scope.

    A null end joins nothing but its other end is a node; loops and parallel edges change nothing. Scopes (a scenario, a
    station, a version) are separate graphs, solved together. Strings compare byte for byte. one_task: edges up to which one
    task solves it all (ONE_TASK_EDGES unless given; 0: never); the answer is the same.
    """
    one_task = ONE_TASK_EDGES if one_task is None else one_task
    scope = list(scope)
    ends = edges.select(*scope, F.col(a).alias("u"), F.col(b).alias("v"))
    nodes = ends.select(*scope, F.col("u").alias("node")).union(ends.select(*scope, F.col("v").alias("node"))).filter(F.col("node").isNotNull()).distinct()
    pairs = cut(ends.filter(F.col("u").isNotNull() & (F.col("u") != F.col("v"))).select(*scope, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    labels = _in_one_task(pairs, scope) if pairs.count() <= one_task else _scoped_stars(pairs, scope)
    labels = labels.withColumnsRenamed({k: f"_{k}" for k in [*scope, "node"]})
    same = nodes["node"] == labels["_node"]
    for k in scope:
        same = same & nodes[k].eqNullSafe(labels[f"_{k}"])
    return nodes.join(labels, same, "left").select(*scope, "node", F.coalesce("component", "node").alias("component"))


def _in_one_task(pairs: DataFrame, scope: list[str]) -> DataFrame:
    schema = pairs.select(*scope, F.col("u").alias("node"), F.col("v").alias("component")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[tuple, tuple] = {}

        def find(x: tuple) -> tuple:
            while (p := up.setdefault(x, x)) != x:
                up[x] = x = up[p]
            return x

        arrow = None
        for batch in batches:
            arrow = batch.schema
            *own, u, v = batch.to_pydict().values()
            for *s, x, y in zip(*own, u, v, strict=True):
                p, q = find((*s, x)), find((*s, y))
                if p != q:
                    lo, hi = (p, q) if p[-1] < q[-1] else (q, p)
                    up[hi] = lo
        if up:
            rows = [(*x, find(x)[-1]) for x in up]
            names = [*arrow.names[:-2], "node", "component"]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), [*arrow][:-1] + [arrow.field("v")], strict=True)], names=names)

    return pairs.coalesce(1).mapInArrow(run, schema)


def _scoped_stars(pairs: DataFrame, scope: list[str]) -> DataFrame:
    """_stars over one scope key that is never null, so that it can be joined on."""
    if not scope:
        return _stars(pairs, [])
    kinds = ", ".join(f"`{k}` {pairs.schema[k].dataType.simpleString()}" for k in scope)
    found = _stars(pairs.select(F.to_json(F.struct(*scope)).alias("_s"), "u", "v"), ["_s"])
    return found.select(F.from_json("_s", kinds).alias("_s"), "node", "component").select("_s.*", "node", "component")


def _stars(pairs: DataFrame, scope: list[str]) -> DataFrame:
    """Alternating large and small stars (Kiveris et al., Connected components in MapReduce and beyond).

    A large star links each larger neighbour of a node to the least of the node and its neighbours, a small star the
    smaller ones; both keep components, and when nothing changes every node hangs on the least of its component. The least
    neighbour is a partial aggregate and hubs are salted in the join.
    """
    key = [*scope, "u"]
    state = None
    while True:
        both = pairs.union(pairs.select(*scope, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*key).agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = salted_join(both.filter(F.col("v") > F.col("u")), least, key).select(*scope, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        least = large.groupBy(*key).agg(F.min("v").alias("m"))
        linked = salted_join(large, least, key)
        small = linked.filter(F.col("v") != F.col("m")).select(*scope, F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(*scope, "u", F.col("m").alias("v"))).distinct()
        small = cut(small)
        drop(pairs)
        drop(large)
        pairs = small
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*key, "v").cast("decimal(20,0)"))).first()
        if now == state:
            return pairs.select(*scope, F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def reachable(edges: DataFrame, seeds: DataFrame, a: str, b: str, blocked: Sequence[str] = ()) -> DataFrame:
    """(node): every node reached from the seeds (column node) over any number of edges, seeds included.

    Edges have no direction, so what is reached are the seeds' components; no walk with a job per step is needed. Blocked
    nodes are reached but not passed, also where they are seeds: they are left out of the components and added where they
    are next to a node that is reached. Null ends lead nowhere; a seed without edges stays.
    """
    seeds = seeds.select("node").dropna().distinct()
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    free = links.filter(~F.col("a").isin(*blocked) & ~F.col("b").isin(*blocked)) if blocked else links
    of = components(free, "a", "b")
    hit = salted_join(of, seeds, ["node"], "left_semi").select("component").distinct()
    reached = salted_join(of, hit, ["component"], "left_semi").select("node").union(seeds)
    if blocked:
        next_to = links.filter(F.col("b").isin(*blocked)).select(F.col("a").alias("node"), F.col("b").alias("to")).union(links.filter(F.col("a").isin(*blocked)).select(F.col("b").alias("node"), F.col("a").alias("to"))).distinct()
        on = reached.filter(~F.col("node").isin(*blocked))
        reached = reached.union(salted_join(next_to, on.distinct(), ["node"], "left_semi").select("to"))
    return reached.distinct()


def roots(tree: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, depth): the topmost ancestor of every row of a tree by pointer doubling; cycles end at no root and are left out.

    A parent that is null, empty or not itself a node ends the walk at the node below it.
    """
    t = tree.select(F.col(node).alias("node"), F.col(parent).alias("up")).distinct()
    known = t.select(F.col("node").alias("up")).distinct()
    t = t.join(known.withColumn("_known", F.lit(True)), "up", "left").select("node", F.when(F.col("_known"), F.col("up")).otherwise(F.col("node")).alias("up"))
    now = cut(t.select("node", "up", (F.col("node") != F.col("up")).cast("long").alias("depth")))
    left = None
    while True:
        step = now.filter("depth > 0").select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        after = cut(salted_join(now, step, ["up"], "left").select("node", F.coalesce("up2", "up").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("up2").isNotNull().alias("moved")))
        drop(now)
        now = after
        # Every round ends some walk of those that end at all; when none ends, what is left are cycles.
        moved = now.filter("moved").count()
        if moved in (0, left):
            return now.filter(~F.col("moved")).select("node", F.col("up").alias("root"), F.col("depth").cast("int").alias("depth"))
        left = moved


def descendants(tree: DataFrame, seeds: DataFrame, node: str, parent: str) -> DataFrame:
    """(node): everything below the seeds (column node), the seeds only where one is below another; cycles are walked once."""
    links = tree.select(F.col(parent).alias("node"), F.col(node).alias("child")).filter(F.col("node").isNotNull() & (F.col("node") != "")).distinct()
    frontier = seeds.select("node").dropna().distinct()
    seen = None
    while True:
        below = salted_join(links, frontier, ["node"], "left_semi").select(F.col("child").alias("node")).distinct()
        fresh = cut(below if seen is None else below.join(seen, "node", "left_anti"))
        if fresh.isEmpty():
            return fresh if seen is None else seen
        seen, frontier = (fresh if seen is None else cut(seen.union(fresh))), fresh
