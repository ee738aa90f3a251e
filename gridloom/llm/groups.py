"""Pairwise matches into groups: deterministic Boruvka contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import hot_of, salted_join
from gridloom.session import cut, cut_counted, drop


def group_pairs(pairs: DataFrame, left: str, right: str, ignored: tuple[str, ...] = ()) -> DataFrame:
    """(node, group_id) of every node named in either column; group_id is the smallest node joined to it, directly or not.

    Null, empty and `ignored` names are no nodes and join nothing; a pair of which only one side is a node makes that node
    known. Loops and repeated pairs change nothing. Names compare byte for byte. No pairs: no rows.

    Method, each step a few shuffles over what is left of the graph:
      1. every component takes its smallest outgoing edge, that to its smallest neighbour (a partial aggregate, so a hub
         arrives as one row per task). Along these choices every second label never grows, so the only cycles are pairs
         that chose each other; the smaller of the two becomes the root;
      2. pointer doubling makes each tree a star in log2(depth) joins;
      3. edges are renamed by their ends' roots, loops and repetitions removed.
    Each round leaves at most half of the components that still have edges. A root is the smallest name of its tree, hence
    group_id needs no further pass; the rounds' name tables, each at most half as long as the one before, are composed at
    the end. Hubs that many edges or pointers lead to are salted in the joins; nothing is collected.
    """
    ok = lambda c: F.col(c).isNotNull() & (F.col(c) != "") & ~F.col(c).isin(*ignored) if ignored else F.col(c).isNotNull() & (F.col(c) != "")
    nodes = pairs.filter(ok(left)).select(F.col(left).alias("node")).union(pairs.filter(ok(right)).select(F.col(right).alias("node"))).distinct()
    edges = pairs.filter(ok(left) & ok(right) & (F.col(left) != F.col(right))).select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v")).distinct()

    edges, n = cut_counted(edges, left=F.lit(True))
    rounds: list[DataFrame] = []
    while n["left"]:
        chosen = _choices(edges)
        # A component with very many edges is hot where edges are renamed; its degree is known from its choice.
        hubs = hot_of(chosen.select("c", F.col("degree").alias("_n")), ["c"])
        roots = _stars(chosen)
        rounds.append(roots)
        renamed = _rename(_rename(edges, roots, hubs, "u"), roots, hubs, "v").filter(F.col("u") != F.col("v"))
        left_over, n = cut_counted(renamed.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), left=F.lit(True))
        drop(edges)
        drop(chosen)
        edges = left_over
    drop(edges)

    if not rounds:
        return nodes.select("node", F.col("node").alias("group_id"))
    names = rounds[-1]
    for earlier in reversed(rounds[:-1]):
        names = salted_join(earlier.withColumnsRenamed({"c": "own", "root": "c"}), names, ["c"], "left").select(F.col("own").alias("c"), F.coalesce("root", "c").alias("root"))
    return nodes.join(names.withColumnRenamed("c", "node"), "node", "left").select("node", F.coalesce("root", "node").alias("group_id"))


def _choices(edges: DataFrame) -> DataFrame:
    """(c, p, degree): each component's smallest neighbour and its number of edges."""
    both = edges.select(F.col("u").alias("c"), F.col("v").alias("p")).union(edges.select(F.col("v").alias("c"), F.col("u").alias("p")))
    return cut(both.groupBy("c").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("degree")))


def _stars(chosen: DataFrame) -> DataFrame:
    """(c, root): pointers to the choices, doubled (p becomes the parent's parent) until none moves.

    The first doubling also finds the roots: where the choice of c's choice is c, the two chose each other, and the smaller
    one becomes the root, which points to itself.
    """
    now = chosen.select("c", "p")
    own = F.when(F.col("g") == F.col("c"), F.least("c", "p")).otherwise(F.col("g"))
    now, n = cut_counted(salted_join(now, now.select(F.col("c").alias("p"), F.col("p").alias("g")), ["p"]).select("c", own.alias("p")), moved=F.lit(True))
    while n["moved"]:
        parents = now.filter(F.col("c") != F.col("p")).select(F.col("c").alias("p"), F.col("p").alias("g"))  # roots point to themselves
        after, n = cut_counted(salted_join(now, parents, ["p"], "left").select("c", F.coalesce("g", "p").alias("p"), F.col("g").isNotNull().alias("moved")), moved=F.col("moved"))
        drop(now)
        now = after.select("c", "p")
        now._gridloom_path = after._gridloom_path  # type: ignore[attr-defined]
    return now.withColumnRenamed("p", "root")


def _rename(edges: DataFrame, roots: DataFrame, hubs: DataFrame, end: str) -> DataFrame:
    other = "v" if end == "u" else "u"
    return salted_join(edges, roots.withColumnRenamed("c", end), [end], hot=hubs.withColumnRenamed("c", end)).select(F.col("root").alias(end), other)
