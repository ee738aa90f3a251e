"""Texts into containers of a fixed number of tokens: dominance reduction, then best fit.

Only the sizes matter for a packing, and there are at most as many sizes as the capacity has tokens. So the packing is
planned on the histogram of sizes, whose length does not grow with the corpus, in bulk (this many containers with this
content); documents then find their container by their rank among the documents of their size.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import running
from gridloom.session import cut

#: A plan holds the histogram in the driver; larger capacities are refused, and more than MAX_SIZES sizes in all packs together.
MAX_CAPACITY, MAX_SIZES = 1 << 20, 1 << 23
#: Rows of a plan that are broadcast; a larger one is joined by shuffle.
BROADCAST_RUNS = 200_000


@dataclass(frozen=True)
class Run:
    """`count` items of a size, from the first_rank-th on, go to the containers from first_container on, `each` to one."""

    size: int
    first_rank: int
    count: int
    first_container: int
    each: int


class Plan:
    """A packing of a histogram {size: count} into containers of one capacity. Sizes are from 1 to the capacity."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        if not all(0 < s <= capacity for s in histogram):
            raise ValueError("sizes must be from 1 to the capacity")
        self.capacity, self.left, self.ranks = capacity, {s: n for s, n in histogram.items() if n}, dict.fromkeys(histogram, 0)
        self.sizes = sorted(self.left)
        self.runs: list[Run] = []
        self.containers = 0
        self.fixed = 0
        self._reduce()
        self.fixed = self.containers
        self._best_fit()

    def _take(self, size: int, count: int, first_container: int, each: int = 1) -> None:
        self.runs.append(Run(size, self.ranks[size], count, first_container, each))
        self.ranks[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def _fix(self, content: list[int]) -> bool:
        """As many containers with just this content as the items allow."""
        need = {s: content.count(s) for s in content}
        times = min(self.left.get(s, 0) // k for s, k in need.items())
        if times:
            for s, k in need.items():
                self._take(s, times * k, self.containers, k)
            self.containers += times
        return times > 0

    def _largest(self, most: int, without: int) -> int | None:
        """The largest size up to `most` of which an item is there besides one of size `without`."""
        i = bisect_left(self.sizes, most + 1) - 1
        while i >= 0 and self.sizes[i] == without and self.left[without] < 2:
            i -= 1
        return self.sizes[i] if i >= 0 else None

    def _smallest(self, k: int, without: int, above: int = 0) -> list[int]:
        """The k smallest items larger than `above`, besides one of size `without`."""
        out: list[int] = []
        for s in self.sizes[bisect_left(self.sizes, above + 1) :]:
            out += [s] * min(k - len(out), self.left[s] - (s == without))
            if len(out) == k:
                break
        return out

    def _best_pair(self, room: int, without: int) -> tuple[int, int] | None:
        """The pair of items, larger first, with the greatest sum up to `room`; the search ends where it is `room`."""
        best, pair, lo, sizes, left = 0, None, 0, self.sizes, self.left
        hi = bisect_left(sizes, room) - 1
        while lo <= hi:
            a, b = sizes[lo], sizes[hi]
            if left[a] == (a == without):
                lo += 1
            elif left[b] == (b == without) or a + b > room or (lo == hi and left[a] - (a == without) < 2):
                hi -= 1
            else:
                if a + b > best:
                    best, pair = a + b, (b, a)
                    if best == room:
                        break
                lo += 1
        return pair

    def _dominating(self, j: int) -> list[int] | None:
        """A set with an item of size j that dominates every other feasible set with it (Martello and Toth), if one is found.

        F dominates S if the items of S can be put under items of F that are at least as large: then some best packing
        has F as a container. Sets of up to three items are looked at.
        """
        room = self.capacity - j
        one = self._largest(room, j)
        if one is None:
            return [j]
        if one == room:
            return [j, one]
        three = self._smallest(3, j)
        fit, total = 0, 0
        for s in three:
            total += s
            fit += total <= room
        if fit == 1:
            return [j, one]
        if fit == 2:
            a, b = self._best_pair(room, j)
            if one >= a + b:
                return [j, one]
            if one == a:
                # {j, x, y} with both x and y larger than b must be impossible; then y fits under b and x under a.
                over = self._smallest(2, j, above=b)
                if len(over) < 2 or sum(over) > room:
                    return [j, a, b]
        return None

    def _reduce(self) -> None:
        """Until a round over all sizes fixes nothing more."""
        before = -1
        while self.containers != before:
            before = self.containers
            for j in sorted(self.sizes, reverse=True):
                while j in self.left and (content := self._dominating(j)) and self._fix(content):
                    pass

    def _best_fit(self) -> None:
        """Best fit in decreasing order over groups (residual, first container, count) of containers that are alike."""
        groups: dict[int, list[tuple[int, int]]] = {}
        residuals: list[int] = []

        def put(residual: int, first: int, count: int) -> None:
            if count and residual:
                if residual not in groups:
                    groups[residual] = []
                    insort(residuals, residual)
                groups[residual].append((first, count))

        for size in sorted(self.left, reverse=True):
            while size in self.left:
                i = bisect_left(residuals, size)
                if i < len(residuals):
                    residual = residuals[i]
                    first, count = groups[residual].pop()
                    if not groups[residual]:
                        del groups[residual], residuals[i]
                else:
                    residual, each = self.capacity, self.capacity // size
                    first, count = self.containers, -(-self.left[size] // each)
                    self.containers += count
                # A container that has taken an item is the best fit for the next one of the same size while it has room.
                each, n = residual // size, self.left[size]
                full = min(count, n // each)
                if full:
                    self._take(size, full * each, first, each)
                    put(residual - each * size, first, full)
                rest = self.left.get(size, 0) if full < count else 0
                if rest:
                    self._take(size, rest, first + full, rest)
                    put(residual - rest * size, first + full, 1)
                put(residual, first + full + bool(rest), count - full - bool(rest))


def in_blocks(runs: list[Run]) -> tuple[int, dict[int, list[Run]]]:
    """(width, {block: runs}) of one size's runs: a rank's run is among those of block rank // width, one or two on average."""
    width = max(1, -(-sum(r.count for r in runs) // len(runs)))
    blocks: dict[int, list[Run]] = {}
    for r in runs:
        for block in range(r.first_rank // width, (r.first_rank + r.count - 1) // width + 1):
            blocks.setdefault(block, []).append(r)
    return width, blocks


def pack(counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """(pack_name, container_no, doc_id, piece_no, first_token, n_tokens): every document in a container of every pack.

    counts: doc_id, text_hash, n_tokens (token_counts). capacities: pack_name, capacity_tokens; a few rows, repeated rows
    count once; a null or non-positive capacity is refused. A document is whole (piece_no 0) unless it is longer than the
    capacity; then it is cut into full containers and a last piece that is packed as an item. Documents without tokens are
    dealt out over the containers. container_no counts from 0 within a pack and every number up to the last one is used.
    """
    packs = capacities.select("pack_name", "capacity_tokens").distinct().limit(10_001).collect()
    if len(packs) > 10_000 or any(not p.capacity_tokens or not 0 < p.capacity_tokens <= MAX_CAPACITY for p in packs) or sum(p.capacity_tokens for p in packs) > MAX_SIZES:
        raise ValueError(f"capacities must be from 1 to {MAX_CAPACITY}, {MAX_SIZES} together")
    spark = counts.sparkSession
    counts = cut(counts)
    # Every document meets every pack; packs are a few fixed rows.
    names = F.array(*(F.struct(F.lit(p.pack_name).alias("pack_name"), F.lit(int(p.capacity_tokens)).cast("long").alias("capacity")) for p in packs)) if packs else F.array().cast("array<struct<pack_name:string,capacity:bigint>>")
    items = counts.withColumn("p", F.explode(names)).select("doc_id", "text_hash", "n_tokens", "p.pack_name", "p.capacity")
    last = F.when(F.col("n_tokens") == 0, F.lit(0)).otherwise(F.floor((F.col("n_tokens") - 1) / F.col("capacity")))
    items = items.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).withColumn("first_token", F.col("piece_no") * F.col("capacity"))
    items = items.withColumn("size", F.least(F.col("capacity"), F.col("n_tokens") - F.col("first_token")))

    histogram: dict[str, dict[int, int]] = {p.pack_name: {} for p in packs}
    total = 0
    for r in items.groupBy("pack_name", "size").count().collect():  # at most one row per pack and token of its capacity
        histogram[r.pack_name][r["size"]] = r["count"]
        total += r["count"]
    widths, blocks, containers = [], [], []
    for p in packs:
        plan = Plan({s: n for s, n in histogram[p.pack_name].items() if s > 0}, int(p.capacity_tokens))
        containers.append((p.pack_name, max(1, plan.containers)))
        by: dict[int, list[Run]] = {}
        for r in plan.runs:
            by.setdefault(r.size, []).append(r)
        for size, own in by.items():
            width, found = in_blocks(own)
            widths.append((p.pack_name, size, width))
            blocks += [(p.pack_name, size, block, [(r.first_rank, r.count, r.first_container, r.each) for r in rs]) for block, rs in found.items()]
    small = (lambda df: F.broadcast(df)) if len(blocks) <= BROADCAST_RUNS else (lambda df: df)
    width = small(spark.createDataFrame(widths, "pack_name string, size long, width long"))
    found = small(spark.createDataFrame(blocks, "pack_name string, size long, block long, runs array<struct<rank:bigint,n:bigint,container:bigint,each:bigint>>"))
    number = F.broadcast(spark.createDataFrame(containers, "pack_name string, containers long"))
    ranked = running(items.drop("capacity", "n_tokens"), ["pack_name", "size"], ["doc_id", "text_hash", "piece_no"], total=total)
    ranked = ranked.join(width, ["pack_name", "size"], "left").withColumn("block", F.expr("_rank div width"))
    ranked = ranked.join(found, ["pack_name", "size", "block"], "left").join(number, "pack_name")
    run = F.filter("runs", lambda x: (x["rank"] <= F.col("_rank")) & (F.col("_rank") < x["rank"] + x["n"]))[0]
    own = run["container"] + F.floor((F.col("_rank") - run["rank"]) / run["each"])
    dealt = F.pmod(F.col("_rank"), F.col("containers"))
    return ranked.select(
        "pack_name", F.when(F.col("size") == 0, dealt).otherwise(own).cast("long").alias("container_no"), "doc_id",
        F.col("piece_no").cast("int").alias("piece_no"), "first_token", F.col("size").alias("n_tokens"),
    )


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(pack_name, capacity_tokens, n_containers, n_tokens, least_containers, fill): how well the containers are used."""
    by = packed.groupBy("pack_name", "container_no").agg(F.sum("n_tokens").alias("t")).groupBy("pack_name").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("t").alias("n_tokens"))
    out = by.join(capacities.select("pack_name", "capacity_tokens").distinct(), "pack_name")
    return out.select(
        "pack_name", "capacity_tokens", "n_containers", "n_tokens", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"),
        (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill"),
    )
