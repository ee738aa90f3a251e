import itertools
import random
import time
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import packing, queries, tokens
from gridloom.session import table


def unpacked(plan, histogram):
    """Contents of every container, by running over the runs."""
    out = [[] for _ in range(plan.containers)]
    ranks = {s: [] for s in histogram}
    for r in plan.runs:
        for k in range(r.count):
            out[r.first_container + k // r.each].append(r.size)
            ranks[r.size].append(r.first_rank + k)
    for s, n in histogram.items():
        assert sorted(ranks[s]) == list(range(n))
    return out


def least(items, capacity):
    """The fewest containers, by trying all."""

    @lru_cache(None)
    def best(rest):
        if not rest:
            return 0
        first, others, found = rest[0], rest[1:], len(rest)
        for k in range(len(others) + 1):
            for pick in itertools.combinations(range(len(others)), k):
                if first + sum(others[i] for i in pick) <= capacity:
                    found = min(found, 1 + best(tuple(x for i, x in enumerate(others) if i not in pick)))
        return found

    return best(tuple(sorted(items, reverse=True)))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 400), max_size=20))
def test_containers_hold_each_item_once_and_never_too_much(histogram):
    plan = packing.Plan(histogram, 50)
    for content in unpacked(plan, histogram):
        assert content and sum(content) <= 50
    total = sum(s * n for s, n in histogram.items())
    assert plan.containers >= -(-total // 50)
    assert sum(sum(content) <= 25 for content in unpacked(plan, histogram)) <= 2


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_reduction_never_costs_a_container(items):
    histogram = {s: items.count(s) for s in items}
    plan = packing.Plan.__new__(packing.Plan)
    plan.capacity, plan.left, plan.ranks, plan.runs, plan.containers = 20, dict(histogram), dict.fromkeys(histogram, 0), [], 0
    plan.sizes = sorted(plan.left)
    plan._reduce()
    rest = [s for s, n in plan.left.items() for _ in range(n)]
    assert plan.containers + least(tuple(rest), 20) == least(tuple(items), 20)


def test_wrong_sizes_are_refused():
    for h in ({0: 1}, {51: 1}):
        with pytest.raises(ValueError):
            packing.Plan(h, 50)


def packed(spark, counts, caps=(("s", 10), ("s", 10), ("l", 100))):
    c = spark.createDataFrame([(d, hash(d), n) for d, n in counts], "doc_id long, text_hash long, n_tokens long")
    return packing.pack(c, spark.createDataFrame(caps, "pack_name string, capacity_tokens int")).collect()


def test_whole_unless_too_long_and_every_document_placed(spark):
    counts = [(i, n) for i, n in enumerate([0, 0, 0, 1, 2, 3, 9, 10, 11, 20, 95, 7, 7, 7, 250])] + [(None, 4)]
    rows = packed(spark, counts)
    for name, capacity in (("s", 10), ("l", 100)):
        own = [r for r in rows if r.pack_name == name]
        fill = {}
        for r in own:
            fill[r.container_no] = fill.get(r.container_no, 0) + r.n_tokens
        assert max(fill.values()) <= capacity and set(fill) == set(range(len(fill)))
        for d, n in counts:
            pieces = sorted((r.piece_no, r.first_token, r.n_tokens) for r in own if r.doc_id == d)
            assert [p[0] for p in pieces] == list(range(max(1, -(-n // capacity)))) and sum(p[2] for p in pieces) == n
            assert all(p[1] == p[0] * capacity for p in pieces)


def test_empty_inputs_and_bad_capacity(spark):
    assert packed(spark, []) == []
    assert {r.container_no for r in packed(spark, [(1, 0), (2, 0)])} == {0}
    with pytest.raises(ValueError):
        packed(spark, [(1, 1)], [("x", 0)])


def test_one_size_may_hold_most_documents(spark):
    rows = packed(spark, [(i, 5) for i in range(3000)], [("s", 10)])
    assert len({r.container_no for r in rows}) == 1500


def test_tokens_of_whole_texts(spark):
    long_text = "word " * 60_000
    df = spark.createDataFrame([(1, "ab cd", "x"), (1, "ab cd", "x"), (2, None, "x"), (3, "", "y"), (4, long_text, "y"), (None, "<|endoftext|>", "z")], "doc_id long, text string, source string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, ("source",)).collect()}
    e = tokens.encoding(tokens.VOCABULARY)
    assert got == {1: len(e.encode_ordinary("ab cd")), 2: 0, 3: 0, 4: len(e.encode_ordinary(long_text)), None: len(e.encode_ordinary("<|endoftext|>"))}
    assert e.decode(e.encode_ordinary(long_text)) == long_text
    assert tokens.token_counts(df.limit(0)).count() == 0


def test_query_fills_well(spark, small):
    n = table(spark, small, "documents").count()
    for r in queries.p8_fill(spark, small).collect():
        assert r.n_containers <= r.least_containers * 1.1 + 1
    assert queries.p8_packed(spark, small).select("doc_id").distinct().count() == n


def test_a_large_plan_is_made_in_time():
    """All sizes of a capacity of 65,536 in uneven numbers."""
    rnd = random.Random(5)
    histogram = {s: rnd.randint(1, 40) for s in range(1, 65_537)}
    start = time.time()
    plan = packing.Plan(histogram, 65_536)
    assert time.time() - start < 20
    need = -(-sum(s * n for s, n in histogram.items()) // 65_536)
    assert need <= plan.containers <= need * 1.01


def test_a_rank_finds_its_run_among_few():
    plan = packing.Plan({s: (s * 7919) % 97 + 1 for s in range(1, 500)}, 700)
    by = {}
    for r in plan.runs:
        by.setdefault(r.size, []).append(r)
    for runs in by.values():
        width, blocks = packing.in_blocks(runs)
        assert sum(map(len, blocks.values())) <= 2 * len(runs) + 1
        for rank in range(sum(r.count for r in runs)):
            assert sum(r.first_rank <= rank < r.first_rank + r.count for r in blocks[rank // width]) == 1
