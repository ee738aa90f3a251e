import random

import pytest
from helpers import same_as_sql

from gridloom.llm import groups, queries
from gridloom.operators import skew


def truth(pairs, ignored=()):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        ok = [x for x in (a, b) if x and x not in ignored]
        for x in ok:
            find(x)
        if len(ok) == 2:
            p, q = sorted((find(a), find(b)))
            up[q] = p
    return {x: find(x) for x in up}


def got(spark, pairs, ignored=()):
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = groups.group_pairs(df, "a", "b", ignored).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.group_id for r in rows}


def test_chains_stars_loops_and_odd_names(spark):
    pairs = [(f"c{i:03}", f"c{i + 1:03}") for i in range(70)] + [("m", f"s{i}") for i in range(80)] + [("x", "x"), ("y", None), (None, "z"), ("", "w"), ("GND", "g1"), ("g2", "GND"), ("é", "z2"), ("Z", "a"), (None, None)] + [("p", "q")] * 5
    assert got(spark, pairs, ("GND",)) == truth(pairs, ("GND",))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_with_hubs_salted(spark, seed, monkeypatch):
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (skew.HOT_KEYS, 5))
    monkeypatch.setattr(skew, "TASK_ROWS_MOST", 5)
    rnd = random.Random(seed)
    names = [f"n{rnd.randint(0, 10**6)}" for _ in range(250)]
    pairs = [(rnd.choice(names), rnd.choice(names)) for _ in range(150)] + [(names[0], rnd.choice(names)) for _ in range(60)]
    assert got(spark, pairs) == truth(pairs)


def test_nothing(spark):
    assert got(spark, []) == {} and got(spark, [("a", None)]) == {"a": "a"}


def test_query(spark, small, duck):
    same_as_sql(queries.p6_found, queries.ORACLES["p6_found"], spark, small, duck)
