import random

import pytest

from gridloom.llm import mixing, queries


def mixed(spark, docs, targets, schedule=None):
    c = spark.createDataFrame([(i, s, i, n) for i, s, n in docs], "doc_id long, source string, text_hash long, n_tokens long")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return mixing.mix(c, t, schedule), t


def test_shares_repeats_and_order(spark):
    rnd = random.Random(1)
    docs = [(i, rnd.choice(["big"] * 8 + ["mid"] * 3 + ["tiny"]), rnd.randint(1, 40)) for i in range(4000)] + [(9001, "other", 5), (9002, None, 5), (9003, "big", 0)]
    m, t = mixed(spark, docs, [("big", 0.5, 1), ("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.2, 4), ("gone", 0.1, 3), (None, 0.5, 1)])
    rows = m.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows) and 0 <= rows[0].position and rows[-1].position <= 1
    total = sum(r.n_tokens for r in rows)
    for s, w, k in (("big", 0.5, 1), ("mid", 0.3, 2), ("tiny", 0.2, 4)):
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.n_tokens for r in own) / total - w) < 0.005
        uses = {}
        for r in own:
            uses.setdefault(r.doc_id, []).append(r.use_no)
        assert all(sorted(u) == list(range(1, len(u) + 1)) and len(u) <= k for u in uses.values())
    assert {r.source for r in rows} == {"big", "mid", "tiny"} and 9003 not in {r.doc_id for r in rows}
    used_up = [s for s, k in (("big", 1), ("mid", 2), ("tiny", 4)) if len([r for r in rows if r.source == s]) == k * len([d for d in docs if d[1] == s and d[2]])]
    assert used_up
    report = {r.source: r for r in mixing.share_report(m, t).collect()}
    assert report["gone"].n_tokens == 0 and abs(sum(r.actual_share for k, r in report.items() if k) - 1) < 1e-9


def test_schedule_is_followed(spark):
    docs = [(i, "ab"[i % 2], 10) for i in range(4000)]
    sched = {"a": [(0.0, 0.9), (0.5, 0.5), (1.0, 0.1)], "b": [(0.0, 0.1), (0.5, 0.5), (1.0, 0.9)]}
    rows = mixed(spark, docs, [("a", 0.5, 1), ("b", 0.5, 1)], sched)[0].collect()
    for lo in (0.0, 0.25, 0.5, 0.75):
        part = [r for r in rows if lo <= r.position < lo + 0.25]
        share = sum(r.source == "a" for r in part) / len(part)
        assert abs(share - (0.9 - 0.8 * (lo + 0.125))) < 0.02
        assert abs(len(part) - 1000) < 20


def test_schedules_integrate_to_one():
    s = mixing.tilted({"a": 0.7, "b": 0.3}, {"a": 1.0, "b": 4.0})
    for t in (0, 1):
        assert abs(sum(k[t][1] for k in s.values()) - 1) < 1e-12
    for knots in (*s.values(), [(0.0, 0.0), (0.3, 2.0), (0.3, 1.0), (1.0, 0.0)]):
        last = mixing.segments(knots)[-1]
        assert abs(last[4] + last[1] * (last[2] + last[3]) / 2 - 1) < 1e-12
    for bad in ([(0.0, 0.0), (1.0, 0.0)], [(0.0, -1.0), (1.0, 3.0)], [(1.0, 1.0), (0.0, 1.0)]):
        with pytest.raises(ValueError):
            mixing.segments(bad)


def test_nothing_to_mix(spark):
    assert mixed(spark, [], [("a", 1.0, 1)])[0].count() == 0
    assert mixed(spark, [(1, "b", 5)], [("a", 1.0, 1)])[0].count() == 0
    assert [r.n_tokens for r in mixed(spark, [(1, "a", 5)], [("a", 1.0, None)])[0].collect()] == [5]


def test_query(spark, small):
    rows = queries.p9_shares(spark, small).collect()
    assert len(rows) == 8 and all(r.most_uses <= r.max_repeats for r in rows) and abs(sum(r.actual_share for r in rows) - 1) < 1e-9
