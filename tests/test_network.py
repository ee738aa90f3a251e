"""Network tables from facts, and the flow on them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import scalar
from gridloom.operators import flow, network
from gridloom.sources import catalog

SCHEMA = "version long, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"


def model(spark, extra=()):
    rows = []

    def obj(id_, class_, **entries):
        for k, v in entries.items():
            ref = k.endswith("_")
            owner = {"name": "IdentifiedObject", "inService": "Equipment", "length": "Conductor", "seq": "ACDCTerminal", "p": "EnergyConsumer", "q": "EnergyConsumer", "eq_": "Terminal", "tn_": "Terminal", "pm": "RotatingMachine"}.get(k, class_)
            attr = {"seq": "sequenceNumber", "eq_": "ConductingEquipment", "tn_": "TopologicalNode", "holder_": "ConnectivityNodeContainer", "end": "endNumber", "of_": "PowerTransformer", "at_": "Terminal", "pm": "p", "type_": "OperationalLimitType", "set_": "OperationalLimitSet", "kind_": "kind"}.get(k, k)
            owner = {"endNumber": "TransformerEnd", "Terminal": "TransformerEnd"}.get(attr, owner) if class_ == "PowerTransformerEnd" else owner
            owner = "OperationalLimit" if attr in ("OperationalLimitType", "OperationalLimitSet") else owner
            rows.append((1, id_, "EQ", class_, f"{owner}.{attr}", str(v), ref, 0))

    obj("vl", "VoltageLevel", name="GON110KV")
    for n in "abcdz":
        obj(n, "TopologicalNode", name=f"bus {n}", holder_="vl" if n == "a" else "other")
    for e, ends in {"l1": "ab", "l2": "bc", "l3": "ac", "off": "az", "ld": "c", "ld2": "z", "g": "b", "x": "a", "t": "cd", "ldd": "d", "open": "b"}.items():
        for i, n in enumerate(ends, 1):
            obj(f"{e}-T{i}", "Terminal", eq_=e, tn_=n, seq=i)
    for k, ln in (("l1", "10"), ("l2", "0"), ("l3", "5")):
        obj(k, "ACLineSegment", name=k, length=ln, r="1.0", x="4.0", bch="0.0001", gch="x")
    obj("off", "ACLineSegment", name="off", x="1", inService="false")
    obj("open", "ACLineSegment", name="one end")
    obj("ty", "OperationalLimitType", kind_="http://x#LimitKind.patl")
    obj("ty2", "OperationalLimitType", kind_="http://x#LimitKind.tatl")
    obj("set", "OperationalLimitSet", at_="l1-T1")
    rows.append((1, "set", "EQ", "OperationalLimitSet", "OperationalLimitSet.Terminal", "l1-T1", True, 0))
    for i, (t, v) in enumerate((("ty", "300"), ("ty", "250"), ("ty2", "100"))):
        obj(f"cl{i}", "CurrentLimit", normalValue=v, type_=t, set_="set")
    obj("ld", "ConformLoad", name="load", p="20", q="5")
    obj("ldd", "ConformLoad", name="load d", p="3", q="1")
    obj("ld2", "ConformLoad", name="lost", p="7")
    obj("g", "SynchronousMachine", name="gen", pm="-8", minQ="-3")
    obj("x", "ExternalNetworkInjection", name="grid")
    obj("t", "PowerTransformer", name="trafo")
    obj("e1", "PowerTransformerEnd", end=1, of_="t", at_="t-T1", r="1", x="20", ratedS="40", ratedU="110")
    obj("e2", "PowerTransformerEnd", end=2, of_="t", at_="t-T2", r="0", x="0.1", ratedS="40", ratedU="20")
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def test_tables(spark, tmp_path):
    t = network.network_tables(model(spark))
    bus = {r.bus_id: r.vn_kv for r in t["buses"].collect()}
    assert bus == {"a": 110.0, "b": 110.0, "c": 110.0, "d": 20.0, "z": 110.0}  # z hangs on a line out of service and is still joined
    ln = {r.line_id: r for r in t["lines"].collect()}
    assert set(ln) == {"l1", "l2", "l3", "off"}
    assert (ln["l1"].r_ohm_per_km, ln["l1"].max_i_ka, ln["l2"].length_km, ln["l2"].max_i_ka, ln["off"].in_service) == (0.1, 0.25, 1.0, 1.0, False)
    assert ln["l1"].c_nf_per_km == pytest.approx(0.0001 / (100 * math.pi) * 1e8) and ln["l1"].g_us_per_km == 0
    tr = t["trafos"].first()
    x = 20 + 0.1 * (110 / 20) ** 2
    assert (tr.hv_bus, tr.lv_bus, tr.sn_mva) == ("c", "d", 40.0) and tr.vk_percent == pytest.approx(math.hypot(1, x) / (110**2 / 40) * 100, abs=1e-5)
    assert {r.load_id: r.p_mw for r in t["loads"].collect()} == {"ld": 20.0, "ldd": 3.0, "ld2": 7.0}
    g = t["gens"].first()
    assert (g.p_mw, g.min_q_mvar, g.max_q_mvar) == (8.0, -3.0, 9999.0) and t["ext_grid"].count() == 1
    for name, df in t.items():
        catalog.write_network_table(df.drop("version"), str(tmp_path), name)
    assert catalog.network_table(spark, str(tmp_path), "lines").count() == 4


def test_flow_balances(spark):
    t = network.network_tables(model(spark))
    b, br = network.flow_problem(t)
    solved = flow.ac_flow(b, br).cache()
    assert {r.converged for r in solved.collect()} == {True} and [r.bus_id for r in solved.filter("vm_pu IS NULL").collect()] == ["z"]
    res = {r.branch_id: r for r in network.branch_results(solved, br).collect()}
    assert set(res) == {"l1", "l2", "l3", "t"}
    v = {r.bus_id: r for r in solved.collect()}
    assert v["a"].vm_pu == pytest.approx(1) and v["b"].vm_pu == pytest.approx(1) and 0.9 < v["d"].vm_pu < 1.0
    out_of_a = res["l1"].p_from_mw + res["l3"].p_from_mw
    assert out_of_a == pytest.approx(v["a"].p_mw, abs=1e-6)
    tot = network.totals(b, solved, network.branch_results(solved, br), t["loads"], t["gens"]).first()
    assert tot.load_mw == 30 and tot.gen_mw == 8 and 15 < tot.slack_mw < 17 and tot.greatest_loading == pytest.approx(max(r.loading_percent for r in res.values() if r.loading_percent is not None))


def test_two_buses_by_hand(spark):
    """One line, one load: the voltage drop is that of the quadratic equation."""
    r, x, p, q = 0.02, 0.06, 0.4, 0.15
    b = spark.createDataFrame([("n", "1", "slack", 1.0, 0.0, 0.0), ("n", "2", "pq", 1.0, -p * 100, -q * 100)], "network string, bus_id string, kind string, vm_pu double, p_mw double, q_mvar double")
    br = spark.createDataFrame([("n", "1", "2", r, x, 0.0)], "network string, from_bus string, to_bus string, r_pu double, x_pu double, b_pu double")
    v2 = next(row.vm_pu for row in flow.ac_flow(b, br).collect() if row.bus_id == "2")
    k = 1 - 2 * (r * p + x * q)
    assert v2**2 == pytest.approx((k + math.sqrt(k * k - 4 * (r * r + x * x) * (p * p + q * q))) / 2, abs=1e-9)


def test_slack_falls_back_to_the_highest_voltage(spark):
    t = network.network_tables(model(spark).filter("class <> 'ExternalNetworkInjection'"))
    b, _ = network.flow_problem(t)
    assert [(r.bus_id, r.vm_pu) for r in b.filter("kind = 'slack'").collect()] == [("a", 1.0)]


def test_unsupplied_parts_are_left_out(spark):
    t = network.network_tables(model(spark).filter("id <> 'off' AND id NOT LIKE 'off-%'"))
    assert "z" not in {r.bus_id for r in t["buses"].collect()} and "ld2" not in {r.load_id for r in t["loads"].collect()}
    whole = network.network_tables(model(spark).filter("id <> 'off' AND id NOT LIKE 'off-%'"), only_supplied=False)
    assert "z" in {r.bus_id for r in whole["buses"].collect()}


def test_focus_line(spark):
    br = spark.createDataFrame([("n", f"b{i}", a, b, 0.1) for i, (a, b) in enumerate([("1", "2"), ("2", "3"), ("3", "1"), ("3", "4")])], "network string, branch_id string, from_bus string, to_bus string, x double")
    res = spark.createDataFrame([("n", "b1", 80.0), ("n", "b0", 80.0), ("n", "b3", None)], "network string, branch_id string, loading_percent double")
    rows = network.focus(res, flow.ptdf(br), flow.lodf(br), 2).collect()
    assert {r.line for r in rows} == {"b0"} and {(r.what, r["rank"], r.other) for r in rows} >= {("takes", 1, "b1"), ("takes", 2, "b2"), ("gives", 1, "b1"), ("gives", 2, "b2")}
    assert next(r.factor for r in rows if r.what == "bus" and r["rank"] == 1) == pytest.approx(-2 / 3)


@pytest.mark.parametrize(("name", "kv"), [("GON220KV", 220.0), ("EH_SD_400kV", 400.0), ("VL_33_Needle", 33.0), ("VL10.5", 10.5), ("x 0.4 kV ", 0.4), ("EH_border3", None), (None, None)])
def test_voltage_by_name(spark, name, kv):
    assert spark.range(1).select(scalar.nominal_kv(F.lit(name).cast("string")).alias("v")).first().v == kv


def test_a_network_of_the_size_of_the_published_case(spark):
    """131 buses and 191 branches converge, and the injections add up to the losses."""
    rng = np.random.default_rng(4)
    n = 131
    pairs = [(i, i + 1) for i in range(n - 1)] + [tuple(sorted(rng.choice(n, 2, replace=False).tolist())) for _ in range(61)]
    br = spark.createDataFrame([("n", f"l{i}", a, b, 0.002, 0.01, 0.001) for i, (a, b) in enumerate(pairs)], "network string, branch_id string, from_bus int, to_bus int, r_pu double, x_pu double, b_pu double")
    b = spark.createDataFrame([("n", i, "slack" if i == 0 else "pv" if i % 6 == 0 else "pq", 1.0, float(rng.normal(-2, 4)), float(rng.normal(0, 2))) for i in range(n)], "network string, bus_id int, kind string, vm_pu double, p_mw double, q_mvar double")
    out = flow.ac_flow(b, br).toPandas()
    assert out.converged.all() and 0 < out.p_mw.sum() < 20 and out.vm_pu.between(0.8, 1.2).all()
