import numpy as np
import pytest

from gridloom.operators import flow as fl


def test_ptdf_is_what_the_dc_equations_give(spark):
    rng = np.random.default_rng(1)
    lines = [(i, (i + 1) % 6) for i in range(6)] + [(0, 3), (1, 4), (2, 9)]
    rows = [("n", f"L{k}", a, b, float(rng.uniform(0.1, 1))) for k, (a, b) in enumerate(lines)]
    df = spark.createDataFrame(rows, "network string, branch_id string, from_bus int, to_bus int, x double")
    m = fl.ptdf(df).toPandas().pivot(index="branch_id", columns="bus_id", values="factor")
    ids = list(m.columns)
    for bus in ids[1:]:  # what flows in at a bus leaves at the slack
        net = dict.fromkeys(ids, 0.0)
        for _, name, a, b, _ in rows:
            net[a] += m.loc[name, bus]
            net[b] -= m.loc[name, bus]
        assert net[bus] == pytest.approx(1) and net[ids[0]] == pytest.approx(-1) and sum(abs(v) > 1e-9 for v in net.values()) == 2
    out = fl.lodf(df)
    assert [r.branch_id for r in fl.bridges(out).collect()] == ["L8"]
    lodf = out.toPandas().pivot(index="branch_id", columns="outage_id", values="factor")
    rest = spark.createDataFrame([r for r in rows if r[1] != "L6"], df.schema)
    after = fl.ptdf(rest).toPandas().pivot(index="branch_id", columns="bus_id", values="factor")
    for name in after.index:
        assert after.loc[name, 4] == pytest.approx(m.loc[name, 4] + lodf.loc[name, "L6"] * m.loc["L6", 4])


def test_two_bus_power_flow():
    y = np.array([[1 / 0.1j, -1 / 0.1j], [-1 / 0.1j, 1 / 0.1j]])
    v, ok = fl.newton_raphson(y, np.array([1.0, 1.0], complex), np.array([0, -0.5]), np.array([0, -0.1]), np.array([], int), np.array([1]))
    s = v * np.conj(y @ v)
    assert ok and s[1] == pytest.approx(-0.5 - 0.1j) and abs(v[1]) < 1
    _, ok = fl.newton_raphson(y, np.array([1.0, 1.0], complex), np.array([0, -50.0]), np.array([0, -10.0]), np.array([], int), np.array([1]))
    assert not ok


def test_networks_balance(spark):
    buses = spark.createDataFrame([("a", 1, "slack", 1.0, 0.0, 0.0), ("a", 2, "pv", 1.01, 30.0, 0.0), ("a", 3, "pq", 1.0, -80.0, -20.0), ("b", 7, "pq", 1.0, 5.0, 0.0)], "network string, bus_id int, kind string, vm_pu double, p_mw double, q_mvar double")
    br = spark.createDataFrame([("a", 1, 2, 0.01, 0.1, 0.02), ("a", 2, 3, 0.01, 0.1, 0.02), ("a", 1, 3, 0.01, 0.1, 0.02), ("a", 1, 99, 0.1, 0.1, 0.0)], "network string, from_bus int, to_bus int, r_pu double, x_pu double, b_pu double")
    r = {(x.network, x.bus_id): x for x in fl.ac_flow(buses, br).collect()}
    assert all(x.converged for x in r.values()) and r[("a", 2)].vm_pu == pytest.approx(1.01) and r[("a", 3)].p_mw == pytest.approx(-80)
    assert 0 < sum(x.p_mw for k, x in r.items() if k[0] == "a") < 5 and len(r) == 4


def test_supplied_buses(spark):
    buses = spark.createDataFrame([(i,) for i in range(7)], "bus_id int")
    br = spark.createDataFrame([(0, 1), (2, 3), (3, 4)], "from_bus int, to_bus int")
    ids = lambda slack: {r.bus_id for r in fl.supplied_buses(buses, br, spark.createDataFrame(slack, "bus_id int")).collect()}
    assert ids([(1,)]) == {0, 1} and ids([]) == {2, 3, 4}
