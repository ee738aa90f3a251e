"""Network tables, AC power flow and linear sensitivities: numpy kernels, one network a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.components import components

#: A network's matrices are dense: beyond this many buses it is refused instead of taking a task's memory (8 MB a thousand squared).
MAX_BUSES = 3_000
FREQUENCY_HZ = 50.0
#: Smallest |1 - PTDF| of a branch on its own ends at which an outage leaves the network in one piece.
BRIDGE = 1e-9


def line_parameters(r: Column, x: Column, b: Column, g: Column, length: Column) -> list[Column]:
    """Per kilometre: resistance, reactance, capacitance in nF (from susceptance) and conductance in uS; no length counts as 1 km."""
    km = F.when(length > 0, length).otherwise(F.lit(1.0))
    c = b / (2 * np.pi * FREQUENCY_HZ) * 1e9
    return [(r / km).alias("r_ohm_per_km"), (x / km).alias("x_ohm_per_km"), (c / km).alias("c_nf_per_km"), (g * 1e6 / km).alias("g_us_per_km")]


def transformer_parameters(r: Column, x: Column, kv: Column, mva: Column) -> list[Column]:
    """Short-circuit voltages in percent from the impedance seen from the high-voltage side."""
    base = kv * kv / mva
    return [(F.sqrt(r * r + x * x) / base * 100).alias("vk_percent"), (r / base * 100).alias("vkr_percent")]


def spread_voltage(buses: DataFrame, lines: DataFrame, rounds: int = 5) -> DataFrame:
    """(bus_id, vn_kv): buses without a voltage take the least of their neighbours', round by round, at most `rounds` times."""
    ends = lines.select(F.col("from_bus").alias("a"), F.col("to_bus").alias("b"))
    ends = ends.union(ends.select("b", "a")).distinct()
    now = buses.select("bus_id", "vn_kv")
    for _ in range(rounds):
        given = ends.join(now.filter(F.col("vn_kv").isNotNull()).select(F.col("bus_id").alias("a"), F.col("vn_kv").alias("v")), "a").groupBy(F.col("b").alias("bus_id")).agg(F.min("v").alias("v"))
        now = now.join(given, "bus_id", "left").select("bus_id", F.coalesce("vn_kv", "v").alias("vn_kv"))
    return now


def supplied_buses(buses: DataFrame, branches: DataFrame, slack: DataFrame) -> DataFrame:
    """(bus_id): the buses joined to a slack bus; without any slack those of the largest component (the least id of equals)."""
    ends = branches.select(F.col("from_bus").alias("a"), F.col("to_bus").alias("b")).union(buses.select("bus_id", F.lit(None).cast(buses.schema["bus_id"].dataType)))
    of = components(ends, "a", "b")
    hot = of.join(slack.select(F.col("bus_id").alias("node")), "node", "left_semi").select("component").distinct()
    if hot.isEmpty():
        hot = of.groupBy("component").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    return of.join(hot, "component", "left_semi").select(F.col("node").alias("bus_id"))


def _matrices(pdf: pd.DataFrame) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids = sorted({*pdf.from_bus, *pdf.to_bus})
    if len(ids) > MAX_BUSES:
        raise ValueError(f"a network of {len(ids)} buses; at most {MAX_BUSES} are solved")
    at = {b: i for i, b in enumerate(ids)}
    f, t = np.array([at[b] for b in pdf.from_bus]), np.array([at[b] for b in pdf.to_bus])
    incidence = np.zeros((len(pdf), len(ids)))
    incidence[np.arange(len(pdf)), f] += 1
    incidence[np.arange(len(pdf)), t] -= 1
    return ids, f, t, incidence, incidence / pdf.x.to_numpy(float)[:, None]


def ptdf_matrix(incidence: np.ndarray, flows: np.ndarray, slack: int = 0) -> np.ndarray:
    """Branch flows per unit injected at a bus and taken out at the slack: Bf B^-1, with a zero column for the slack."""
    b = incidence.T @ flows
    rest = [i for i in range(b.shape[0]) if i != slack]
    out = np.zeros((flows.shape[0], b.shape[0]))
    out[:, rest] = np.linalg.solve(b[np.ix_(rest, rest)].T, flows[:, rest].T).T
    return out


def lodf_matrix(ptdf: np.ndarray, incidence: np.ndarray) -> np.ndarray:
    """Change of each branch's flow per unit that the branch of the column carried before its outage; NaN where that splits the network."""
    h = ptdf @ incidence.T
    own = 1 - np.diag(h)
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(np.abs(own)[None, :] > BRIDGE, h / own[None, :], np.nan)
    np.fill_diagonal(out, -1.0)
    return out


def ptdf(branches: DataFrame) -> DataFrame:
    """(network, branch_id, bus_id, factor) in long form. branches: network, branch_id, from_bus, to_bus, x; each network connected.

    The slack is the least bus id.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("branch_id")
        ids, _, _, inc, fl = _matrices(pdf)
        m = ptdf_matrix(inc, fl)
        return pd.DataFrame({"network": pdf.network.iloc[0], "branch_id": np.repeat(pdf.branch_id.to_numpy(), len(ids)), "bus_id": np.tile(ids, len(pdf)), "factor": m.ravel()})

    return branches.groupBy("network").applyInPandas(run, _long(branches, "bus_id", "from_bus"))


def lodf(branches: DataFrame) -> DataFrame:
    """(network, branch_id, outage_id, factor) in long form; null where the outage splits the network."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("branch_id")
        _, _, _, inc, fl = _matrices(pdf)
        m, own = lodf_matrix(ptdf_matrix(inc, fl), inc), pdf.branch_id.to_numpy()
        return pd.DataFrame({"network": pdf.network.iloc[0], "branch_id": np.repeat(own, len(own)), "outage_id": np.tile(own, len(own)), "factor": m.ravel()}).replace({np.nan: None})

    return branches.groupBy("network").applyInPandas(run, _long(branches, "outage_id", "branch_id"))


def _long(branches: DataFrame, other: str, like: str) -> str:
    kind = lambda c: branches.schema[c].dataType.simpleString()
    return f"network {kind('network')}, branch_id {kind('branch_id')}, {other} {kind(like)}, factor double"


def bridges(factors: DataFrame) -> DataFrame:
    """(network, branch_id): branches whose outage splits their network."""
    return factors.filter(F.col("factor").isNull() & (F.col("branch_id") != F.col("outage_id"))).select("network", F.col("outage_id").alias("branch_id")).distinct()


def newton_raphson(y: np.ndarray, v: np.ndarray, p: np.ndarray, q: np.ndarray, pv: np.ndarray, pq: np.ndarray, tolerance: float = 1e-9, steps: int = 30) -> tuple[np.ndarray, bool]:
    """Complex bus voltages of the AC power flow by Newton's method in polar form; whether it converged.

    y: bus admittances; v: start, with the set magnitudes of slack and pv buses; p, q: injections per unit.
    """
    angle, size = np.angle(v), np.abs(v)
    free = np.r_[pv, pq]
    for _ in range(steps):
        v = size * np.exp(1j * angle)
        s = v * np.conj(y @ v)
        wrong = np.r_[(s.real - p)[free], (s.imag - q)[pq]]
        if np.abs(wrong).max(initial=0) < tolerance:
            return v, True
        if not np.isfinite(size).all() or (size == 0).any():
            return v, False
        unit = np.exp(1j * angle)
        by_angle = 1j * np.diag(v) @ np.conj(np.diag(y @ v) - y @ np.diag(v))
        by_size = np.diag(v) @ np.conj(y @ np.diag(unit)) + np.conj(np.diag(y @ v)) @ np.diag(unit)
        j = np.block([[by_angle.real[np.ix_(free, free)], by_size.real[np.ix_(free, pq)]], [by_angle.imag[np.ix_(pq, free)], by_size.imag[np.ix_(pq, pq)]]])
        try:
            d = np.linalg.solve(j, -wrong)
        except np.linalg.LinAlgError:
            return v, False
        angle[free] += d[: len(free)]
        size[pq] += d[len(free) :]
    return size * np.exp(1j * angle), False


def ac_flow(buses: DataFrame, branches: DataFrame) -> DataFrame:
    """(network, bus_id, vm_pu, va_degree, p_mw, converged) of every network.

    buses: network, bus_id, kind (slack, pv, pq), vm_pu, p_mw, q_mvar as injections; branches: network, from_bus, to_bus,
    r_pu, x_pu, b_pu and, if there, g_pu and ratio (of the first bus) on a base of 100 MVA. A network without slack takes its least bus. Branches to unknown buses are left out; buses that no branch joins to a slack
    are not solved: their voltage is null and they take nothing.
    """
    base = 100.0

    def run(key: tuple, own: pd.DataFrame, br: pd.DataFrame) -> Iterator[pd.DataFrame] | pd.DataFrame:
        own = own.sort_values("bus_id").reset_index(drop=True)
        if len(own) > MAX_BUSES:
            raise ValueError(f"a network of {len(own)} buses; at most {MAX_BUSES} are solved")
        if own.empty:
            return pd.DataFrame(columns=["network", "bus_id", "vm_pu", "va_degree", "p_mw", "converged"])
        at = {b: i for i, b in enumerate(own.bus_id)}
        br = br[br.from_bus.isin(at) & br.to_bus.isin(at)]
        y = np.zeros((len(own), len(own)), dtype=complex)
        g, a = (br[c].fillna(d).to_numpy(float) if c in br else np.full(len(br), d) for c, d in (("g_pu", 0.0), ("ratio", 1.0)))
        # Shared places add up in the order of the rows, without a loop over branches.
        i, k = br.from_bus.map(at).to_numpy(int), br.to_bus.map(at).to_numpy(int)
        s = 1 / (br.r_pu.to_numpy(float) + 1j * br.x_pu.to_numpy(float))
        own_y = s + 0.5 * g + 0.5j * br.b_pu.to_numpy(float)
        np.add.at(y, (i, i), own_y / a**2)
        np.add.at(y, (k, k), own_y)
        np.add.at(y, (i, k), -s / a)
        np.add.at(y, (k, i), -s / a)
        kind = own.kind.to_numpy(object)
        if not (kind == "slack").any():
            kind[0] = "slack"
        fed = kind == "slack"
        while (more := fed | ((y != 0) @ fed)).sum() > fed.sum():
            fed = more
        set_v = np.where(kind == "pq", 1.0, own.vm_pu.fillna(1.0).to_numpy(float)).astype(complex)
        p, q = own.p_mw.fillna(0).to_numpy(float)[fed] / base, own.q_mvar.fillna(0).to_numpy(float)[fed] / base
        y = y[np.ix_(fed, fed)]
        solved, ok = newton_raphson(y, set_v[fed], p, q, np.flatnonzero(kind[fed] == "pv"), np.flatnonzero(kind[fed] == "pq"))
        vm, va, taken = np.full(len(own), np.nan), np.full(len(own), np.nan), np.zeros(len(own))
        vm[fed], va[fed], taken[fed] = np.abs(solved), np.degrees(np.angle(solved)), (solved * np.conj(y @ solved)).real * base
        out = pd.DataFrame({"network": key[0], "bus_id": own.bus_id, "vm_pu": vm, "va_degree": va, "p_mw": taken, "converged": ok})
        return out.astype({"vm_pu": object, "va_degree": object}).where(out.notna(), None)

    kinds = f"network {buses.schema['network'].dataType.simpleString()}, bus_id {buses.schema['bus_id'].dataType.simpleString()}"
    # New column identities: the two inputs may come from one table.
    buses, branches = (df.select(*(F.col(c).alias(c) for c in df.columns)) for df in (buses, branches))
    return buses.groupBy("network").cogroup(branches.groupBy("network")).applyInPandas(run, f"{kinds}, vm_pu double, va_degree double, p_mw double, converged boolean")
