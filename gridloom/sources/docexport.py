"""The model as documents, in both dialects; what documents.facts reads back.

Every document is put together from the items of one root container (a station, a cable, a house) and rendered as text, Arrow
batch by batch. Equipment without a container goes to boundary documents, by region and of a bounded number of items each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import housing
from gridloom.operators.skew import running
from gridloom.session import cut
from gridloom.sources.documents import KILO_KEYS, full_key
from gridloom.sources.doctext import bare_text, key_text, number, quote

#: Items of a boundary document; a region with more has several (`Boundary`, `Boundary-2`, ...).
BOUNDARY_ITEMS = 50_000
NAME = "IdentifiedObject.name"
CLASS_KEY, BUSBAR_NODE = "cim_class", "busbar_node"
#: What a document leaves out because it is the default.
DEFAULTS = {"Equipment.normallyInService": "true", "TimeSchedule.disabled": "false"}
#: Units written behind a value, by attribute.
UNITS = {
    "Ω": "ACLineSegment.r ACLineSegment.x ACLineSegment.r0 ACLineSegment.x0", "S": "ACLineSegment.bch ACLineSegment.gch ACLineSegment.b0ch ACLineSegment.g0ch", "m": "Conductor.length", "A": "Fuse.nominalCurrent",
    "kV": "BaseVoltage.nominalVoltage PowerTransformerEnd.ratedU", "MVA": "PowerTransformerEnd.ratedS", "s": "TimeSchedule.recurrencePeriod",
    "kW": "EnergyConsumer.p PowerElectronicsConnection.p", "kvar": "EnergyConsumer.q PowerElectronicsConnection.q", "kVA": "PowerElectronicsConnection.ratedS",
}
UNIT_OF = {k: u for u, keys in UNITS.items() for k in keys.split()}
#: Attributes that are numbers, by class.
NUMERIC = {
    "ACLineSegment": "b0ch bch g0ch gch r r0 shortCircuitEndTemperature x x0", "AnalogValue": "value", "BasePower": "basePower", "BaseVoltage": "nominalVoltage", "BatteryUnit": "ratedE storedE", "BusbarSection": "ipMax",
    "Conductor": "length", "ControlArea": "netInterchange", "CurrentLimit": "value", "CurveData": "xvalue y1value y2value", "DiscreteControlLimit": "value", "EnergyConsumer": "p q", "EquivalentInjection": "p q",
    "ExternalNetworkInjection": "maxP minP p q", "Fuse": "nominalCurrent", "GeneratingUnit": "maxOperatingP minOperatingP ratedNetMaxP", "HydroGeneratingUnit": "hydroUnitWaterCost", "LinearShuntCompensator": "bPerSection gPerSection",
    "LoadResponseCharacteristic": "pConstantCurrent pConstantImpedance pConstantPower", "NonlinearShuntCompensatorPoint": "b g", "OperationalLimitType": "acceptableDuration", "PerLengthSequenceImpedance": "r r0 x x0",
    "PhaseTapChangerAsymmetrical": "windingConnectionAngle", "PhaseTapChangerLinear": "stepPhaseShiftIncrement xStepMax xStepMin", "PhaseTapChangerNonLinear": "voltageStepIncrement", "PhaseTapChangerTablePoint": "angle",
    "PowerElectronicsConnection": "p q ratedS", "PowerElectronicsUnit": "maxP minP",
    "PowerTransformer": "beforeShCircuitHighestOperatingCurrent beforeShCircuitHighestOperatingVoltage beforeShortCircuitAnglePf highSideMinOperatingU", "PowerTransformerEnd": "b b0 g g0 r r0 ratedS ratedU x x0",
    "RatioTapChanger": "stepVoltageIncrement", "RegulatingControl": "maxAllowedTargetValue minAllowedTargetValue targetDeadband targetValue", "RotatingMachine": "p q ratedS", "SeriesCompensator": "r x",
    "StaticVarCompensator": "capacitiveRating inductiveRating voltageSetPoint", "SvPowerFlow": "p q", "SvShuntCompensatorSections": "sections", "SvVoltage": "angle v", "Switch": "ratedCurrent", "TapChanger": "neutralU",
    "TapChangerTablePoint": "ratio", "TimeSchedule": "recurrencePeriod", "TransformerEnd": "rground xground", "VoltageLimit": "value",
}
NUMERIC_KEYS = frozenset(f"{c}.{k}" for c, keys in NUMERIC.items() for k in keys.split())
LOCATIONS = ("PositionPoint", "Location", "UsagePointLocation")
NOTE = ["# Left out where it is the default: normallyInService: true, and disabled: false of measuring and transmission."]


def _number(s: object) -> float | None:
    try:
        return float(str(s)) if "_" not in str(s) else None
    except ValueError:
        return None


def _value(key: str, v: object) -> str:
    if isinstance(v, list):
        return "[" + ", ".join(_value(key, x) for x in v) + "]"
    n = _number(v) if key in NUMERIC_KEYS else None
    if n is not None:
        return number(n * 1000 if key in KILO_KEYS else n)
    return str(v) if v in ("true", "false") else quote(str(v))


def short_keys(keys: list[str], own: str) -> dict[str, str]:
    """Keys of an object of class `own` without their class, where no other key of the same map has the same rest and reading gives the class back; the name is `name`."""
    rests: dict[str, set[str]] = {}
    for k in keys:
        if k != NAME and "." in k and not k.startswith("cim:"):
            rests.setdefault(k.split(".", 1)[1], set()).add(k)
    single = {next(iter(ks)): r for r, ks in rests.items() if len(ks) == 1 and r != "name" and "." not in r and full_key(r, own) in ks}
    return {k: "name" if k == NAME else single.get(k, k) for k in keys}


class _Text:
    """Lines of one document."""

    def __init__(self, dialect: int):
        self.lines: list[str] = []
        self.dialect, self.depth = dialect, 0

    def line(self, s: str) -> None:
        self.lines.append("  " * self.depth + s)

    def block(self, head: str, close: str, body: list) -> None:
        """body: functions that write what stands between."""
        self.line(head)
        self.depth += 1
        for f in body:
            f()
        self.depth -= 1
        self.line(close)

    def entries(self, label: str, entries: dict, own: str | None, always: bool = False) -> None:
        """own: the class that bare keys get when read, None if keys stay as they are; always: write the label even if nothing is left to show."""
        shown = {k: v for k, v in entries.items() if self.dialect == 1 or DEFAULTS.get(k) != v}
        if not shown:
            if always:
                self.line(f"{label}: {{}}")
            return
        names = short_keys(list(shown), own) if self.dialect == 2 and own is not None else {k: k for k in shown}
        unit = lambda k: f" # {UNIT_OF[k]}" if self.dialect == 2 and k in UNIT_OF and k in NUMERIC_KEYS else ""
        row = lambda k: lambda: self.line(f"{key_text(names[k])}: {_value(k, shown[k])}{unit(k)}")
        self.block(f"{label}: {{", "}", [row(k) for k in sorted(shown, key=lambda k: (k != NAME, k))])

    def items(self, label: str, items: list) -> None:
        if items:
            self.block(f"{label}: [", "]", items)

    def geometry(self, points: list, path: bool) -> None:
        texts = [f"{{ lat: {number(a)}, lon: {number(b)} }}" for a, b in points]
        if texts and path:
            self.items("geometry", [lambda t=t: self.line(t) for t in texts])
        elif texts:
            self.line(f"geometry: {texts[0]}")

    def satellites(self, found: list) -> None:
        one = lambda c, a: lambda: self.block("{", "}", [lambda: self.line(f"class: {quote(c)}"), lambda: self.entries("attributes", a, c)])
        self.items("satellites", [one(c, a) for c, a in found])


def attribute_map(pairs: list | None, skip: tuple[str, ...] = (CLASS_KEY,)) -> dict:
    """{key: value, or list of values}, without the model's own keys."""
    out: dict = {}
    for k, v in pairs or []:
        if k not in (*skip, BUSBAR_NODE):
            out[k] = v[0] if len(v) == 1 else list(v)
    return out


def path_points(satellites: list) -> list[tuple[float, float]]:
    """(lat, lon) of the position points that have both, by sequence number."""
    out = []
    for c, a in satellites:
        lat, lon, seq = (_number(a.get(f"PositionPoint.{k}")) for k in ("yPosition", "xPosition", "sequenceNumber"))
        if c == "PositionPoint" and lat is not None and lon is not None:
            out.append((seq or 0.0, len(out), lat, lon))
    return [(p[2], p[3]) for p in sorted(out)]


def step_values(satellites: list) -> list[float] | None:
    """The values of the step limits in order, if their sequence numbers are exactly 1 to n and all have one."""
    limits = [a for c, a in satellites if c == "DiscreteControlLimit"]
    by = {_number(a.get("DiscreteControlLimit.sequenceNumber")): _number(a.get("DiscreteControlLimit.value")) for a in limits}
    if not limits or set(by) != {float(i + 1) for i in range(len(limits))} or None in by.values():
        return None
    return [by[i + 1.0] for i in range(len(limits))]


def schedules(class_: str, satellites: list, attributes: dict) -> tuple[dict, dict] | None:
    """The measuring and the transmission schedule of a meter that has exactly two; a name equal to the meter's is left out."""
    found = [a for c, a in satellites if c == "TimeSchedule"]
    if class_ != "Meter" or len(found) != 2:
        return None
    own = attributes.get(NAME)
    return tuple({k: v for k, v in a.items() if k != NAME or own is None or v != own} for a in found)  # type: ignore[return-value]


def common_name(sections: list[dict]) -> str | None:
    """The name that at least two sections have in common, all of them."""
    names = {s.get(NAME) for s in sections}
    name = names.pop() if len(names) == 1 and len(sections) > 1 else None
    return name if isinstance(name, str) else None


class _Renderer:
    def __init__(self, row: dict, dialect: int):
        self.row, self.dialect, self.t = row, dialect, _Text(dialect)
        self.root, self.region = row["root"], row["region"]
        items = sorted(row["items"] or [], key=lambda x: x["id"])
        self.devices = [x for x in items if x["role"] == "device"]
        self.cables = [x for x in items if x["role"] == "cable"]
        self.sections = [x for x in items if x["role"] == "section"]

    def short(self, id_: str | None) -> str:
        id_ = id_ or ""
        if self.root and id_.startswith(f"{self.root}-"):
            return ("@" if self.dialect == 2 else "") + id_[len(self.root) + 1 :]
        return id_

    def refs(self, item: dict, end: int) -> str:
        found = item[f"refs{end}"] or []
        names = [f"{'..' if r['region'] == self.region else '../../' + safe_name(r['region'])}/{r['folder']}/{safe_name(r['file'])}.hjson" for r in found]
        more = item[f"more{end}"] or 0
        return ", ".join(names) + (f" and {more} more" if more else "") if self.dialect == 2 else ""

    def sats(self, item: dict) -> list[tuple[str, dict]]:
        return [(s["class"] or "", dict(s["attributes"] or [])) for s in item["satellites"] or []]

    def device(self, x: dict) -> None:
        t, attributes, sats = self.t, attribute_map(x["attributes"]), self.sats(x)
        shown = sats
        t.line(f"id: {quote(self.short(x['id']))}")
        t.line(f"class: {quote(x['class'] or '')}")
        t.entries("attributes", attributes, x["class"] or "")
        steps, points = None, []
        if self.dialect == 2:
            points = path_points(sats)[:1]
            shown = [s for s in sats if s[0] not in LOCATIONS]
            if (two := schedules(x["class"], shown, attributes)) is not None:
                t.entries("measuring", two[0], "TimeSchedule", always=True)
                t.entries("transmission", two[1], "TimeSchedule", always=True)
                shown = [s for s in shown if s[0] != "TimeSchedule"]
            steps = step_values(shown)
            if steps is not None:
                shown = [s for s in shown if s[0] != "DiscreteControlLimit"]
        ends = [(x["t1"], 1), (x["t2"], 2)]
        lines = [(n, self.refs(x, i)) for n, i in ends if n and not (i == 2 and n == housing.GROUND)]
        t.items("connects", [lambda n=n, r=r: t.line(f"{quote(self.short(n))} # -> {r}" if r else bare_text(self.short(n))) for n, r in lines])
        t.satellites(shown)
        if steps is not None:
            t.line(f"steps: [{', '.join(map(number, steps))}]")
        t.geometry(points, False)

    def cable(self, x: dict) -> None:
        t, sats = self.t, self.sats(x)
        t.line(f"id: {quote(self.short(x['id']))}")
        for label, n, i in (("from", x["t1"], 1), ("to", x["t2"], 2)):
            r = self.refs(x, i)
            t.line(f"{label}: {quote(self.short(n))}" + (f" # -> {r}" if r else ""))
        t.entries("attributes", attribute_map(x["attributes"]), "ACLineSegment")
        t.satellites([s for s in sats if self.dialect == 1 or s[0] not in LOCATIONS])
        if self.dialect == 2:
            t.geometry(path_points(sats), True)

    def section(self, id_: str, attributes: dict, sats: list) -> None:
        t = self.t
        t.line(f"id: {quote(id_)}")
        t.entries("attributes", attributes, "BusbarSection")
        t.satellites([s for s in sats if self.dialect == 1 or s[0] not in LOCATIONS])
        if self.dialect == 2:
            t.geometry(path_points(sats)[:1], False)

    def busbars(self) -> list:
        """Dialect 2: a busbar is named by its recorded node and has a section for each thing that touches it, in the order of
        ids, with the original sections' attributes by position; without recorded node it is left out. Dialect 1: its sections."""
        t, out = self.t, []
        for bus in sorted({x["holder"] for x in self.sections}):
            own = [x for x in self.sections if x["holder"] == bus]
            if self.dialect == 1:
                rows = [(self.short(x["id"]), attribute_map(x["attributes"]), self.sats(x)) for x in own]
                name, shared = self.short(bus), None
            else:
                node = next((n for x in own for n in [dict(x["attributes"] or []).get(BUSBAR_NODE)] if n), None)
                if not node:
                    continue
                touching = sorted(x["id"] for x in [*self.devices, *self.cables] if node[0] in (x["t1"], x["t2"]))
                rows = []
                for i in range(len(touching)):
                    old = own[i] if i < len(own) else None
                    rows.append((str(i + 1), attribute_map(old["attributes"]) if old else {}, self.sats(old) if old else []))
                name, shared = self.short(node[0]), common_name([a for _, a, _ in rows])
                if shared is not None:
                    rows = [(i, {k: v for k, v in a.items() if k != NAME}, s) for i, a, s in rows]
            section = lambda r: lambda: t.block("{", "}", [lambda: self.section(*r)])

            def busbar(name: str = name, shared: str | None = shared, rows: list = rows, section=section) -> None:
                t.line(f"id: {quote(name)}")
                if shared is not None:
                    t.entries("attributes", {NAME: shared}, "BusbarSection")
                t.items("sections", [section(r) for r in rows])

            out.append(lambda b=busbar: t.block("{", "}", [b]))
        return out

    def text(self) -> str:
        t, row = self.t, self.row
        devices = "equipments" if self.dialect == 2 else "equipment"
        item = lambda f, x: lambda: t.block("{", "}", [lambda: f(x)])

        def bay(b: dict) -> None:
            t.line(f"id: {quote(self.short(b['id']))}")
            if self.dialect == 2:
                t.entries("attributes", attribute_map(b["attributes"], ()), None)
            t.items(devices, [item(self.device, x) for x in self.devices if x["holder"] == b["id"]])

        def body() -> None:
            for n in NOTE if self.dialect == 2 else []:
                t.line(n)
            t.entries("attributes", attribute_map(row["attributes"], ()), None)
            if row["lat"] is not None and row["lon"] is not None:
                t.geometry([(row["lat"], row["lon"])], False)
            t.items(devices, [item(self.device, x) for x in self.devices if x["holder"] is None])
            t.items("busbars", self.busbars())
            t.items("bays", [item(bay, b) for b in sorted(row["bays"] or [], key=lambda b: b["id"])])
            t.items("segments", [item(self.cable, x) for x in self.cables])

        t.block("{", "}", [body])
        return "\n".join(t.lines) + "\n"


def safe_name(s: str | None) -> str:
    """A part of a path: no separators."""
    return (s or "").translate(str.maketrans("/\\:", "___"))


def file_part(c: Column) -> Column:
    """safe_name as a column expression."""
    return F.translate(c, "/\\:", "___")


def export(container: DataFrame, equipment: DataFrame, edges: DataFrame, attributes: DataFrame, satellites: DataFrame, geometry: DataFrame | None = None, dialect: int = 2, default_region: str = "default") -> DataFrame:
    """(path, kind, body): a document for each container of a type that has one, in a form that documents.facts reads back.

    container(id, type, parent_id), equipment(id, container_id, class), edges(equipment_id, t1, t2), attributes(owner_id, key,
    value), satellites(owner_id, seq, class, attributes map<string,string>), geometry(owner_id, lat, lon). The region is the
    container's attribute `region`. Dialect 2: a cable inside one station stands in that station's document, connections name
    the other files at their node, equipment with an edge but no container stands in its region's boundary documents.
    Dialect 1: no boundary documents, every cable has its own. GND as second end is left out.
    """
    if dialect not in (1, 2):
        raise ValueError("there are dialects 1 and 2")
    tops = cut(housing.root_containers(container))
    attrs = attributes.filter("key IS NOT NULL AND value IS NOT NULL").groupBy("owner_id", "key").agg(F.sort_array(F.collect_list("value")).alias("v"))
    attrs = cut(attrs.groupBy("owner_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "v")))).alias("attributes")))
    sats = satellites.groupBy("owner_id").agg(F.sort_array(F.collect_list(F.struct("seq", F.col("class"), F.map_entries("attributes").alias("a")))).alias("s"))
    sats = sats.select("owner_id", F.transform("s", lambda s: F.struct(s["class"].alias("class"), F.map_from_entries(s["a"]).alias("attributes"))).alias("satellites"))
    region_of = attrs.select(F.col("owner_id").alias("root"), F.nullif(F.get(F.col("attributes")["region"], F.lit(0)), F.lit("")).alias("region")).filter("region IS NOT NULL")
    head = tops.select("root", "root_type").distinct().join(region_of, "root", "left").withColumn("region", F.coalesce("region", F.lit(default_region)))

    inside = cut(housing.internal_cables(equipment, edges, tops)) if dialect == 2 else None
    boxes = container.select(F.col("id").alias("container_id"), "type")
    of = equipment.select("id", "class", "container_id").join(tops, "container_id").join(boxes, "container_id")
    role = F.when(F.col("root_type") == "acline", "cable").when(F.col("type") == "busbar", "section").otherwise("device")
    of = of.withColumn("role", role).withColumn("holder", F.when(F.col("type").isin("bay", "busbar"), F.col("container_id")))
    if inside is not None:
        of = of.join(inside, "root", "left").withColumn("root", F.coalesce("station", "root"))
    else:
        of = of.withColumn("station", F.lit(None).cast("string"))
    of = of.select("root", "id", "class", "role", "holder", ((F.col("role") != "cable") | F.col("station").isNotNull()).alias("_c"))
    wires = edges.select(F.col("equipment_id").alias("id"), "t1", "t2").dropDuplicates(["id"])
    if dialect == 2:
        lost = wires.join(equipment.filter("container_id IS NOT NULL AND container_id <> ''").select("id"), "id", "left_anti").join(equipment.select("id", "class").dropDuplicates(["id"]), "id", "left")
        lost = lost.join(attrs.select(F.col("owner_id").alias("id"), F.nullif(F.get(F.col("attributes")["region"], F.lit(0)), F.lit("")).alias("region")), "id", "left")
        lost = running(lost.select("id", "class", F.coalesce("region", F.lit(default_region)).alias("region")), ["region"], ["id"])
        no = F.floor(F.col("_rank") / BOUNDARY_ITEMS) + 1
        lost = lost.withColumn("root", F.concat(F.lit("!"), "region", F.lit("!Boundary"), F.when(no > 1, F.concat(F.lit("-"), no.cast("string"))).otherwise("")))
        lost = cut(lost.select("root", "id", "class", "region"))
        of = of.unionByName(lost.select("root", "id", "class", F.lit("device").alias("role"), F.lit(None).cast("string").alias("holder"), F.lit(None).cast("boolean").alias("_c")))
        head = head.unionByName(lost.select("root", F.lit("boundary").alias("root_type"), "region").distinct())
    items = of.join(wires, "id", "left").join(attrs.withColumnRenamed("owner_id", "id"), "id", "left").join(sats.withColumnRenamed("owner_id", "id"), "id", "left")
    items = items.withColumn("attributes", F.coalesce("attributes", F.create_map().cast("map<string,array<string>>")))
    items = items.withColumn("class", F.coalesce("class", F.get(F.col("attributes")[CLASS_KEY], F.lit(0))))
    nothing = F.lit(None).cast("array<struct<region:string,folder:string,file:string>>")
    for i in (1, 2):
        if dialect == 2:
            files = cut(housing.node_files(equipment, edges, tops, inside, head.select("root", "region"))) if i == 1 else files
            # A cable's file names the stations at its ends, a station's or a house's the cables, a boundary document none.
            own = files.select(F.col("node").alias(f"t{i}"), F.col("cable").alias("_c"), F.col("refs").alias(f"refs{i}"), F.col("more").alias(f"more{i}"))
            items = items.join(own, [f"t{i}", "_c"], "left")
        else:
            items = items.withColumn(f"refs{i}", nothing).withColumn(f"more{i}", F.lit(0))
    wanted = ["id", "class", "role", "holder", "t1", "t2", "refs1", "more1", "refs2", "more2", "attributes", "satellites"]
    packed = items.groupBy("root").agg(F.collect_list(F.struct(*wanted)).alias("items"))
    bays = container.filter("type = 'bay'").select("id", F.col("parent_id").alias("root")).join(attrs.withColumnRenamed("owner_id", "id"), "id", "left").groupBy("root").agg(F.collect_list(F.struct("id", "attributes")).alias("bays"))
    docs = head.join(packed, "root", "left").join(bays, "root", "left").join(attrs.withColumnRenamed("owner_id", "root"), "root", "left")
    if geometry is not None:
        place = geometry.groupBy("owner_id").agg(F.min(F.struct("lat", "lon")).alias("p")).select(F.col("owner_id").alias("root"), "p.lat", "p.lon")
        docs = docs.join(place, "root", "left")
    else:
        docs = docs.withColumn("lat", F.lit(None).cast("double")).withColumn("lon", F.lit(None).cast("double"))
    if inside is not None:
        docs = docs.join(inside.select("root"), "root", "left_anti")
    folder = F.create_map(*(F.lit(x) for kv in {**housing.FOLDERS, "boundary": housing.BOUNDARY}.items() for x in kv))
    name = F.when(F.col("root_type") == "boundary", F.substring_index("root", "!", -1)).when(F.col("root_type") == "acline", F.regexp_replace("root", f"^{housing.CABLE}", "")).otherwise(F.col("root"))
    path = F.concat(file_part(F.col("region")), F.lit("/"), folder[F.col("root_type")], F.lit("/"), file_part(name), F.lit(".hjson"))
    rows = docs.select(path.alias("path"), folder[F.col("root_type")].alias("kind"), "root", "region", "attributes", "lat", "lon", "items", "bays")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_Renderer(r, dialect).text() for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["path", "kind", "body"])

    return rows.mapInArrow(run, "path string, kind string, body string")


def write_tree(documents: DataFrame, folder: str) -> None:
    """Write documents (path, body) as the files of a tree under `folder`, a path or URI that all executors share.

    A file is written beside its place and then moved there, so that a lost executor leaves no half file.
    """
    uri = folder if "://" in folder else f"file://{folder}"

    def write(rows: Iterator) -> None:
        target, base = fs.FileSystem.from_uri(uri)
        for r in rows:
            at = f"{base}/{r['path']}"
            target.create_dir(at.rsplit("/", 1)[0], recursive=True)
            with target.open_output_stream(f"{at}.part") as out:
                out.write(r["body"].encode())
            target.move(f"{at}.part", at)

    documents.select("path", "body").foreachPartition(write)


def read_tree(spark: SparkSession, folder: str) -> DataFrame:
    """(file_id, path, body) of all `*.hjson` files of a tree; path is relative to the tree."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.hjson").format("binaryFile").load(folder)
    path = F.regexp_replace("path", "^.*?" + re.escape(folder.split("://")[-1].rstrip("/")) + "/", "")
    return rows.select(path.alias("path"), F.col("content").cast("string").alias("body")).withColumn("file_id", F.col("path"))
