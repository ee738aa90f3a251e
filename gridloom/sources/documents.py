"""Document trees (`<region>/<kind>/<id>`, in the text form of doctext) to facts, in both dialects.

Dialect 2 marks a file's own names with `@`, shortens attribute keys and knows boundary documents, schedules, steps and paths;
dialect 1 takes a name for its own unless it begins with a known container, and keeps keys as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut, spread
from gridloom.sources.doctext import number, read, value_text

#: Folder of a container kind, the class its object gets, and the model's container type.
KINDS = {"ONS": ("Substation", "substation"), "KVS": ("Substation", "distribution-box"), "Kabel": ("ACLine", "acline"), "Haushalte": ("Building", "house"), "Grenzknoten": ("Boundary", "boundary")}
#: Only cables may lie in this region.
INTERREGIONAL = "interregional"
GROUND = "GND"
#: Attributes in kW or kvar in documents and in MW or Mvar in the model.
KILO_KEYS = frozenset(("EnergyConsumer.p", "EnergyConsumer.q", "PowerElectronicsConnection.p", "PowerElectronicsConnection.q", "PowerElectronicsConnection.ratedS"))
#: Bare keys that belong to one class, whatever the object (Sv objects excepted), by class.
CLASS_KEYS = {
    "IdentifiedObject": "mRID InstanceSet",
    "Switch": "locked normalOpen retained open",
    "Equipment": "inService normallyInService EquipmentContainer",
    "PowerSystemResource": "AssetDatasheet PSRType",
    "Fuse": "nominalCurrent",
    "Meter": "measurementLocationIdentifier MeasuringSchedule TransmissionSchedule",
    "TimeSchedule": "disabled recurrencePeriod",
    "Conductor": "length",
    "ACLineSegment": "PerLengthImpedance",
    "BaseVoltage": "nominalVoltage",
    "PowerElectronicsUnit": "maxP minP PowerElectronicsConnection technicalResourceIdentifier",
    "PowerElectronicsConnection": "controllableResourceIdentifier",
    "EnergyConsumer": "LoadResponse",
    "PowerTransformer": "PowerTransformerEnd",
    "PowerTransformerEnd": "connectionKind maxApparentPowerFactor PowerTransformer ratedS",
    "RatioTapChanger": "tculControlMode",
    "RegulatingCondEq": "controlEnabled",
    "RegulatingControl": "discrete enabled maxAllowedTargetValue minAllowedTargetValue mode targetValueUnitMultiplier",
    "TapChanger": "TapChangerControl",
    "Terminal": "ConnectivityNode SvPowerFlow",
    "UsagePoint": "ratedPower Building UsagePointLocation",
    "VoltageLevel": "Substation",
    "Feeder": "NormalEnergizingSubstation",
    "Measurement": "unitMultiplier unitSymbol",
    "AsynchronousMachine": "asynchronousMachineType",
    "SynchronousMachine": "operatingMode shortCircuitRotorType InitialReactiveCapabilityCurve",
    "WindGeneratingUnit": "windGenUnitType",
    "GeneratingUnit": "genControlSource",
    "FossilFuel": "fossilFuelType ThermalGeneratingUnit",
    "CoordinateSystem": "crsUrn",
    "Diagram": "orientation",
    "Curve": "curveStyle xUnit y1Unit y2Unit",
    "DiscreteControlLimit": "value",
    "OperationalLimitType": "direction",
}
CLASS_OF_KEY = {k: c for c, keys in CLASS_KEYS.items() for k in keys.split()}
FACT = "version bigint, id string, profile string, class string, attribute string, value string, is_reference boolean, seq int"
#: Facts handed on at once by the parser.
FACTS_PER_BATCH = 20_000


def classify(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """files (file_id, path, body, ...) with region, folder, class_ and container_id by path; and errors (source_file, message).

    A path has exactly three parts; the kind must be known, the name not empty, and only cables may be interregional. Of a
    container that two different paths describe every file is an error.
    """
    part = F.split("path", "/")
    name = F.regexp_replace(F.get(part, F.lit(2)), r"\.[^.]*$", "")
    f = files.withColumns({"region": F.get(part, F.lit(0)), "folder": F.get(part, F.lit(1)), "container_id": name})
    kind = F.create_map(*(x for k, (c, _) in KINDS.items() for x in (F.lit(k), F.lit(c))))
    twice = f.select("container_id", "path").distinct().groupBy("container_id").agg((F.count(F.lit(1)) > 1).alias("twice"))
    f = f.withColumn("class_", F.try_element_at(kind, F.col("folder"))).join(twice, "container_id", "left")
    wrong = (
        F.when(F.col("path").isNull() | (F.size(part) != 3), "path is not <region>/<kind>/<id>")
        .when(F.col("class_").isNull(), F.concat(F.lit("unknown kind "), F.col("folder")))
        .when(F.col("container_id") == "", "file without a name")
        .when((F.col("region") == INTERREGIONAL) & (F.col("folder") != "Kabel"), "only cables may be interregional")
        .when(F.col("twice"), "container described by several files")
    )
    f = f.withColumn("_wrong", wrong)
    return f.filter("_wrong IS NULL").drop("_wrong", "twice"), f.filter("_wrong IS NOT NULL").select(F.col("path").alias("source_file"), F.col("_wrong").alias("message"))


def local_id(name: str, container: str) -> str:
    """`@x` is the container's own `<container>-x`; any other name stands for itself."""
    return f"{container}-{name[1:]}" if name.startswith("@") else name


def full_key(key: str, own: str) -> str:
    """A bare attribute key with its class: a fixed one for some keys (not on Sv objects), else the object's own."""
    if key == "name":
        return "IdentifiedObject.name"
    if "." in key:
        return key
    return f"{own if own.startswith('Sv') else CLASS_OF_KEY.get(key, own)}.{key}"


def _dict(x: object) -> dict:
    return x if isinstance(x, dict) else {}


def _list(x: object) -> list:
    return x if isinstance(x, list) else [] if x is None else [x]


class _Document:
    """One parsed body, walked once; rows() gives its facts and problems() what is wrong in it."""

    def __init__(self, container: str, kind: str, dialect: int, resolve: Callable[[str], str]):
        self.container, self.kind, self.dialect = container, kind, dialect
        self.resolve = lambda x: GROUND if x == GROUND else resolve(str(x))
        self.facts: list[tuple] = []
        self.problems: list[str] = []

    def fact(self, id_: str, class_: str, attribute: str, value: object, reference: bool = False, seq: int = 0) -> None:
        text = value_text(value)
        if text is not None:
            self.facts.append((id_, class_, attribute, text, reference, seq))

    def attributes(self, id_: str, class_: str, entries: object, keyed: bool = True) -> None:
        """The entries of an attribute map, a list as one fact each; keyed: bare keys get their class (dialect 2)."""
        for k, v in _dict(entries).items():
            key = full_key(k, class_) if keyed and self.dialect == 2 else k
            for i, x in enumerate(v if isinstance(v, list) else [v]):
                kilo = key in KILO_KEYS and isinstance(x, int | float) and not isinstance(x, bool)
                self.fact(id_, class_, key, x / 1000 if kilo else x, seq=i)

    def place(self, id_: str, class_: str, geometry: object) -> None:
        """A location with its points in order; a point needs both coordinates, points without are left out."""
        points = [p for p in map(_dict, _list(geometry)) if all(isinstance(p.get(c), int | float) and not isinstance(p.get(c), bool) for c in ("lat", "lon"))]
        if points:
            where = f"{id_}-LOC"
            self.fact(id_, class_, "PowerSystemResource.Location", where, True)
            for i, p in enumerate(points, 1):
                at = f"{where}-PP{i}"
                self.fact(at, "PositionPoint", "PositionPoint.Location", where, True)
                for name, x in (("sequenceNumber", i), ("xPosition", float(p["lon"])), ("yPosition", float(p["lat"]))):
                    self.fact(at, "PositionPoint", f"PositionPoint.{name}", x)

    def ends(self, id_: str, nodes: list[str], least: int) -> None:
        if not least <= len(nodes) <= 2:
            self.problems.append(f"{id_}: connects must name 1 or 2 nodes, not {len(nodes)}")
            return
        for i, node in enumerate(nodes, 1):
            end = f"{id_}-T{i}"
            self.fact(end, "Terminal", "Terminal.ConductingEquipment", id_, True)
            self.fact(end, "Terminal", "Terminal.ConnectivityNode", node, True)
            self.fact(end, "Terminal", "ACDCTerminal.sequenceNumber", i)

    def satellites(self, id_: str, item: dict) -> None:
        """The item's satellites, and those that its schedules and steps stand for; numbered through, so that none shares an id."""
        own = [(s.get("class"), s.get("attributes")) for s in map(_dict, _list(item.get("satellites"))) if s]
        if self.dialect == 2:
            name = _dict(item.get("attributes")).get("name")
            for field in ("measuring", "transmission"):
                if isinstance(schedule := item.get(field), dict):
                    own.append(("TimeSchedule", schedule if "name" in schedule or name is None else schedule | {"name": name}))
            steps = [x for x in _list(item.get("steps")) if isinstance(x, int | float) and not isinstance(x, bool)]
            own += [("DiscreteControlLimit", {"name": f"{id_}-{i}", "DiscreteControlLimit.sequenceNumber": str(i), "DiscreteControlLimit.value": number(x)}) for i, x in enumerate(steps, 1)]
        for i, (class_, entries) in enumerate(own):
            sat, class_ = f"{id_}-SAT{i}", str(class_ or "Satellite")
            self.fact(sat, class_, "Satellite.Of", id_, True)
            self.attributes(sat, class_, entries)

    def item(self, id_: str, class_: str, item: dict, holder: str | None, nodes: list[str] | None, least: int) -> None:
        self.fact(id_, class_, "Equipment.EquipmentContainer", holder, True)
        self.attributes(id_, class_, item.get("attributes"))
        self.satellites(id_, item)
        if self.dialect == 2:
            self.place(id_, class_, item.get("geometry"))
        if nodes is not None:
            self.ends(id_, nodes, least)

    def equipment(self, found: object, holder: str | None) -> None:
        for e in map(_dict, _list(found)):
            if not e:
                continue
            name = e.get("id")
            if not e.get("class") or name is None:
                self.problems.append(f"equipment {name}: no class" if name is not None else "equipment without id")
                continue
            nodes = [self.resolve(n) for n in _list(e.get("connects")) if n is not None]
            self.item(self.resolve(name), str(e["class"]), e, holder, nodes, 0 if self.dialect == 2 else 1)

    def segments(self, found: object) -> None:
        for s in map(_dict, _list(found)):
            if s and s.get("id") is not None:
                nodes = [self.resolve(s[k]) for k in ("from", "to") if s.get(k) is not None]
                self.item(self.resolve(s["id"]), "ACLineSegment", s, None, nodes, 0 if self.dialect == 2 else 1)
            elif s:
                self.problems.append("segment without id")

    def busbars(self, found: object) -> None:
        """Each busbar is a voltage level of its own. Dialect 2: its id names its one node, shared by its sections, whose ids
        are its own and a number; dialect 1: each section is a node."""
        for bus in map(_dict, _list(found)):
            name = bus.get("id")
            if name is None:
                continue
            node = self.resolve(name)
            level = f"{node}-VL" if self.dialect == 2 else node
            self.fact(level, "VoltageLevel", "VoltageLevel.Substation", self.container, True)
            self.fact(level, "VoltageLevel", "IdentifiedObject.name", name)
            for sec in map(_dict, _list(bus.get("sections"))):
                if sec.get("id") is None:
                    continue
                own = self.resolve(f"{name}-{value_text(sec['id'])}") if self.dialect == 2 else self.resolve(sec["id"])
                # What all sections share stands at the busbar; a section's own entry goes before it.
                shared = {k: v for k, v in _dict(bus.get("attributes")).items() if k not in _dict(sec.get("attributes"))} if self.dialect == 2 else {}
                self.item(own, "BusbarSection", sec | {"attributes": shared | _dict(sec.get("attributes"))}, level, [node if self.dialect == 2 else own], 1)

    def walk(self, body: dict) -> None:
        box = self.container
        own = body.get("equipments", body.get("equipment"))
        if self.kind in ("Substation", "Building"):
            self.fact(box, self.kind, "IdentifiedObject.name", box)
            self.attributes(box, self.kind, body.get("attributes"), keyed=False)
            self.place(box, self.kind, body.get("geometry"))
        if self.kind == "Substation":
            self.busbars(body.get("busbars"))
            for bay in map(_dict, _list(body.get("bays"))):
                if bay.get("id") is not None:
                    at = self.resolve(bay["id"])
                    self.fact(at, "Feeder", "Feeder.NormalEnergizingSubstation", box, True)
                    title = _dict(bay.get("attributes")).get("name") if self.dialect == 2 else None
                    self.fact(at, "Feeder", "IdentifiedObject.name", title if isinstance(title, str) and title else bay["id"])
                    self.equipment(bay.get("equipments", bay.get("equipment")), at)
        if self.kind == "Building" or self.dialect == 2 and self.kind in ("Substation", "Boundary"):
            self.equipment(own, None if self.kind == "Boundary" else box)
        if self.kind == "ACLine" or self.dialect == 2 and self.kind == "Substation":
            self.segments(body.get("segments"))


def _clean(x: object) -> object:
    return x.encode("utf-8", "replace").decode() if isinstance(x, str) and not x.isascii() else x


def _walked(files: DataFrame, version: int, dialect: int, known: DataFrame | None) -> DataFrame:
    """The facts of all files, and one row with a message for each problem."""
    rows = files.select("file_id", F.col("path").alias("source_file"), "container_id", "class_", "body")
    if known is not None:
        rows = rows.join(known, "file_id", "left").select(*rows.columns, F.coalesce("names", F.array().cast("array<string>")).alias("names"))
    schema = pa.schema([("id", pa.string()), ("class", pa.string()), ("attribute", pa.string()), ("value", pa.string()), ("is_reference", pa.bool_()), ("seq", pa.int32()), ("source_file", pa.string()), ("message", pa.string())])

    def documents(batch: pa.RecordBatch) -> Iterator[tuple]:
        for r in batch.to_pylist():
            box = r["container_id"]
            if dialect == 2:
                resolve = lambda n, box=box: local_id(n, box)
            else:
                resolve = lambda n, box=box, names=frozenset(r["names"]): n if n in names else f"{box}-{n}"
            doc = _Document(box, r["class_"], dialect, resolve)
            try:
                body = read(r["body"] or "")
                if not isinstance(body, dict):
                    raise ValueError("not an object")
                doc.walk(body)
            except ValueError as e:
                doc.facts.clear()
                doc.problems = [str(e)]
            for f in doc.facts:
                yield *map(_clean, f), r["source_file"], None
            for p in doc.problems:
                yield None, None, None, None, False, 0, r["source_file"], _clean(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple] = []
        for b in batches:
            for f in documents(b):
                part.append(f)
                if len(part) >= FACTS_PER_BATCH:
                    yield _batch(part, schema)
                    part = []
        if part:
            yield _batch(part, schema)

    out = spread(rows).mapInArrow(run, "id string, class string, attribute string, value string, is_reference boolean, seq int, source_file string, message string")
    return out.select(F.lit(version).cast("bigint").alias("version"), "id", F.lit("EQ").alias("profile"), "class", "attribute", "value", "is_reference", "seq", "source_file", "message")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def names_of(files: DataFrame) -> DataFrame:
    """(file_id, name): every name that a file of dialect 1 gives to something or refers to."""
    fields = ("id", "from", "to", "connects")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                try:
                    todo = [read(r["body"] or "")]
                except ValueError:
                    continue
                found: set[str] = set()
                while todo:
                    x = todo.pop()
                    todo += x.values() if isinstance(x, dict) else x if isinstance(x, list) else []
                    if isinstance(x, dict):
                        found.update(str(v) for f in fields for v in _list(x.get(f)) if v is not None and not isinstance(v, dict | list))
                out += [(r["file_id"], _clean(n)) for n in found]
            yield _batch(out, pa.schema([b.schema.field("file_id"), ("name", pa.string())])) if out else pa.RecordBatch.from_pylist([], pa.schema([b.schema.field("file_id"), ("name", pa.string())]))

    kind = files.schema["file_id"].dataType.simpleString()
    return spread(files.select("file_id", "body")).mapInArrow(run, f"file_id {kind}, name string")


def known_names(names: DataFrame, containers: DataFrame) -> DataFrame:
    """(file_id, name) of the names that are a container's id or begin with one and `-` (containers: column id).

    A name is looked up by each of its beginnings before a `-`, so this is one equi-join whatever the number of containers;
    which of several that fit is the longest doesn't matter, the name stays as it is.
    """
    parts = F.split("name", "-")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "-"))
    tried = names.withColumn("id", F.explode(starts))
    return tried.join(containers.select("id").dropna().distinct(), "id", "left_semi").select("file_id", "name").distinct()


def split_facts(files: DataFrame, version: int, dialect: int = 2) -> tuple[DataFrame, DataFrame]:
    """Facts (FACT) and errors (version, source_file, message) of classified files (see classify), each parsed once.

    A body that cannot be read is one error and gives no facts; equipment without class or with more than two connections
    is an error of its own, the rest of its document stays. Repeated files count once.
    """
    if dialect not in (1, 2):
        raise ValueError("there are dialects 1 and 2")
    known = None
    if dialect == 1:
        names = known_names(names_of(files), files.select(F.col("container_id").alias("id")))
        known = names.groupBy("file_id").agg(F.collect_set("name").alias("names"))  # of one file
    both = cut(_walked(files, version, dialect, known))
    facts = both.filter("message IS NULL").drop("source_file", "message").distinct()
    return facts, both.filter("message IS NOT NULL").select("version", "source_file", "message").distinct()


def facts(files: DataFrame, version: int, dialect: int = 2) -> DataFrame:
    return split_facts(files, version, dialect)[0]


def facts_and_errors(files: DataFrame, version: int, dialect: int = 2) -> tuple[DataFrame, DataFrame]:
    """classify and split_facts in one: the facts of a tree, and all errors (version, source_file, message) of paths and bodies."""
    good, wrong = classify(files)
    found, problems = split_facts(good, version, dialect)
    return found, problems.unionByName(wrong.select(F.lit(version).cast("bigint").alias("version"), "source_file", "message").distinct())


def key_class(key: Column, own: Column) -> Column:
    """full_key as a column expression."""
    table = F.create_map(*(x for k, c in CLASS_OF_KEY.items() for x in (F.lit(k), F.lit(c))))
    cls = F.when(own.startswith("Sv"), own).otherwise(F.coalesce(F.try_element_at(table, key), own))
    return F.when(key == "name", F.lit("IdentifiedObject.name")).when(F.contains(key, F.lit(".")), key).otherwise(F.concat(cls, F.lit("."), key))
