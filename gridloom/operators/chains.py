"""Collapsed connections: from every busbar terminal along passing equipment to the next busbar, transformer or house."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.skew import salted_join
from gridloom.session import cut, drop

#: Steps after which a walk is taken for endless and an error is raised; nothing is dropped silently.
MAX_STEPS = 10_000


def collapse(terminals: DataFrame, kinds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Connections, their terminals and their cable segments.

    terminals: terminal_id, equipment_id, node_id, sequence (copies `#n` folded into their id). kinds: equipment_id, class,
    stop (busbar, transformer, house or null for equipment that is passed).

    A walk starts at each terminal of a busbar whose node has other equipment, and steps over nodes from equipment to
    equipment. A stop ends it. Cables passed are its segments, Switch and Junction terminals its middle terminals. Behind
    passed equipment the walk goes on at every other node of it and forks over the equipment there; a node with nothing
    else is a dead end, which ends the walk at the equipment's own far terminal. At a fork where neither side is a Switch
    or Junction and the passed equipment no Fuse, the far terminal is a middle terminal too. Equipment with one terminal
    only ends a walk without result. A walk never passes the same equipment or node twice, so that a ring ends it without
    result. Of the two walks between two busbars that of the lesser busbar is kept.

    Returns connection(connection_id, source_terminal, target_terminal, target_kind), terminal_map(connection_id,
    terminal_id, sequence_number) and segment(connection_id, equipment_id, sequence_number). connection_id is
    `<source>~<target>` and a hash of the way where several lead there.
    """
    t = terminals.select("terminal_id", F.regexp_replace("equipment_id", "#[0-9]+$", "").alias("equipment_id"), "node_id").dropna().distinct()
    t = cut(t.join(kinds.select("equipment_id", "class", "stop").dropDuplicates(["equipment_id"]), "equipment_id", "left"))
    # What may come next at a node, and how much is there: a walk must know whether it forks or ends.
    there = t.groupBy("node_id").agg(F.countDistinct("equipment_id").alias("n_there"))
    t = cut(t.join(there, "node_id"))
    next_ = t.select("node_id", F.col("terminal_id").alias("n_t"), F.col("equipment_id").alias("n_e"), F.col("class").alias("n_class"), F.col("stop").alias("n_stop"))
    out = t.select(F.col("equipment_id").alias("n_e"), F.col("terminal_id").alias("far_t"), F.col("node_id").alias("far_node"), "n_there")

    empty = F.array().cast("array<string>")
    walk = t.filter("stop = 'busbar' AND n_there > 1").select(
        F.col("terminal_id").alias("source"), F.col("equipment_id").alias("source_e"), "node_id", F.array("equipment_id").alias("path"), F.array("node_id").alias("nodes"), empty.alias("segments"), empty.alias("mids"),
        F.lit(None).cast("string").alias("fork_t"), F.lit(False).alias("fork_ok"),
    )
    done: list[DataFrame] = []
    walk = cut(walk)
    for _ in range(MAX_STEPS):
        if walk.isEmpty():
            break
        at = cut(salted_join(walk, next_, ["node_id"]).filter(~F.array_contains("path", F.col("n_e"))))
        # A fork's far terminal counts unless the equipment stepped on is a Switch or Junction.
        middle = F.col("n_class").isin("Switch", "Junction")
        mids = F.when(F.col("fork_ok") & ~F.coalesce(middle, F.lit(False)), F.array_append("mids", F.col("fork_t"))).otherwise(F.col("mids"))
        at = at.withColumn("mids", mids)
        done.append(cut(at.filter(F.col("n_stop").isNotNull()).select("source", "source_e", F.col("n_t").alias("target"), F.col("n_e").alias("target_e"), F.col("n_stop").alias("target_kind"), "path", "segments", "mids")))
        on = at.filter(F.col("n_stop").isNull())
        on = on.withColumn("segments", F.when(F.col("n_class") == "ACLineSegment", F.array_append("segments", F.col("n_e"))).otherwise(F.col("segments")))
        on = on.withColumn("mids", F.when(F.coalesce(middle, F.lit(False)), F.array_append("mids", F.col("n_t"))).otherwise(F.col("mids")))
        on = on.withColumn("path", F.array_append("path", F.col("n_e")))
        on = salted_join(on.drop("node_id", "fork_t", "fork_ok"), out, ["n_e"]).filter((F.col("far_t") != F.col("n_t")) & ~F.array_contains("nodes", F.col("far_node")))
        on = cut(on)
        done.append(cut(on.filter("n_there = 1").select("source", "source_e", F.col("far_t").alias("target"), F.col("n_e").alias("target_e"), F.lit("dead_end").alias("target_kind"), "path", "segments", "mids")))
        fork = (F.col("n_there") > 2) & ~F.coalesce(F.col("n_class").isin("Switch", "Junction", "Fuse"), F.lit(False))
        fresh = cut(on.filter("n_there > 1").select("source", "source_e", F.col("far_node").alias("node_id"), "path", F.array_append("nodes", F.col("far_node")).alias("nodes"), "segments", "mids", F.col("far_t").alias("fork_t"), fork.alias("fork_ok")))
        for old in (walk, at, on):
            drop(old)
        walk = fresh
    else:
        raise RuntimeError(f"walks longer than {MAX_STEPS} steps")

    if not done:
        found = walk.select("source", "source_e", F.lit("").alias("target"), F.lit("").alias("target_e"), F.lit("").alias("target_kind"), "path", "segments", "mids")
    else:
        found = done[0]
        for f in done[1:]:
            found = found.union(f)
    found = found.filter((F.col("target_kind") != "busbar") | (F.col("source_e") < F.col("target_e"))).distinct()
    ways = found.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))
    found = found.join(ways, ["source", "target"])
    name = F.concat("source", F.lit("~"), "target")
    found = cut(found.withColumn("connection_id", F.when(F.col("n") > 1, F.concat(name, F.lit("~"), F.substring(F.md5(F.array_join("path", "|")), 1, 8))).otherwise(name)))
    along = F.concat(F.array("source"), F.col("mids"), F.array("target"))
    number = lambda c, name: found.select("connection_id", F.posexplode(c).alias("i", name)).select("connection_id", name, (F.col("i") + 1).alias("sequence_number"))
    return found.select("connection_id", F.col("source").alias("source_terminal"), F.col("target").alias("target_terminal"), "target_kind"), number(along, "terminal_id"), number(F.col("segments"), "equipment_id")
