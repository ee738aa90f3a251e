"""Session helpers: sessions for tests and benches, table access, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_WRITTEN: dict[str, SparkSession] = {}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the session comes from outside."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gridloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; one of its own only where that is unset and all runs on this machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get("gridloom.scratch.dir", None)
    if not own:
        own = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("gridloom.scratch.dir", own)
    return own


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores, for costly work on each row; few small files make few."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def cut(df: DataFrame) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    The lineage ends there, every executor can read it after another one is lost, and unlike an RDD checkpoint the
    table keeps column pruning, filter pushdown and size statistics. The files are removed when the driver exits, or
    before by drop().
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/gridloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN[path] = spark
    back = spark.read.schema(df.schema).parquet(path)
    back._gridloom_path = path  # type: ignore[attr-defined]
    return back


def cut_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """cut(), and how many rows fulfil each condition, counted while they are written. A task that ran twice may count twice; 0 is always right."""
    seen = Observation()
    back = cut(df.observe(seen, *(F.count_if(c).alias(n) for n, c in counts.items())))
    found = seen.get
    return back, {n: int(found.get(n) or 0) for n in counts}


def drop(df: DataFrame | None) -> None:
    """Remove the files behind a frame made by cut() that nothing will read again."""
    path = getattr(df, "_gridloom_path", None)
    if path:
        _remove(path)


def _remove(path: str) -> None:
    spark = _WRITTEN.pop(path, None)
    if spark is None:
        return
    try:
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the folder goes with it
        pass


@atexit.register
def _clean() -> None:
    for path in list(_WRITTEN):
        _remove(path)
