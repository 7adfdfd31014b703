"""Session helpers: table readers, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
#: Bytes of rows that go to a Python worker at once.
ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = "8m"
_OWN_DIR: list[str] = []
_MADE: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be on any store that Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package when it was not installed on them, and bound the batches they get.

    A batch of 10,000 long texts is copied several times between JVM and Python; ARROW_BYTES of them do as well.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    if spark.conf.get(ARROW_LIMIT) == "67108864b":  # Spark's default
        spark.conf.set(ARROW_LIMIT, ARROW_BYTES)
    return spark


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, so that Spark and Python tasks mean the same store by it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local-mode session that names none (as in tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return qualified(spark, named)
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_DIR:
        own = tempfile.TemporaryDirectory(prefix="lettermill-", ignore_cleanup_errors=True)
        atexit.register(own.cleanup)
        _OWN_DIR.append(own.name)
    return f"file://{_OWN_DIR[0]}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, swept when this driver ends."""
    if not _MADE:
        atexit.register(sweep)
    path = f"{shared_dir(spark)}/lettermill/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def sweep() -> None:
    """Delete this driver's scratch paths; tables that were read from them can be read no more."""
    spark = SparkSession.getActiveSession()
    context = spark.sparkContext if spark else None
    if context is None or context._jsc is None:
        return
    for path in _MADE:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    _MADE.clear()


def make_folder(spark: SparkSession, path: str) -> str:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: a lineage cut that outlives executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Plans of these alone give the same rows in the same partitions each time.
SCANS = {"LogicalRelation", "DataSourceV2ScanRelation", "DataSourceV2Relation", "LocalRelation", "Project", "Filter"}


def rereadable(df: DataFrame) -> DataFrame:
    """df itself if it only scans a table; anything computed is written first.

    For steps that number rows by monotonically_increasing_id and join on the numbers: each evaluation must
    number alike.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    todo, fixed = [plan], plan.deterministic()
    while todo and fixed:
        node = todo.pop()
        fixed = node.nodeName() in SCANS
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return df if fixed else materialize(df, "input")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
