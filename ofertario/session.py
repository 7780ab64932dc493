"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A build compiles more than the 100 classes Spark keeps by default.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Noting the call site of every column takes longer than building the plan;
    # switch it on to debug an expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Split skewed join partitions even where that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(app: str = "ofertario", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ofertario-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_folders: list[list[str]] = []


@contextmanager
def scratch(folders: list[str]):
    """Notes in ``folders`` what ``written`` writes meanwhile, for the caller to remove."""
    _folders.append(folders)
    try:
        yield
    finally:
        _folders.pop()


def written(df, label: str):
    """``df`` written once as parquet in the shared folder and read back.

    Cuts the lineage with files that outlive lost executors, and keeps VARIANT
    columns.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    if _folders:
        _folders[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
