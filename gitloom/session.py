"""Session defaults and the scratch space that jobs use to cut lineage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from gitloom.sources.paths import remove

_scopes = threading.local()

# Settings the operators were planned for; all can be overridden.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "gitloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without it: there the warehouse takes the scratch tables.
    On a cluster an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end: results must be written before."""
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            remove(spark, path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when a query ends, not when the driver next
    collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has no lineage, survives the loss of executors, and fixes values
    that must not be computed twice (model replies, partition numbers). A caller that
    gives the ``path`` may remove the table before the end of the job.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_measured(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """As :func:`cut`, with aggregates of the rows taken while they are written."""
    seen = Observation()
    named = [m.alias(name) for name, m in measures.items()]
    stored = cut(df.observe(seen, *named), label)
    found = observed(seen)
    return stored, stored.agg(*named).first().asDict() if found is None else found


def observed(seen: Observation) -> dict | None:
    """What was observed; None where Spark knew that there are no rows and observed nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        return None
