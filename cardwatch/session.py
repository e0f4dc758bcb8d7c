"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}
_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def build_session(name: str = "cardwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; cluster sizing is left to submit."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Weekday, hour and day boundaries follow the session zone; all results are defined in UTC.

    A session in another zone is switched, with a warning.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z"):
        warnings.warn(f"session zone {zone} is set to UTC, in which days are defined", stacklevel=3)
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the one set on the context.

    Only a local session without either (a test) gets a temporary folder, deleted when Python ends.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        shared = _LOCAL_SCRATCH.get(context.applicationId)
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="cardwatch-")
        _LOCAL_SCRATCH[context.applicationId] = shared
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return shared.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below that of the :func:`scratch` scope around it."""
    path = f"{_SCOPE.get() or _shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPE.get() is None:
        _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def scratch(spark: SparkSession, name: str = "scope") -> Iterator[str]:
    """Derived tables written inside are deleted at its end, also after an error.

    For work whose result does not read them any more, such as a job that writes its own outputs.
    """
    path = f"{_SCOPE.get() or _shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    token = _SCOPE.set(path)
    try:
        yield path
    finally:
        _SCOPE.reset(token)
        _delete(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the derived tables that this session wrote outside of a :func:`scratch` scope.

    DataFrames that read them cannot be used any more.
    """
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table to scratch and read it back.

    It is computed once, its lineage ends at the files, and Spark knows its true size when it
    chooses between a broadcast and a shuffle.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
