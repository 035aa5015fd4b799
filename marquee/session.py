"""Session defaults. Everything here can be overridden by spark-submit --conf."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "marquee", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only where the setting is absent on a local master (tests) is a temporary folder made, once per
    process; on a cluster its absence is an error, because executors would write to their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="marquee-"))
        folder = _local_folder[0]
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/marquee-{spark.sparkContext.applicationId}"


@dataclass
class _Scope:
    """The part of the scratch folder, and the catalog entries, of one job."""

    folder: str
    tables: list[str] = field(default_factory=list)


_scope: ContextVar[_Scope | None] = ContextVar("marquee_scratch", default=None)


def scratch_path(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """A fresh path in this application's part of the shared folder; inside `passing_scratch` it lives
    as long as the block does, unless it is `lasting`."""
    scope = _scope.get()
    folder = scope.folder if scope and not lasting else _own_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def enter_table(name: str) -> None:
    """Note a catalog entry over a scratch path, to be dropped with it."""
    scope = _scope.get()
    if scope:
        scope.tables.append(name)


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends, also by an error.

    For jobs that write their result: what the block hands out must not read from them any more.
    """
    scope = _Scope(f"{_own_folder(spark)}/job-{uuid.uuid4().hex}")
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        for name in scope.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        _delete(spark, scope.folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all of this application's intermediate tables; call it when no result is still to be read."""
    _delete(spark, _own_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
