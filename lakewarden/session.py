"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
# The folder that ``scratch`` names; each thread has its own.
_scope: ContextVar[str] = ContextVar("scope", default="")
# Called with each table before it is staged and its label; tests look at the plans of those jobs.
watchers: list[Callable[[DataFrame, str], None]] = []


def build_session(app: str = "lakewarden", master: str | None = None, folder: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; a cluster usually brings its own.

    ``folder`` is where intermediate tables go, reachable by every executor; it becomes ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Files are compressed and dictionary-coded; the planner's broadcast threshold is about memory.
        "spark.sql.sources.fileCompressionFactor": "4.0",
        **({"spark.checkpoint.dir": folder} if folder else {}),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session without that setting falls back to a folder of this machine.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="lakewarden-")
        root = _local_root
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{_scope.get()}{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(name: str) -> Iterator[None]:
    """What is staged inside goes to a folder of that name, which ``release`` can delete on its own."""
    before = _scope.set(f"{name}/")
    try:
        yield
    finally:
        _scope.reset(before)


def release(spark: SparkSession, name: str | None = None) -> None:
    """Delete what this application has staged, or the part under ``scratch(name)``.

    Results that still read it must have been written before.
    """
    root = shared_path(spark, "x").rpartition("/")[0] + (f"/{name}" if name else "")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def watched(df: DataFrame, label: str) -> DataFrame:
    """``df``, shown to the watchers."""
    for look in watchers:
        look(df, label)
    return df


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a form that survives lost executors. The file sizes give the planner
    exact statistics, so it broadcasts the table only below its own size threshold.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    watched(df, label).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(dfs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stage`` for several independent tables, whose jobs run side by side."""
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        # Each thread works in a copy of the caller's context, so that it stages under the same scratch folder.
        jobs = {label: pool.submit(copy_context().run, stage, df, label) for label, df in dfs.items()}
        return {label: job.result() for label, job in jobs.items()}
