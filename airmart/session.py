"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_roots: dict[str, str] = {}
# The innermost scope of the running thread or task; scopes of others are never touched.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def build_session(app: str = "airmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this package relies on.

    Sizes (shuffle partitions, memory) belong to whoever runs the cluster; pass
    them as ``**{"spark.some.key": "value"}``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    # Stream state (an entry per station and hour) may outgrow the heap, and states of several values need it.
    builder = builder.config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_STATE)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session,
    where driver and executors share one machine, may fall back to a new
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="airmart-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the scratch folder; nothing exists there yet.

    Removed when the surrounding ``scratch_scope`` ends, or else with the driver JVM.
    """
    folder = f"{scratch_root(spark)}/airmart/{label}-{uuid.uuid4().hex}"
    fs, hadoop_path = _file_system(spark, folder)
    # Only what exists can be marked for removal, so the path handed out lies below.
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    scope = _scope.get()
    if scope is not None:
        scope.append(folder)
    return f"{folder}/data"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove scratch tables made inside as soon as their results are written."""
    own: list[str] = []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        for folder in own:
            fs, hadoop_path = _file_system(spark, folder)
            fs.delete(hadoop_path, True)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Cuts lineage without tying data to an executor, so a lost executor costs a
    re-read and not a re-run, and gives later passes a column-pruned scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
