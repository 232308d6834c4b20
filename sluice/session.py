"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Deduplication state outgrows the heap; RocksDB keeps it on disk and uploads changes only.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Documents vary from bytes to megabytes, so Python batches are bounded by size as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
}

_local_roots: dict[str, str] = {}
_recorders: list[list[str]] = []


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("sluice.spread.partitions", str(4 * spark.sparkContext.defaultParallelism))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and all executors can reach.

    Taken from ``spark.checkpoint.dir``. Only a local session, where everything
    runs on one machine, may fall back to a temporary folder.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="sluice-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    path = f"{shared_root(spark)}/sluice/{label}-{uuid.uuid4().hex}"
    for paths in _recorders:
        paths.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """Lists the scratch paths that are made inside the block, for :func:`remove_scratch` once nothing reads them any more."""
    paths: list[str] = []
    _recorders.append(paths)
    try:
        yield paths
    finally:
        _recorders.remove(paths)


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders of this session. DataFrames that still read them cannot be computed afterwards."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Bounds the Arrow batches of the jobs that run inside the block, for functions that get long texts; the session's own bound comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an expensive intermediate to the shared folder once and read it back.

    The copy survives the loss of executors and cuts the lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a table out to the partitions that the session asks for in ``sluice.spread.partitions``; by default it stays as it is.

    A choice of the session, not of the data: a local session sets it, since a small file is one split however many cores there are.
    """
    partitions = df.sparkSession.conf.get("sluice.spread.partitions", None)
    return df.repartition(int(partitions)) if partitions and not df.isStreaming else df
