"""Session, table and shared-folder helpers used by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "litholake", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the engine relies on (UTC, AQE, Arrow); existing cluster settings are kept."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A test table; timestamps become session-zone timestamps. With ``columns`` only those are selected."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    ntz = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    ``spark.checkpoint.dir`` names it on a cluster. Only where that is unset (tests, local runs) a folder of this
    machine is made and registered, so that ``DataFrame.checkpoint`` works too.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="litholake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir("file://" + own)
    return sc.getCheckpointDir().rstrip("/")


_WRITTEN: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a cut of the lineage that survives lost executors.

    What is still there when the program ends is deleted then; ``discard`` deletes it earlier."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame | None) -> None:
    """Deletes the files of a table that ``materialise`` returned and that nothing reads any more."""
    if df is not None:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of this session through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _drop_all() -> None:
    for spark, path in _WRITTEN:
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001 - the session is gone, and the folder is the cluster's to clean
            return


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly where the input has fewer splits than the cluster has cores (one small file); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df
