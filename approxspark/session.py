"""Session helpers: a tuned local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "approxspark") -> SparkSession:
    """Local session used by tests and bench. On a cluster, callers pass their own session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # let AQE coalesce / re-plan inside persisted samples too (they contain a shuffle)
        .config("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (spark.checkpoint.dir).

    Only when the session has none and runs in local mode (tests) do we set a fresh scratch folder;
    on a cluster without the setting this raises instead of writing to machine-local disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        # executors cannot share a machine-local folder: a cluster must name a shared one
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    folder = tempfile.mkdtemp(prefix="approxspark-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder, for written intermediate tables / stream state.

    The folder is addressed as the cluster names it (any scheme Spark can write) and is made by the
    first writer, never by the driver's own file calls.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders through the Hadoop filesystem API (missing ones are fine)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def list_scratch(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any filesystem; none if it doesn't exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


#: Folders that :func:`store` has written, in order.
_stored: list[str] = []


def stored_so_far() -> int:
    """A mark: tables stored from here on can be dropped by :func:`drop_stored`."""
    return len(_stored)


def drop_stored(spark: SparkSession, since: int, *keep: str) -> None:
    """Drop the tables stored since a mark, once nothing reads them any more, but those to ``keep``."""
    drop_scratch(spark, *[p for p in _stored[since:] if p not in keep])
    _stored[since:] = [p for p in _stored[since:] if p in keep]


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _stored.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once a Spark context, so that their Python workers can import it
    wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_approxspark_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="approxspark-"), "approxspark_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._approxspark_shipped = True
