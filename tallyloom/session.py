"""Session helpers: local session for tests and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
REMOVE_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app_name: str = "tallyloom", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    parallelism = str(cores) if cores != "*" else str(os.cpu_count() or 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def thrifty_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` that needs less disk: it writes smaller tables, and the shuffle files of a query go as soon as it
    has ended, instead of whenever the driver collects garbage.

    For long chains of queries that each end in a stored table. Changes of its settings and of those of ``spark`` don't meet.
    """
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set(REMOVE_SHUFFLES_CONF, "true")
    own.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named in ``spark.checkpoint.dir``.

    A cluster must name a shared folder there: executors write to it and may
    be lost afterwards. Only a local master may fall back to a temporary
    folder of this machine, which goes when the program ends.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        made = tempfile.mkdtemp(prefix="tallyloom-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(made)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch Parquet table and read it back.

    Cuts the lineage in a way that survives executor loss and fixes values
    that a re-run could number differently.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like :func:`materialize`, in buckets by the hash of ``key``: two such tables with as many buckets are joined on it without a shuffle.

    ``df`` should come dealt by ``key`` into as many partitions, so that every bucket is one file. The table is named only to be opened.
    """
    spark = df.sparkSession
    table = f"tallyloom_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).option("compression", "zstd")
    writer.saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # its files are outside the warehouse and stay
    return stored


def spread(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """The same rows over so many tasks that each has about ``rows``, for costly work on tables of few bytes; up to that many stay as they are."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df
