"""Session defaults and the written tables that cut long lineages."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, SparkSession] = {}


def session(app: str = "actloom", **conf: str) -> SparkSession:
    """A session with the settings the plans count on; a cluster's own settings win."""
    b = SparkSession.builder.appName(app)
    for k, v in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, which spark.checkpoint.dir names; a local session where it is unset uses its own warehouse folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        where = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, removed with the written tables."""
    path = f"{shared_folder(spark)}/actloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    _WRITTEN[path] = spark
    return path


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: later uses neither recompute it nor depend on a single executor."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written() -> None:
    """Remove all tables made by :func:`written` in this process."""
    for path, spark in list(_WRITTEN.items()):
        _WRITTEN.pop(path, None)
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone at exit
            pass


atexit.register(drop_written)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` for work that is heavy on each row: if its scan gives fewer tasks than the session has cores, its rows are spread over them; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
