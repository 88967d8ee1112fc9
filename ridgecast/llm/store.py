"""Lineage cuts: tables written to the folder that the cluster shares."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where that is unset, a temporary one on a single machine, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        named = "file://" + tempfile.mkdtemp(prefix="ridgecast-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


#: Spark's setting by which a query's shuffle files go when it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy(spark: SparkSession):
    """Queries that run inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a frame that reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ridgecast/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove what ``materialize`` wrote for ``tables``, which nothing will read again."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
