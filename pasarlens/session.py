"""Session set-up and staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings the jobs rely on.  Nothing here is sized for one machine: shuffle partition
# counts are an upper bound that adaptive execution merges down.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "Asia/Jakarta",
    "spark.scheduler.mode": "FAIR",
}


def build_session(app: str = "pasarlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one only for a local master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="pasarlens-")
    context.setCheckpointDir(local)
    return local


def staging_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_staging(spark: SparkSession) -> None:
    """Delete this application's staged tables; call it once its results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str, schema: StructType | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    ``schema`` reads it back with types that are stored alike, such as vectors; ``codec`` is the
    compression if it shall not be the session's.

    Cuts the lineage (a lost executor re-reads a file instead of redoing the shuffles
    above it), freezes values such as row positions, and lets later passes prune columns.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema or df.schema).parquet(path)
