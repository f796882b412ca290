"""Recommendation lists in hash buckets: a batch of requests opens the files of its users' buckets only.

Every put and every compaction is a run: a folder ``items/<run>/bucket=<b>`` with one item per user,
sorted by user, and a small table ``manifest/<run>`` that names its buckets.  A run counts from when
its manifest is written, so a put that was stopped half-way is not seen and may be repeated.  A
compaction merges the runs of those buckets that have many and leaves all other buckets alone; readers
go on with the runs they have listed until ``drop_replaced`` removes what nobody needs any more.

A store has one writer at a time; batches come in rising order, as those of a stream do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.plans.jobs import path_exists
from pasarlens.sources.recs_store import last_per_user

BUCKETS = 256
# A bucket with so many runs is merged by ``compact``.
RUNS = 4
ITEM = ["user_id", "recommendations", "timestamp"]
MANIFEST = "batch long, base boolean, buckets int, bucket int, n_items long, folder string"


def bucket_of(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """All buckets of all runs that were ever finished."""
    if not path_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/*")


def live_runs(spark: SparkSession, path: str) -> DataFrame:
    """Per bucket the last compaction and the puts after it, with the number of ``runs``."""
    listed = manifest(spark, path)
    newest = listed.where("base").groupBy("bucket").agg(F.max("batch").alias("_upto"))
    after = F.col("batch") > F.coalesce("_upto", F.lit(-1).cast("long"))
    live = listed.join(newest, "bucket", "left").where((F.col("base") & (F.col("batch") == F.col("_upto"))) | (~F.col("base") & after)).drop("_upto")
    return live.join(live.groupBy("bucket").agg(F.count(F.lit(1)).alias("runs")), "bucket")


def _write_run(items: DataFrame, path: str, run: str, batch: int, base: bool, buckets: int) -> None:
    """``items`` (user_id, recommendations, timestamp, batch), one per user, as a run."""
    spark, folder = items.sparkSession, f"{path}/items/{run}"
    dealt = items.withColumn("bucket", bucket_of(F.col("user_id"), buckets)).repartition("bucket").sortWithinPartitions("bucket", "user_id")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    named = spark.read.schema(items.withColumn("bucket", F.lit(0)).schema).parquet(folder).groupBy("bucket").agg(F.count(F.lit(1)).alias("n_items"))
    rows = named.select(
        F.lit(batch).cast("long").alias("batch"), F.lit(base).alias("base"), F.lit(buckets).alias("buckets"), F.col("bucket").cast("int").alias("bucket"),
        "n_items", F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string")).alias("folder"),
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{run}")  # one row per bucket


def put_keyed(items: DataFrame, path: str, batch: int, buckets: int = BUCKETS) -> None:
    """Add a batch of {user_id, recommendations, timestamp}; ids become text.

    The newest item per user of the batch is kept.  A batch that is listed already is not written again.
    ``buckets`` counts for a new store only; choose it so that a bucket is some hundred MB when compacted.
    """
    spark = items.sparkSession
    known = manifest(spark, path).agg(
        F.max("buckets").alias("buckets"), F.max(F.when(F.col("base"), F.col("batch"))).alias("upto"), F.bool_or((F.col("batch") == batch) & ~F.col("base")).alias("listed")
    ).first()
    if known["listed"]:
        return
    if known["upto"] is not None and batch <= known["upto"]:
        raise ValueError(f"batch {batch} comes after a compaction of batches up to {known['upto']}")
    keyed = items.select(F.col("user_id").cast("string").alias("user_id"), *ITEM[1:], F.lit(batch).cast("long").alias("batch"))
    _write_run(last_per_user(keyed), path, f"put-{batch}", batch, False, known["buckets"] or buckets)


def _items(spark: SparkSession, runs: DataFrame) -> DataFrame | None:
    """The stored items of the listed buckets; nothing if none is listed."""
    folders = sorted(r["folder"] for r in runs.select("folder").collect())  # buckets times live runs
    return spark.read.parquet(*folders).select(*ITEM, "batch") if folders else None


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The item of every user.  A store without items raises ``ValueError``, as it has no schema yet."""
    found = _items(spark, live_runs(spark, path))
    if found is None:
        raise ValueError(f"no items in {path}")
    return last_per_user(found).select(*ITEM)


def look_up(spark: SparkSession, path: str, users: DataFrame) -> DataFrame:
    """The items of those of ``users`` (user_id) that the store knows, each once.

    Only the folders of the users' buckets are opened.  A null id finds nothing.
    """
    asked = users.select(F.col("user_id").cast("string").alias("user_id")).where("user_id is not null").distinct()
    runs = live_runs(spark, path)
    buckets = runs.agg(F.max("buckets")).first()[0]
    if buckets is None:
        raise ValueError(f"no items in {path}")
    wanted = asked.select(bucket_of(F.col("user_id"), buckets).alias("bucket")).distinct()
    found = _items(spark, runs.join(wanted, "bucket", "left_semi"))
    if found is None:  # buckets that were never written: any folder tells the schema
        found = spark.read.parquet(runs.select("folder").first()[0]).select(*ITEM, "batch")
    return last_per_user(found.join(asked, "user_id", "left_semi")).select(*ITEM)


def compact(spark: SparkSession, path: str, runs: int = RUNS) -> int:
    """Merge the runs of every bucket that has ``runs`` or more of them; the number of such buckets."""
    many = live_runs(spark, path).where(F.col("runs") >= max(runs, 2))
    about = many.agg(F.max("buckets").alias("buckets"), F.countDistinct("bucket").alias("n")).first()
    if not about["n"]:
        return 0
    upto = manifest(spark, path).agg(F.max("batch")).first()[0]
    merged = last_per_user(_items(spark, many)).withColumn("batch", F.lit(upto).cast("long"))
    _write_run(merged, path, f"base-{upto}-{uuid.uuid4().hex}", upto, True, about["buckets"])
    return about["n"]


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the buckets that a compaction has replaced; call it when no reader uses them any more."""
    gone = manifest(spark, path).select("folder").join(live_runs(spark, path).select("folder"), "folder", "left_anti")
    conf, deleted = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for row in gone.toLocalIterator():  # names only
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(row["folder"])
        deleted += bool(at.getFileSystem(conf).delete(at, True))
    return deleted
