"""Independent jobs of one session at the same time, and results that outlive them.

``at_once`` runs jobs in threads of their own, each in a scheduler pool of its own, so that many
small trainings share the executors.  ``finished`` keeps what a job has made under the shared
folder, by a key of its input rows, its parameters and the code: a job that is asked for again is
read back, and a run that was stopped goes on with what it has not finished.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.session import shared_folder

T = TypeVar("T")
# Jobs of one call that run at the same time; Spark's scheduler shares the cores among them.
WORKERS = 12
POOL = "spark.scheduler.pool"
_locks: dict[str, threading.Lock] = {}
_guard = threading.Lock()


def at_once(spark: SparkSession, jobs: Mapping[str, Callable[[], T]], workers: int = WORKERS) -> dict[str, T]:
    """The results of all jobs by name.  If some fail, the others are still run to their end."""

    def one(name: str, job: Callable[[], T]) -> T:
        spark.sparkContext.setLocalProperty(POOL, name)
        try:
            return job()
        finally:
            spark.sparkContext.setLocalProperty(POOL, None)

    with ThreadPoolExecutor(max(1, min(workers, len(jobs)))) as pool:
        started = {name: pool.submit(inheritable_thread_target(spark)(one), name, job) for name, job in jobs.items()}
    return {name: future.result() for name, future in started.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def content_key(df: DataFrame) -> str:
    """The columns and a digest of the rows, whatever their order; one narrow pass."""
    digest = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), *df.columns)).alias("b"),
    ).first()
    return f"{df.schema.simpleString()}/{digest['n']}/{digest['a']}/{digest['b']}"


@cache
def code_key() -> str:
    """A digest of this package's code, so that results of older code are not read back."""
    digest = hashlib.md5()
    for part in ("functions", "models", "operators", "plans"):
        for file in sorted((Path(__file__).parents[1] / part).glob("*.py")):
            digest.update(file.read_bytes())
    return digest.hexdigest()


def work_path(spark: SparkSession, name: str, inputs: Sequence[DataFrame], params: object) -> str:
    """Where the results of a job are kept."""
    told = json.dumps([code_key(), [content_key(df) for df in inputs], repr(params)])
    return f"{shared_folder(spark).rstrip('/')}/trained/{name}-{hashlib.md5(told.encode()).hexdigest()}"


def finished(
    spark: SparkSession, path: str, make: Callable[[], T], save: Callable[[T, str], None], load: Callable[[str], T]
) -> T:
    """What ``make`` gives, read back from ``path`` if it is there in whole.

    A mark is written last, so a half-written result is made again.  Threads that ask for the same
    result wait for the first of them.
    """
    with _guard:
        lock = _locks.setdefault(path, threading.Lock())
    with lock:
        mark = f"{path}/finished"
        if not path_exists(spark, mark):
            save(make(), path)
            spark.range(0).coalesce(1).write.mode("overwrite").json(mark)
        return load(path)
