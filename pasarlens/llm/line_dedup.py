"""Line deduplication over levelled sorted runs of line hashes.

The index is a folder of runs: tables of (h1, h2, n, keeper), bucketed and sorted by the 128-bit
hash of a line's key, with the number of documents that hold the line and the largest of their
ids, and a catalogue of the levels.  A batch of lines is summed up by hash, dealt into the same
buckets, and merge-anti-joined with what the runs have settled already (enough documents, and a keeper
that the batch does not surpass); the rest becomes a new run of level 0.  When a level has ``fanout``
runs, they are merged, bucket by bucket, into one run of the next.  A frequent line is therefore
stored a few times only, however many batches hold it, and the runs are never shuffled again.

The index outlives the session: a later call opens the folder and adds its own batches.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pasarlens.llm.common import ASCII_SPACE, ascii_lower, packed, stage
from pasarlens.plans.jobs import path_exists
from pasarlens.session import staging_path

KEY = ["h1", "h2"]
CATALOGUE = "version int, body string"


class LineRuns:
    """The runs of one index.  Entries have the columns ``h1, h2, n, keeper``."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = 5, fanout: int = 3):
        self.spark, self.path, self.min_docs, self.fanout = spark, path, min_docs, fanout
        self.version, self.tables = 0, []
        self.levels: dict[int, list[tuple[str, DataFrame]]] = defaultdict(list)
        # as many buckets as a shuffle of this session has partitions, so that a batch falls into them by its own sum
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        if path_exists(spark, f"{path}/catalogue"):
            last = spark.read.schema(CATALOGUE).json(f"{path}/catalogue/*").orderBy(F.desc("version")).first()
            told = json.loads(last["body"])
            self.version, self.buckets, self.min_docs, self.fanout = last["version"], told["buckets"], told["min_docs"], told["fanout"]
            for level, names in told["levels"].items():
                self.levels[int(level)] = [(n, self._opened(n)) for n in names]

    def _opened(self, name: str) -> DataFrame:
        """A run as a bucketed table: the bucket of a file is in its name, the catalogue of Spark has to be told their number."""
        table = f"line_run_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {table} (h1 BIGINT, h2 BIGINT, n BIGINT, keeper BIGINT) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'"
        )
        self.tables.append(table)
        return self.spark.table(table)

    def _written(self, entries: DataFrame) -> tuple[str, DataFrame]:
        name, table = f"run-{uuid.uuid4().hex}", f"line_run_{uuid.uuid4().hex}"
        rows = entries.select(*KEY, F.col("n").cast("long").alias("n"), F.col("keeper").cast("long").alias("keeper"))
        rows.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.path}/{name}").saveAsTable(table)
        self.tables.append(table)
        return name, self.spark.table(table)

    def close(self) -> None:
        """Forget the names of the tables; the index stays in its folder."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []

    def runs(self) -> list[DataFrame]:
        return [run for level in sorted(self.levels) for _, run in self.levels[level]]

    def news(self, entries: DataFrame) -> DataFrame:
        """What of a batch the runs have not settled."""
        fresh = entries
        for run in self.runs():
            done = run.where(F.col("n") >= self.min_docs).select(
                *[F.col(k).alias(f"r{k}") for k in KEY], F.col("keeper").alias("settled")
            )
            same = (F.col("h1") == F.col("rh1")) & (F.col("h2") == F.col("rh2"))
            no_news = F.col("keeper").isNull() | (F.col("keeper") <= F.col("settled"))
            fresh = fresh.join(done.hint("merge"), same & no_news, "left_anti")
        return fresh

    def add(self, entries: DataFrame) -> None:
        """Add a batch.  Batches may come in any order; descending ids settle lines earliest."""
        self.levels[0].append(self._written(self.news(entries)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._written(self._merged([run for _, run in self.levels.pop(level)]))
            level += 1
            self.levels[level].append(merged)
        self.version += 1
        told = {
            "buckets": self.buckets, "min_docs": self.min_docs, "fanout": self.fanout,
            "levels": {level: [name for name, _ in runs] for level, runs in self.levels.items()},
        }
        line = self.spark.createDataFrame([(self.version, json.dumps(told))], CATALOGUE)
        line.coalesce(1).write.mode("overwrite").json(f"{self.path}/catalogue/{self.version:09d}")

    def merged(self) -> DataFrame | None:
        runs = self.runs()
        return self._merged(runs) if runs else None

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """Sorted runs merged by their keys; ``n`` and ``keeper`` of equal keys are put together."""

        def both(left: DataFrame, right: DataFrame) -> DataFrame:
            other = right.select(*KEY, F.col("n").alias("m"), F.col("keeper").alias("last"))
            n = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            return left.join(other.hint("merge"), KEY, "full").select(*KEY, n.alias("n"), F.greatest("keeper", "last").alias("keeper"))

        return reduce(both, runs)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, th, pos, h1, h2`` of every line whose key is long enough; stored."""
    line = F.col("line")
    key = ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))
    return stage(
        docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(lines_of(docs["text"])).alias("pos", "line"))
        .where(F.length(line) >= min_chars)
        .select("doc_id", "th", "pos", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")),
        "lines",
    )


def add_lines(index: LineRuns, lines: DataFrame, batches: int) -> None:
    """Add the lines of documents (see ``long_lines``) that the index has not seen, in ranges of their ids."""
    low, high = lines.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    width = max(1, -(-(high - low + 1) // batches))
    for batch in reversed(range(batches)):
        start = low + batch * width
        own = (F.col("doc_id") >= start) & (F.col("doc_id") < start + width)
        rows = lines.where(own | F.col("doc_id").isNull() if batch == 0 else own)
        # rows equal in id and text are one document; the first sum keeps a frequent line apart by document
        index.add(
            rows.groupBy(*KEY, "doc_id", "th").agg(F.lit(1).alias("one"))
            .groupBy(*KEY).agg(F.count("one").alias("n"), F.max("doc_id").alias("keeper"))
        )


def repeated_lines(index: LineRuns) -> DataFrame:
    """Stored ``h1, h2, n, keeper`` of the lines in at least ``min_docs`` documents."""
    return stage(index.merged().where(F.col("n") >= index.min_docs), "repeated")


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3, index: str | None = None
) -> DataFrame:
    """Drop repeated lines: ``doc, n_lines, n_dropped, kept`` for every row of ``docs``.

    A line's key is the line without white space at its ends, A-Z lower-cased.  Keys of
    ``min_chars`` code points or more in at least ``min_docs`` documents lose their lines in all
    documents but the one with the largest ``doc_id``, where all of them stay.  Rows with the
    same ``doc_id`` and text are one document and fare alike; documents that share the largest
    id all keep the line.  A null id counts as a document below all others, a null text as an
    empty one, which is one empty line.  The other lines are joined by a line break again, so a
    document that loses every line becomes empty but stays.  An empty table stays empty.
    ``doc`` is the row with all its columns.

    ``index`` names a folder whose index goes on from call to call: lines are then counted over the
    documents of all calls, which must not be given twice.
    """
    lines = long_lines(docs, min_chars)
    runs = LineRuns(docs.sparkSession, index or staging_path(docs.sparkSession, "line-index"), min_docs, fanout)
    add_lines(runs, lines, batches)
    repeated = repeated_lines(runs)
    runs.close()
    return without_lines(docs, lines, repeated)


def without_lines(docs: DataFrame, lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """``doc, n_lines, n_dropped, kept``: the documents without the repeated ones of their ``lines``."""
    lost = F.col("doc_id").isNull() & F.col("keeper").isNotNull() | (F.col("doc_id") < F.col("keeper"))
    # a very frequent line has many rows here; adaptive execution splits them, the other side is unique
    drops = (
        lines.join(repeated, KEY)
        .where(lost)
        .groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
        .agg(F.collect_set("pos").alias("_drops"))
    )
    same = F.col("doc.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col("doc.text")) == F.col("_th"))
    joined = packed(docs).join(drops, same, "left")
    lines_now = lines_of(F.col("doc.text"))
    positions = F.sequence(F.lit(0), F.size(lines_now) - 1)
    kept = F.array_join(
        F.transform(F.array_except(positions, F.col("_drops")), lambda i: F.get(F.col("_lines"), i)), "\n"
    )
    whole = F.coalesce(F.col("doc.text"), F.lit(""))
    return joined.withColumn("_lines", lines_now).select(
        "doc",
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_drops").isNull(), whole).otherwise(kept).alias("kept"),
    )
