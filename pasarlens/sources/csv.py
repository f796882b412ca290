"""Multi-part CSV input."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string


def _options(spark: SparkSession, path: str):
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader if path.endswith(".csv") else reader.option("pathGlobFilter", "*.csv")


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names of their first line; one small row per file reaches the driver."""
    reader = spark.read if path.endswith(".csv") else spark.read.option("pathGlobFilter", "*.csv")
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    firsts = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("first")).collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(firsts, key=lambda r: r["file"]):
        names = next(csv.reader([row["first"].lstrip("﻿")]))
        found.setdefault(tuple(n.strip() for n in names), []).append(row["file"])
    return found


def read_csv_parts(
    spark: SparkSession, path: str, schema: StructType | str, nrows: int | None = None
) -> DataFrame:
    """All ``*.csv`` files under a folder as one table; ``path`` may also be a single file.

    Columns are found by their names in each part's header, in any order; a part without a
    column gives nulls, and columns that are not in ``schema`` are left out.  Quoted values may
    hold commas, doubled quotes and line breaks, so a part is read by one task: write large
    inputs in several parts.  ``nrows`` is a total cap over the parts in name order.
    """
    wanted = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in wanted}
    tables = []
    for names, files in headers(spark, path).items():
        own = StructType([StructField(n, kinds.get(n, StringType())) for n in names])
        read = _options(spark, path).schema(own).csv(files)
        columns = [
            (F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted
        ]
        tables.append(read.select(*columns, F.col("_metadata.file_path").alias("_file")))
    if not tables:
        return spark.createDataFrame([], wanted)
    rows = reduce(DataFrame.unionByName, tables)
    if nrows is None:
        return rows.drop("_file")
    # a part is one task's, so its rows have rising numbers; only one line per part is collected
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    parts = numbered.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).orderBy("_file")
    left, kept = nrows, F.lit(False)
    for part in parts.collect():
        if left < part["n"]:
            kept = (F.col("_file") < part["_file"]) | (F.col("_file") == part["_file"]) & (F.col("_at") < part["first"] + left)
            break
        left -= part["n"]
    else:
        kept = F.lit(True)
    return numbered.where(kept).drop("_file", "_at")
