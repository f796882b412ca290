"""What the corpus operators share: the packed row, the bounded join, the text key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasarlens.session import stage

__all__ = ["ASCII_SPACE", "WORD", "ascii_lower", "attach", "lean_batches", "packed", "stage", "words_in"]

# White space is space and the controls from tab to carriage return, nothing else.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Tables up to this many narrow rows may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
# Rows that a Python worker gets at a time.
PYTHON_ROWS = 1_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def lean_batches(docs: DataFrame) -> DataFrame:
    """``docs``; its session hands rows to Python workers in batches of ``PYTHON_ROWS`` from now on.

    Whole texts are long, and the default batch of 10,000 of them fills a worker.  The setting stays,
    as results are computed later, and is the same for all operators, so that they share the workers.
    """
    conf = docs.sparkSession.conf
    now = int(conf.get(ARROW_ROWS))
    if now <= 0 or now > PYTHON_ROWS:
        conf.set(ARROW_ROWS, PYTHON_ROWS)
    return docs


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``doc``, so that no column an operator adds can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))


def attach(rows: DataFrame, table: DataFrame, on: Column, count: int, how: str = "left") -> DataFrame:
    """Join a stored table of ``count`` rows: broadcast within the bound, else left to the optimiser."""
    return rows.join(F.broadcast(table) if count <= BROADCAST_ROWS else table, on, how)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` also folds other alphabets)."""
    ascii_only = F.octet_length(text) == F.length(text)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, lower))


def words_in(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
