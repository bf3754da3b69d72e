"""Delimited files with line breaks inside quoted fields, read by many tasks.

A reader that starts in the middle of such a file cannot tell whether a line
break ends a record or lies in a field.  Two passes can:

1. **Parity.**  Every split counts the quotes of its lines (one aggregation, a row a
   split).  Quotes are doubled inside fields, so a split starts inside a field
   exactly if the splits of its file before it hold an odd number of quotes.
2. **Records.**  Every split streams through its lines from that state: lines up to
   an even number of quotes are a record.  What is left at either end (the rest of a
   record that began earlier, the start of one that ends later) are fragments, two
   a split at most; they are put together by file and place.

The lines themselves are never shuffled or sorted; only counts and fragments, a
few rows a split, are.  A single record may span any number of splits.  Files must
quote as this library writes them: a field with a quote, separator or line break is
quoted, quotes are doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOM = "﻿"
#: A whole record; the end of one begun in an earlier split; the start of one that goes on; a split inside one.
WHOLE, ENDS, BEGINS, INSIDE = 0, 1, 2, 3
RECORDS = "file string, at long, kind int, head boolean, record string"
RECORDS_ARROW = pa.schema([("file", pa.string()), ("at", pa.int64()), ("kind", pa.int32()), ("head", pa.bool_()), ("record", pa.string())])


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every line with the split it was read in."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")


def _starts(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """Of each split (file, place), whether it starts inside a field: one row a split."""
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    odd = lines.groupBy("file", "at").agg((quotes % 2).alias("odd"))
    before = F.sum("odd").over(Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    rows = odd.select("file", "at", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside")).collect()
    return {(r["file"], r["at"]): r["inside"] for r in rows}


def _records(starts):
    """Streams through the lines of a task's splits: whole records, and the fragments at either end of a split."""

    def run(batches):
        now, open_lines, inside, first, rows = None, [], False, False, []

        def close() -> None:
            """The end of a split: what is still open goes on in the next."""
            if now is not None and (inside or open_lines):
                whole = bool(open_lines) and not started
                rows.append((*now, INSIDE if whole else BEGINS, first and not whole, "\n".join(open_lines)))

        started = False  # the open record began in this split
        for batch in batches:
            for file, at, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (file, at) != now:
                    close()
                    now, open_lines, first = (file, at), [], at == 0
                    inside, started = starts.value[file, at], False
                    if first and line.startswith(BOM):
                        line = line[1:]
                if not open_lines and not inside:
                    started = True
                open_lines.append(line)
                inside ^= line.count('"') % 2 == 1
                if not inside:
                    rows.append((*now, WHOLE if started else ENDS, first and started, "\n".join(open_lines)))
                    first, open_lines, started = False, [], False
            if len(rows) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORDS_ARROW, strict=True)], schema=RECORDS_ARROW)
                rows = []
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORDS_ARROW, strict=True)], schema=RECORDS_ARROW)

    return run


def read_records(spark: SparkSession, path: str | Sequence[str], header: bool = True) -> DataFrame:
    """The records of the files, one a row (column ``record``), without headers and empty lines."""
    lines = _lines(spark, path)
    starts = spark.sparkContext.broadcast(_starts(lines))
    rows = lines.mapInArrow(_records(starts), RECORDS)
    # fragments: a record begins where kind is BEGINS, and takes what follows it in its file up to its end
    parts = rows.filter(F.col("kind") != WHOLE)
    number = F.sum((F.col("kind") == BEGINS).cast("int")).over(Window.partitionBy("file").orderBy("at", F.when(F.col("kind") == ENDS, 0).otherwise(1)))
    parts = parts.withColumn("number", number)
    place = F.struct("at", F.when(F.col("kind") == BEGINS, 1).otherwise(0).alias("last"), "record")
    joined = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list(place)).alias("p"), F.max("head").alias("head"))
    joined = joined.select("head", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    every = rows.filter(F.col("kind") == WHOLE).select("head", "record").unionByName(joined)
    every = every.filter(~F.col("head")) if header else every
    return every.select(F.regexp_replace("record", r"\r$", "").alias("record")).filter("record <> ''")


def read_quoted(spark: SparkSession, path: str | Sequence[str], width: int, sep: str = ";", header: bool = True) -> DataFrame:
    """All columns as strings (``_c0``, ...), bound by position; empty field -> NULL; malformed record -> error."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "FAILFAST"}
    return read_records(spark, path, header).select(F.from_csv("record", schema, options).alias("r")).select("r.*")
