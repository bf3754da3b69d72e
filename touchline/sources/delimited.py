"""Delimited text files: the raw season files as delivered, and exports.

Files are UTF-8 (a byte-order mark may precede the header), ``;``-separated,
with a header line, decimal commas and empty fields meaning NULL.  Columns
are bound by position; a line with more or fewer fields aborts the read.
Quotes are doubled inside quoted fields, a backslash is an ordinary
character, and blanks are kept.  A line break inside a quoted field needs
``multi_line``: True reads each file in one task, ``"split"`` in many
(:mod:`touchline.sources.quoted`).  Rows can be numbered in load order
(:func:`load_numbered`), counted while they load (:func:`load_counted`), and
written so that they read back in order (:func:`write_ordered`).
Loading is two steps, as with a text staging table: every field is read as
a string, then cast to its type.  With ANSI casts (Spark's default) a value
that does not parse aborts the job, like the original typed insert; the
``permissive`` mode turns it into NULL instead so it can be counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.quoted import read_quoted

BOM = "\ufeff"

# Writing keeps every character: blanks, quotes (doubled), backslashes, line breaks.
# An empty string is written quoted, NULL as nothing.
LOSSLESS = {
    "quote": '"', "escape": '"', "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


@dataclass(frozen=True)
class Field:
    """One file column: its header, the target column (``None`` = dropped) and its type."""

    header: str
    column: str | None
    type: str = "string"
    decimal_comma: bool = False


def read_text(
    spark: SparkSession, path: str | Sequence[str], fields: Sequence[Field], sep: str = ";", header: bool = True,
    multi_line: bool | str = False,
) -> DataFrame:
    """All columns as strings, bound by position; empty field -> NULL; malformed line -> error.

    ``multi_line``: line breaks inside quoted fields; True reads a file in one task, ``"split"`` in many.
    """
    if multi_line == "split":
        return read_quoted(spark, path, len(fields), sep, header)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(fields))])
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .option("encoding", "UTF-8")
        .option("columnPruning", False)  # else a query that drops columns skips the width check
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def coerce(raw: Column, field: Field, permissive: bool = False) -> Column:
    """``x::type`` (``REPLACE(x, ',', '.')`` first for decimal commas); casts ignore outer blanks, as the server's do."""
    if field.type == "string":
        return raw
    text = F.replace(raw, F.lit(","), F.lit(".")) if field.decimal_comma else raw
    return text.try_cast(field.type) if permissive else text.cast(field.type)


def typed(text_df: DataFrame, fields: Sequence[Field], permissive: bool = False) -> DataFrame:
    """The typed insert: cast each kept column, drop the others."""
    return text_df.select(
        *[coerce(F.col(f"_c{i}"), f, permissive).alias(f.column) for i, f in enumerate(fields) if f.column]
    )


def load_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[Field],
    sep: str = ";",
    header: bool = True,
    permissive: bool = False,
    multi_line: bool | str = False,
) -> DataFrame:
    """Read a delimited file set into a typed DataFrame (see module doc)."""
    return typed(read_text(spark, path, fields, sep, header, multi_line), fields, permissive)


def load_numbered(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[Field],
    out_col: str,
    start: int = 1,
    sep: str = ";",
    header: bool = True,
    permissive: bool = False,
) -> DataFrame:
    """:func:`load_delimited` with dense keys ``start, start + 1, ...`` in load order (SERIAL of a copy command).

    Load order is file by name, then line by line.  A split of a file is read by one task in order, so a row's key is
    the number of rows in earlier splits plus its place in its own: one count a split (the only rows combined in one
    task) and no sort or shuffle of the rows.  Split files, several splits a task and files of any size number alike.
    """
    split = ["__file", "__at"]
    rows = read_text(spark, path, fields, sep, header).select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__at"),
        F.monotonically_increasing_id().alias("__mid"),
    )
    counts = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("__rows"), F.min("__mid").alias("__first"))
    before = F.sum("__rows").over(Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*split, (F.coalesce(before, F.lit(0)) - F.col("__first") + F.lit(start)).alias("__shift"))
    keyed = rows.join(F.broadcast(offsets), split)  # one row a split: metadata
    return keyed.select(
        (F.col("__mid") + F.col("__shift")).alias(out_col),
        *[coerce(F.col(f"_c{i}"), f, permissive).alias(f.column) for i, f in enumerate(fields) if f.column],
    )


def load_counted(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[Field],
    name: str = "load",
    sep: str = ";",
    header: bool = True,
) -> tuple[DataFrame, Observation]:
    """A permissive load, and what it counts on the way: rows, and per typed column the non-empty fields that did not cast.

    The counts are metrics of the same scan: after the loaded rows are written (or any other full action), ``get`` of
    the observation has them, without a second read.
    """
    text, seen = read_text(spark, path, fields, sep, header), Observation(name)
    checks = [
        F.count_if(F.col(f"_c{i}").isNotNull() & coerce(F.col(f"_c{i}"), f, permissive=True).isNull()).alias(f.column)
        for i, f in enumerate(fields)
        if f.column and f.type != "string"
    ]
    return typed(text.observe(seen, F.count(F.lit(1)).alias("__rows"), *checks), fields, permissive=True), seen


def parse_failures(text_df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Per column, how many non-empty fields would not cast (one scan)."""
    checks = []
    for i, f in enumerate(fields):
        if f.column and f.type != "string":
            raw = F.col(f"_c{i}")
            checks.append(F.count_if(raw.isNotNull() & coerce(raw, f, permissive=True).isNull()).alias(f.column))
    counts = text_df.agg(*checks)
    names = [f.column for f in fields if f.column and f.type != "string"]
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return counts.selectExpr(f"stack({len(names)}, {stack}) as (column_name, failures)")


def _render(c: Column, f: Field) -> Column:
    text = c.cast("string")
    return F.replace(text, F.lit("."), F.lit(",")) if f.decimal_comma else text


def write_delimited(
    df: DataFrame, path: str, fields: Sequence[Field], sep: str = ";", bom: bool = True, mode: str = "overwrite"
) -> None:
    """Write ``df`` in a file layout: header names, decimal commas, empty for NULL.

    ``fields`` whose column is ``None`` are written from an expression
    column of the same position named ``_f<i>`` if ``df`` has it, else
    empty.  Each part file starts with the byte-order mark when ``bom``.
    """
    cols = []
    for i, f in enumerate(fields):
        name = (BOM if bom and i == 0 else "") + f.header
        if f.column and f.column in df.columns:
            cols.append(_render(F.col(f.column), f).alias(name))
        elif f"_f{i}" in df.columns:
            cols.append(_render(F.col(f"_f{i}"), f).alias(name))
        else:
            cols.append(F.lit(None).cast("string").alias(name))
    (
        df.select(*cols)
        .write.mode(mode)
        .option("sep", sep)
        .option("header", True)
        .options(**LOSSLESS)
        .csv(path)
    )


def write_ordered(df: DataFrame, path: str, fields: Sequence[Field], order: Sequence[Column | str], sep: str = ";") -> None:
    """:func:`write_delimited` in the given order: a range of the order a part file, the parts named in order.

    No task holds more than its range; :func:`read_ordered` gives the rows back in order.
    """
    write_delimited(df.orderBy(*order), path, fields, sep, bom=False)


def read_ordered(spark: SparkSession, path: str, fields: Sequence[Field], sep: str = ";", permissive: bool = False) -> DataFrame:
    """The rows of :func:`write_ordered` in their order: sorted by line number over the parts."""
    return load_numbered(spark, path, fields, "__line", sep=sep, permissive=permissive).orderBy("__line").drop("__line")
