"""Table sinks: idempotent reload of a table set behind one switch, views."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Folder of the manifests under a load's root: one file a published version, named by its number.
MANIFESTS = "_published"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, version folder) of every published load, oldest first."""
    where, system = _files(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
    out = []
    for name in sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_"))):
        text = spark.read.text(f"{root.rstrip('/')}/{MANIFESTS}/{name}", wholetext=True).first()[0]
        out.append((int(name.split(".")[0]), json.loads(text)["folder"]))
    return out


def _publish(spark: SparkSession, root: str, number: int, folder: str, order: Sequence[str]) -> None:
    """Name ``folder`` the current version: the manifest is written aside and renamed, one step for every reader."""
    aside, system = _files(spark, f"{root}/{MANIFESTS}/_{uuid.uuid4().hex}")
    out = system.create(aside, False)
    out.write(bytearray(json.dumps({"folder": folder, "tables": list(order)}).encode()))
    out.close()
    target, _ = _files(spark, f"{root}/{MANIFESTS}/{number:09d}.json")
    if system.exists(target) or not system.rename(aside, target):
        system.delete(aside, False)
        raise RuntimeError(f"another load published version {number} of {root} first")


def reload_tables(
    tables: Mapping[str, DataFrame], root: str, order: Sequence[str], parallel: int = 4, keep: int = 2
) -> dict[str, str]:
    """Write every table to a new version under ``root`` and publish it; return the paths in ``order``.

    TRUNCATE + load as one step: the tables of a load go to a folder of their
    own, and only when all are written does one manifest switch the readers
    (:func:`current_tables`).  A failed load leaves the published version as it
    was and removes its own folder; a reader never meets half of a load.  Of two
    loads at once the later to publish fails.  ``keep`` published versions stay
    (readers may still be in the one before), older folders are removed.  Files
    carry no foreign keys to enforce, so the writes are independent jobs and up
    to ``parallel`` of them are submitted at once.
    """
    from concurrent.futures import ThreadPoolExecutor

    root = root.rstrip("/")
    spark = tables[order[0]].sparkSession
    known = versions(spark, root)
    number = known[-1][0] + 1 if known else 1
    folder = f"version-{number:09d}-{uuid.uuid4().hex[:8]}"
    paths = {name: f"{root}/{folder}/{name}" for name in order}

    def write(name: str) -> None:
        tables[name].write.parquet(paths[name])

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            list(pool.map(write, order))
        _publish(spark, root, number, folder, order)
    except BaseException:
        where, system = _files(spark, f"{root}/{folder}")
        system.delete(where, True)
        raise
    for old, there in known[: max(0, len(known) + 1 - keep)]:
        for path in (f"{root}/{MANIFESTS}/{old:09d}.json", f"{root}/{there}"):
            where, system = _files(spark, path)
            system.delete(where, True)
    return paths


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last published version; a frame keeps reading that version after the next load."""
    root = root.rstrip("/")
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"nothing is published under {root}")
    number, folder = known[-1]
    text = spark.read.text(f"{root}/{MANIFESTS}/{number:09d}.json", wholetext=True).first()[0]
    return read_tables(spark, {name: f"{root}/{folder}/{name}" for name in json.loads(text)["tables"]})


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(p) for name, p in paths.items()}


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Expose every table as a temporary view (``CREATE OR REPLACE VIEW``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
