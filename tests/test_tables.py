"""Versioned reload: all tables of a load are published in one step."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from touchline.sources import tables as sink
from touchline.sources.tables import current_tables, reload_tables, versions

NAMES = [f"t{i}" for i in range(8)]


def _load(spark, mark: int, broken: str | None = None):
    out = {n: spark.range(10 + i).select("id", F.lit(mark).alias("mark")) for i, n in enumerate(NAMES)}
    if broken:
        out[broken] = out[broken].select("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.lit(mark)).alias("mark"))
    return out


def _marks(tables):
    return {n: (t.count(), t.agg(F.max("mark")).first()[0]) for n, t in tables.items()}


def test_a_failed_load_keeps_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "season")
    with pytest.raises(FileNotFoundError):
        current_tables(spark, root)
    reload_tables(_load(spark, 1), root, NAMES)
    want = {n: (10 + i, 1) for i, n in enumerate(NAMES)}
    assert _marks(current_tables(spark, root)) == want
    with pytest.raises(Exception, match="broken"):
        reload_tables(_load(spark, 2, broken="t4"), root, NAMES)
    assert _marks(current_tables(spark, root)) == want  # all eight, as before
    assert len(versions(spark, root)) == 1 and len([d for d in os.listdir(root) if d.startswith("version-")]) == 1
    reload_tables(_load(spark, 3), root, NAMES)
    assert _marks(current_tables(spark, root)) == {n: (10 + i, 3) for i, n in enumerate(NAMES)}


def test_readers_see_whole_loads_only(spark, tmp_path, monkeypatch):
    """Between the first table's write and the switch, readers get the old tables; frames taken before go on reading them."""
    root = str(tmp_path / "season")
    reload_tables(_load(spark, 1), root, NAMES)
    before, seen = current_tables(spark, root), []
    publish = sink._publish

    def late(*args):
        seen.append(_marks(current_tables(spark, root)))  # everything is written, nothing is switched
        publish(*args)

    monkeypatch.setattr(sink, "_publish", late)
    reload_tables(_load(spark, 2), root, NAMES)
    assert {m for _, m in seen[0].values()} == {1}
    assert {m for _, m in _marks(before).values()} == {1} and {m for _, m in _marks(current_tables(spark, root)).values()} == {2}


def test_old_versions_go_and_a_later_load_wins_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "season")
    for k in range(4):
        paths = reload_tables(_load(spark, k), root, NAMES, keep=2)
    assert [n for n, _ in versions(spark, root)] == [3, 4] and len([d for d in os.listdir(root) if d.startswith("version-")]) == 2
    assert list(paths) == NAMES and all(os.path.isdir(p) for p in paths.values())
    publish, gate = sink._publish, threading.Barrier(2)

    def together(*args):
        gate.wait(timeout=60)
        publish(*args)

    monkeypatch.setattr(sink, "_publish", together)
    failed = []

    def load(mark):
        try:
            reload_tables(_load(spark, mark), root, NAMES, keep=9)
        except RuntimeError:
            failed.append(mark)

    both = [threading.Thread(target=load, args=(m,)) for m in (10, 11)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    assert len(failed) <= 1 and {m for _, m in _marks(current_tables(spark, root)).values()} <= {10, 11}
    assert len({m for _, m in _marks(current_tables(spark, root)).values()}) == 1
