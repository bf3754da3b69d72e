"""Files with quoted line breaks, read by many tasks as by one."""

import random

import pytest

from touchline.sources.delimited import Field, load_delimited
from touchline.sources.quoted import read_records

FIELDS = [Field("id", "id", "bigint"), Field("note", "note"), Field("n", "n", "int")]


def _cell(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ';"\n\r') else text


def _rows(n: int, seed: int):
    rng = random.Random(seed)
    parts = ["a", "b c", "\n", "\n\n", '"', '""', ";", "é", "x" * 30, "\\", " "]
    long = "first\n" + "".join(f'line {k} "quoted"; more\n' for k in range(300)) + "last"  # spans many splits
    return [(i, long if i in (40, 41) else "z" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) + "z", i % 5) for i in range(n)]


def _write(path, rows, bom: bool, crlf: bool = False):
    end = "\r\n" if crlf else "\n"
    body = "id;note;n" + end + "".join(f"{i};{_cell(t)};{n}{end}" for i, t, n in rows)
    path.write_bytes((("\ufeff" if bom else "") + body).encode())


@pytest.mark.parametrize("most", ["700", "3000", "128m"])
def test_many_tasks_read_what_one_task_reads(spark, tmp_path, most):
    rows = _rows(600, 3)
    folder = tmp_path / "files"
    folder.mkdir()
    _write(folder / "a.csv", rows[:250], True)
    _write(folder / "b.csv", rows[250:251], False)
    _write(folder / "c.csv", [], False)
    _write(folder / "d.csv", rows[251:], False)
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        frame = load_delimited(spark, str(folder), FIELDS, multi_line="split")
        got = sorted(map(tuple, frame.collect()))
        tasks = spark.read.text(str(folder)).rdd.getNumPartitions()
        assert tasks > 20 if most == "700" else tasks >= 1
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Sort [" not in plan
        assert got == sorted(rows)
        assert got == sorted(map(tuple, load_delimited(spark, str(folder), FIELDS, multi_line=True).collect()))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_line_ends_and_empty_lines(spark, tmp_path):
    _write(tmp_path / "w.csv", [(1, "one", 1), (2, "two; three", 2)], True, crlf=True)
    assert sorted(map(tuple, load_delimited(spark, str(tmp_path / "w.csv"), FIELDS, multi_line="split").collect())) == [(1, "one", 1), (2, "two; three", 2)]
    (tmp_path / "e.csv").write_text("id;note;n\n\n3;;\n\n")
    assert [tuple(r) for r in load_delimited(spark, str(tmp_path / "e.csv"), FIELDS, multi_line="split").collect()] == [(3, None, None)]
    (tmp_path / "h.csv").write_text('"id\nof";note;n\n5;x;1\n')
    assert [r.record for r in read_records(spark, str(tmp_path / "h.csv")).collect()] == ["5;x;1"]
    assert read_records(spark, str(tmp_path / "h.csv"), header=False).count() == 2


def test_a_record_of_another_width_aborts(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id;note;n\n1;x;2;3\n")
    with pytest.raises(Exception):
        load_delimited(spark, str(tmp_path / "bad.csv"), FIELDS, multi_line="split").collect()
