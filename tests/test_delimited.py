from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchline.sources.delimited import Field, load_delimited, parse_failures, read_text, write_delimited
from touchline.sources.layouts import ATTENDU, EQUIPE

BOM = "\ufeff"


def _write(path, text: str):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_bom_accented_header_and_empty_fields(spark, tmp_path):
    f = _write(tmp_path / "equipe.csv", BOM + "ID Equipe;Équipe\n1;Angers\n2;\n3;Saint-Étienne\n")
    rows = {r.id_equipe: r.nom_equipe for r in load_delimited(spark, f, EQUIPE).collect()}
    assert rows == {1: "Angers", 2: None, 3: "Saint-Étienne"}


def test_decimal_comma_and_dropped_total(spark, tmp_path):
    f = _write(tmp_path / "attendu.csv", BOM + "ID;xG;npxG;xAG;npxG+xAG\n420;1;1;0,1;9,9\n7; 0,5 ;;0,25;\n")
    rows = {r.id_joueur: r for r in load_delimited(spark, f, ATTENDU).collect()}
    assert rows[420].xag == Decimal("0.10") and "npxg_xag" not in rows[420].asDict()
    assert rows[7].xg == Decimal("0.50") and rows[7].npxg is None
    assert rows[7].xag == Decimal("0.25")  # 0.25 kept at scale 2


@pytest.mark.parametrize("bad", ["abc", "12345,678"])
def test_bad_value_aborts_the_load(spark, tmp_path, bad):
    f = _write(tmp_path / "a.csv", f"ID;xG;npxG;xAG;npxG+xAG\n1;{bad};1;1;1\n")
    with pytest.raises(Exception):
        load_delimited(spark, f, ATTENDU).collect()


def test_permissive_load_counts_failures(spark, tmp_path):
    f = _write(tmp_path / "a.csv", "ID;xG;npxG;xAG;npxG+xAG\n1;abc;1;1;1\n2;12345,678;0,5;;\n")
    loaded = load_delimited(spark, f, ATTENDU, permissive=True)
    assert loaded.filter("xg is null").count() == 2
    fails = {r.column_name: r.failures for r in parse_failures(read_text(spark, f, ATTENDU), ATTENDU).collect()}
    assert fails["xg"] == 2 and fails["npxg"] == 0 and fails["xag"] == 0


def test_write_then_load_round_trip(spark, tmp_path):
    layout = [Field("ID", "id", "bigint"), Field("Nom", "name"), Field("Val", "v", "decimal(6,2)", decimal_comma=True)]
    df = spark.createDataFrame([(1, "Zoé", Decimal("0.50")), (2, None, None)], "id long, name string, v decimal(6,2)")
    out = str(tmp_path / "out")
    write_delimited(df, out, layout)
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part-*.csv"))
    assert "0,50" in text and text.startswith(BOM + "ID;Nom;Val")
    back = sorted(tuple(r) for r in load_delimited(spark, out, layout).collect())
    assert back == [(1, "Zoé", Decimal("0.50")), (2, None, None)]


def test_comma_separated_variant(spark, tmp_path):
    layout = [Field("id", "id", "int"), Field("team", "team")]
    f = _write(tmp_path / "c.csv", "id,team\n1,Lens\n2,\n")
    rows = sorted(tuple(r) for r in load_delimited(spark, f, layout, sep=",").collect())
    assert rows == [(1, "Lens"), (2, None)]


def test_export_all_writes_each_result(spark, smoke_dir, tmp_path):
    from touchline.export import export_all

    paths = export_all(spark, smoke_dir, str(tmp_path / "out"), ["q01", "c00"])
    back = spark.read.option("sep", ";").option("header", True).csv(paths["q01"])
    assert back.count() == 25 and set(back.columns) == {"nom_equipe", "total_buts"}
    assert spark.read.option("sep", ";").option("header", True).csv(paths["c00"]).count() == 2


PERF = [Field("ID", "id", "int"), Field("a", "a", "int"), Field("b", None), Field("c", "c")]


@pytest.mark.parametrize("line", ["1;2", "1;2;x", "1;2;x;y;z", "1;2;x;y;"])
def test_short_and_long_lines_abort(spark, tmp_path, line):
    f = _write(tmp_path / "p.csv", f"ID;a;b;c\n0;1;x;y\n{line}\n")
    with pytest.raises(Exception):
        load_delimited(spark, f, PERF).collect()


def test_quotes_backslashes_and_blanks(spark, tmp_path):
    layout = [Field("id", "id", "int"), Field("t", "t")]
    f = _write(tmp_path / "q.csv", 'id;t\n1;"a ""b"" c"\n2;"bs\\"\n3;  pad \n4;"x;y"\n')
    rows = {r.id: r.t for r in load_delimited(spark, f, layout).collect()}
    assert rows == {1: 'a "b" c', 2: "bs\\", 3: "  pad ", 4: "x;y"}


def test_line_breaks_in_quotes_need_multi_line(spark, tmp_path):
    layout = [Field("id", "id", "int"), Field("t", "t")]
    f = _write(tmp_path / "m.csv", 'id;t\n1;"two\nlines"\n2;z\n')
    assert {r.id: r.t for r in load_delimited(spark, f, layout, multi_line=True).collect()} == {1: "two\nlines", 2: "z"}
    with pytest.raises(Exception):
        load_delimited(spark, f, layout).collect()


def test_write_keeps_every_character(spark, tmp_path):
    layout = [Field("id", "id", "int"), Field("t", "t")]
    values = ["  pad ", 'say "x"', "back\\slash\\", "a;b", "two\nlines", "", None, '"', "é"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    out = str(tmp_path / "out")
    write_delimited(df, out, layout)
    back = {r.id: r.t for r in load_delimited(spark, out, layout, multi_line=True).collect()}
    assert [back[i] or None for i in range(len(values))] == [v or None for v in values]


@pytest.mark.parametrize("name, line", [("progression", "1;2;12,5;3"), ("salaire_source", "1;x;30;12,5;n")])
def test_direct_copy_columns_refuse_decimal_commas(spark, tmp_path, name, line):
    from touchline.sources.layouts import LAYOUTS

    f = _write(tmp_path / "d.csv", "h" + ";h" * (len(LAYOUTS[name]) - 1) + "\n" + line + "\n")
    with pytest.raises(Exception):
        load_delimited(spark, f, LAYOUTS[name]).collect()


def test_keys_follow_the_lines_of_split_files(spark, tmp_path):
    """Several files, several splits a file and several splits a task: the key is the line's place, without a sort or shuffle of the rows."""
    from touchline.sources.delimited import load_numbered

    fields = [Field("id", "id", "bigint"), Field("text", "text")]
    lines = [(k, "x" * (k * 7 % 90)) for k in range(9000)]
    for i, (lo, hi) in enumerate([(0, 5000), (5000, 5001), (5001, 5001), (5001, 9000)]):
        (tmp_path / f"part-{i}.csv").write_text("id;text\n" + "".join(f"{k};{t}\n" for k, t in lines[lo:hi]))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for most in ("20000", "70000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            rows = load_numbered(spark, str(tmp_path), fields, "key", start=10)
            got = {r.id: r.key for r in rows.collect()}
            assert got == {k: k + 10 for k in range(9000)}
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
        assert load_numbered(spark, str(tmp_path), fields, "key").filter("id = 5000").first().key == 5001  # a filter moves no key
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_load_counts_its_failures_in_the_same_scan(spark, tmp_path):
    from touchline.sources.delimited import load_counted

    fields = [Field("id", "id", "bigint"), Field("x", "x", "decimal(6,2)", decimal_comma=True), Field("note", "note"), Field("y", "y", "int")]
    (tmp_path / "f.csv").write_text("id;x;note;y\n1;1,5;a;2\n2;n/a;b;\n3;;c;zz\nx;2,25;;9999999999\n")
    rows, seen = load_counted(spark, str(tmp_path / "f.csv"), fields)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    loaded = sorted(map(tuple, rows.collect()), key=str)
    assert seen.get == {"__rows": 4, "id": 1, "x": 1, "y": 2}
    assert [(r[0], str(r[1]), r[3]) for r in loaded if r[0]] == [(1, "1.50", 2), (2, "None", None), (3, "None", None)]


def test_an_export_reads_back_in_its_order(spark, tmp_path):
    from touchline.sources.delimited import read_ordered, write_ordered

    fields = [Field("id", "id", "bigint"), Field("name", "name")]
    df = spark.range(3000).select("id", F.concat(F.lit("n"), (F.col("id") * 7919 % 3001).cast("string")).alias("name")).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ordered(df, str(tmp_path / "out"), fields, [F.col("name").desc()])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    got = [r.name for r in read_ordered(spark, str(tmp_path / "out"), fields).collect()]
    assert got == sorted(got, reverse=True) and len(got) == 3000
