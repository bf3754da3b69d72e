from decimal import Decimal

from touchline.sources.layouts import TEMPS_DE_JEU
from touchline.streaming import stream_delimited


def _drop(path, name, lines):
    (path / name).write_bytes(("\ufeffID;MJ;Titulaire;Min;convertmatch 90m\n" + "\n".join(lines) + "\n").encode("utf-8"))


def test_stream_loads_each_file_once(spark, tmp_path):
    inbox, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    inbox.mkdir()
    _drop(inbox, "day1.csv", ["1;3;2;250;2,78", "2;1;0;12;0,13"])
    stream_delimited(spark, str(inbox), TEMPS_DE_JEU, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    _drop(inbox, "day2.csv", ["3;5;5;450;5,00"])
    stream_delimited(spark, str(inbox), TEMPS_DE_JEU, out, ckpt).awaitTermination()
    rows = {r.id_joueur: r for r in spark.read.parquet(out).collect()}
    assert sorted(rows) == [1, 2, 3]  # day1 is not loaded twice after the restart
    assert rows[1].matchs_90 == Decimal("2.78") and rows[3].minutes_jouees == 450
