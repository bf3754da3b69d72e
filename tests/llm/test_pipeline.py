"""The pipeline stage by stage against brute force; the entry module with and without the subpackage."""

import os
import random
import shutil
import subprocess
import sys
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.fixtures import SCHEMA, brute_bytes, brute_components, invented
from touchline.llm.mixing import mix_report
from touchline.llm.toxicity import score_documents

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, smoke_dir, tmp_path):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "mix_sources", "best_fit_packing"]
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], smoke_dir)
        out.write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    columns = docs.columns
    clean, single, cut, mixed, packed = seen[1:]
    assert all(d.columns == columns for d in (clean, single, cut, mixed))

    told = {r.doc_id: r.predicted for r in score_documents(docs, spark.read.parquet(f"{smoke_dir}/labels.parquet")).collect()}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, p in told.items() if not p)

    rows = [tuple(r) for r in clean.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute_components(rows)})

    rows = [tuple(r) for r in single.collect()]
    want = {d: (n - k, spans) for d, n, k, spans, _ in brute_bytes(rows, span=corpus_pipeline.PASSAGE)}
    got = {r.doc_id: len(r.text.encode()) for r in cut.collect()}
    # either end of a removed span may break a character of up to four bytes, whose rest goes too
    assert got.keys() == want.keys() and all(n - 6 * spans <= got[d] <= n for d, (n, spans) in want.items())

    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert +words == Counter({r.doc_id: r.taken for r in mix_report(cut).collect() if r.taken})

    assert Counter(r.doc_id for r in packed.collect() if r.piece == 0) == Counter(r.doc_id for r in mixed.collect())
    whole = corpus_pipeline.run(spark, smoke_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(*key).collect())) == Counter(map(tuple, packed.select(*key).collect()))


def test_passage_of_51_words_goes(spark, smoke_dir):
    rng = random.Random(7)
    text = lambda k: " ".join("".join(rng.choice("abcdefghiklmnoprstuvz") for _ in range(rng.randint(3, 7))) for _ in range(k))
    passage = text(51)
    assert corpus_pipeline.PASSAGE <= len(passage) < 400
    own = [(f"{text(80)} ", f" {text(80)}") for _ in range(3)]
    rows = [(i, a + passage + b, "en", "src0", 0) for i, (a, b) in enumerate(own)] + [(3, text(300), "en", "src1", 0), *invented(n=40)[5:]]
    cut = corpus_pipeline.remove_repeated_passages(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), smoke_dir).collect()
    kept = {r.text for r in cut}
    assert all((a[:-1] + b[1:]) in kept for a, b in own) and rows[3][1] in kept  # the blanks beside it repeat as well
    want = sorted((d is None, d or 0, n - k) for d, n, k, _, _ in brute_bytes(rows, span=corpus_pipeline.PASSAGE))
    got = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode())) for r in cut)
    assert all(w[:2] == g[:2] and w[2] - 12 <= g[2] <= w[2] for w, g in zip(want, got, strict=True))  # a cut may break a character


def test_entry_lists_the_queries():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_without_the_subpackage(tmp_path, gone):
    shutil.copytree(REPO, tmp_path / "repo", ignore=shutil.ignore_patterns(*gone, ".git", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), [k for k in e.queries() if k.startswith('op') or k == 'pipeline'])"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True)
    assert out.stdout.strip().endswith("[]")
