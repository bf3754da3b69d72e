"""Corpus pipeline: drop toxic documents, keep one of each group of near copies, remove repeated
passages, mix the sources, pack the mix into sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last keep the columns of ``documents``.  Between stages the rows are
written as Parquet and read again, so each stage works on everything its
predecessor kept.  A stage's scratch tables go when the next one of the same
folder begins, unless its documents still read them.

Null texts are empty: such documents pass toxicity with the score of texts without
terms, are near copies of nothing, lose nothing and are packed as the end id alone.
A null doc_id or source is a value like others (a source of its own, the last).
Repeated rows are near copies of each other, so one stays.  The suffix stage sets
``n_chars`` to its new texts.  Further columns are carried, whatever their names.
Long texts are read whole.  Empty tables give empty results.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from touchline.llm.common import saved, table
from touchline.llm.queries import tokenizer_path
from touchline.session import drop_path, recorded_scratch

#: Bytes from which a repeated passage goes: 51 words take more, but for runs of very short words (op5 has its own length).
PASSAGE = 200


#: Scratch folders of the last stage, by data folder.
_LEFT: dict[str, list[str]] = {}


def _clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> None:
    """Remove what the stage before wrote, but for folders that ``docs`` reads."""
    read = docs.inputFiles()
    for path in _LEFT.pop(sf_dir, []):
        if not any(path.split("://")[-1] in f for f in read):
            drop_path(spark, path)


def _stage(work):
    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clean(spark, docs, sf_dir)
        with recorded_scratch() as made:
            out = work(spark, docs, sf_dir)
        _LEFT[sf_dir] = made
        return out

    return run


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


@_stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


@_stage
def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, span=PASSAGE)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("suffix_array_dedup", remove_repeated_passages),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The toxicity model, tokens and hash-keyed draws cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with recorded_scratch() as made:
            docs = saved(out, f"stage-{name}")
        for path in before:
            drop_path(spark, path)
        before = made
    _clean(spark, docs, sf_dir)
    return docs
