"""Language of web pages by Bayesian fusion of the evidence.

Evidence, per page:
- text likelihood: byte trigrams of the visible text under a naive Bayes model
  per language, fitted on at most ``sample`` labelled documents a language (a
  documented parameter); the log likelihood is taken per trigram, times at most
  ``strength`` trigrams, since neighbouring trigrams are not independent;
- the language the markup declares (``lang`` of the html element): the
  likelihood of a declaration given the language is estimated from all pages;
- the address: host priors smoothed towards their suffix (the last label of the
  host), suffixes towards the whole table.  Counts are sums of the pages' text
  and declaration posteriors by grouped aggregation; a page's own share is
  taken out of its host's and suffix's counts before they judge it.

Hosts of any size: pages carry a salt, sums go (host, salt) -> host -> back to
(host, salt), so a page finds its prior by a key of bounded size.

A null or empty html has no text and no declaration: the address decides.  A
null url has the empty host.  Without labelled documents the result has null
languages.  Classes are the ``languages`` most frequent labels (a documented
parameter; ties by name).  Ties go to the alphabetically first language.  Repeated rows are
judged alike.  Only page_id, url and html (text and lang of the documents) are
read.  Texts are read whole.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import saved, text_buffer, thinned

CELLS = 1 << 14
NO_TEXT = re.compile(r"<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*(?:>|\Z)", re.S | re.I)
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)


def trigram_cells(data: np.ndarray) -> np.ndarray:
    """The table cell of every byte trigram (ASCII letters lower-cased)."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    h = (low[:-2] << np.uint64(16)) | (low[1:-1] << np.uint64(8)) | low[2:]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.int64)


def visible(source: str | None) -> str:
    return " ".join(html_lib.unescape(NO_TEXT.sub(" ", source)).split()) if source else ""


def fit_text(docs: DataFrame, sample: int, languages: int = 256) -> tuple[list[str], np.ndarray]:
    """(languages, log P(trigram cell | language)) from a bounded sample of labelled documents, for the ``languages`` most frequent labels."""
    from pyspark.sql.window import Window

    named = docs.filter("lang is not null and text is not null").select("doc_id", F.lower("lang").alias("lang"))
    rows = {r["lang"]: r["count"] for r in named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()}
    if rows:
        named = named.filter(F.col("lang").isin(list(rows)))
        of = F.create_map(*[F.lit(x) for lang, n in rows.items() for x in (lang, float(n))])
        named = named.filter(thinned(F.col("doc_id"), F.element_at(of, F.col("lang")), sample))
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = F.broadcast(named.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= sample).select(F.col("doc_id").alias("id"), "lang"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(chosen, F.col("doc_id") == F.col("id")).select("lang", "text").repartition(8)

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            data, offs = text_buffer(b.column(1))
            for i, lang in enumerate(b.column(0).to_pylist()):
                found = np.bincount(trigram_cells(data[offs[i] : offs[i + 1]]), minlength=CELLS)
                sums[lang] = sums[lang] + found if lang in sums else found
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[x].astype("<i8").tobytes() for x in names], pa.binary())], names=["lang", "counts"])

    total: dict[str, np.ndarray] = {}
    for r in rows.mapInArrow(count, "lang string, counts binary").collect():
        got = np.frombuffer(bytes(r["counts"]), "<i8")
        total[r["lang"]] = total.get(r["lang"], 0) + got
    langs = sorted(total)
    logs = [np.log((total[x] + 0.5) / (total[x].sum() + 0.5 * CELLS)) for x in langs]
    return langs, np.array(logs)


def _posterior(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def identify(pages: DataFrame, docs: DataFrame, sample: int = 400, languages: int = 256, strength: float = 60.0, host_weight: float = 5.0, suffix_weight: float = 20.0, salts: int = 64) -> DataFrame:
    """Every page: page_id, url, lang, score (its posterior), text_lang, declared, host."""
    spark = pages.sparkSession
    langs, logs = fit_text(docs, sample, languages)
    k = len(langs)
    if not k:
        none = F.lit(None).cast("string")
        return pages.select("page_id", "url", none.alias("lang"), F.lit(None).cast("double").alias("score"), none.alias("text_lang"), none.alias("declared"), none.alias("host"))
    shared = spark.sparkContext.broadcast((langs, logs))
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).withColumn("host", host)
    src = src.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))

    @F.pandas_udf("declared string, text array<double>")
    def read(html: pd.Series) -> pd.DataFrame:
        names, table = shared.value
        out = []
        for source in html:
            m = DECLARED.search(source) if source else None
            cells = trigram_cells(np.frombuffer(visible(source).encode(), np.uint8))
            score = table[:, cells].sum(axis=1) * (min(1.0, strength / len(cells))) if len(cells) else np.zeros(len(names))
            out.append((m[1].lower() if m and m[1].lower() in names else ("other" if m else "none"), (score - score.max()).tolist()))
        return pd.DataFrame(out, columns=["declared", "text"])

    read_pages = src.withColumn("e", read("html")).select("page_id", "url", "host", "suffix", "salt", "e.declared", "e.text")
    read_pages = saved(read_pages, "lang-pages")

    def exps(col: str):
        return [F.exp(F.element_at(col, i + 1)) for i in range(k)]

    norm = sum(exps("text")[1:], exps("text")[0])
    first = read_pages.select("declared", *[(e / norm).alias(f"p{i}") for i, e in enumerate(exps("text"))])
    said = first.groupBy("declared").agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(k)]).collect()  # languages + 2 rows
    kinds = [*langs, "other", "none"]
    table = np.full((k, len(kinds)), 0.5)
    table[:, :k] += 4.0 * np.eye(k)  # before any page is seen, a declaration tells the truth
    for r in said:
        table[:, kinds.index(r["declared"])] += [r[f"p{i}"] or 0.0 for i in range(k)]
    declared_logs = np.log(table / table.sum(axis=1, keepdims=True))

    spread = F.create_map(*[x for j, d in enumerate(kinds) for x in (F.lit(d), F.array(*[F.lit(float(v)) for v in declared_logs[:, j]]))])
    own = read_pages.withColumn("own", F.zip_with("text", F.element_at(spread, F.col("declared")), lambda a, b: a + b))
    top = own.withColumn("own", F.transform("own", lambda x: x - F.array_max("own")))
    total = F.aggregate("own", F.lit(0.0), lambda acc, x: acc + F.exp(x))
    judged = top.withColumn("p", F.transform("own", lambda x: F.exp(x) / total))
    judged = saved(judged, "lang-judged")
    sums = [F.sum(F.element_at("p", i + 1)).alias(f"p{i}") for i in range(k)]
    cell = saved(judged.groupBy("suffix", "host", "salt").agg(*sums), "lang-cells")
    again = [F.sum(f"p{i}").alias(f"p{i}") for i in range(k)]
    hosts = saved(cell.groupBy("suffix", "host").agg(*again), "lang-hosts")
    suffixes = hosts.groupBy("suffix").agg(*again)
    whole = suffixes.agg(*again).first()
    base = np.array([(whole[f"p{i}"] or 0.0) + 0.5 for i in range(k)]) if whole else np.full(k, 0.5)
    base = (base / base.sum()).tolist()
    arr = F.array(*[F.col(f"p{i}") for i in range(k)])
    per_suffix = saved(suffixes.select(F.col("suffix").alias("x_suffix"), arr.alias("suffix_sums")), "lang-suffixes")
    per_host = saved(hosts.select(F.col("suffix").alias("h_suffix"), F.col("host").alias("h_host"), arr.alias("host_sums")), "lang-host-sums")
    known = per_host.join(per_suffix, F.col("h_suffix") == F.col("x_suffix")).select("h_host", "host_sums", "suffix_sums")
    known = saved(cell.select("host", "salt").join(saved(known, "lang-known"), F.col("host") == F.col("h_host")).select(F.col("host").alias("h"), F.col("salt").alias("s"), "host_sums", "suffix_sums"), "lang-salted")
    both = judged.join(known, (F.col("host") == F.col("h")) & (F.col("salt") == F.col("s")))

    def fuse(batches):
        names = np.array(langs, object)
        for b in batches:
            p, own_, text, h, s = (np.stack([np.asarray(v, float) for v in b[c]]) for c in ("p", "own", "text", "host_sums", "suffix_sums")) if len(b) else (np.zeros((0, k)),) * 5
            left_s = np.maximum(s - h, 0.0)  # the suffix without the host itself
            prior_s = (left_s + suffix_weight * np.array(base)) / (left_s.sum(axis=1, keepdims=True) + suffix_weight)
            left_h = np.maximum(h - p, 0.0)  # the host without the page itself
            prior_h = (left_h + host_weight * prior_s) / (left_h.sum(axis=1, keepdims=True) + host_weight)
            post = _posterior(own_ + np.log(prior_h)) if len(b) else np.zeros((0, k))
            best = post.argmax(axis=1) if len(b) else np.zeros(0, int)
            yield pd.DataFrame({
                "page_id": b["page_id"], "url": b["url"], "lang": names[best], "score": post[np.arange(len(b)), best],
                "text_lang": names[text.argmax(axis=1)] if len(b) else names[best], "declared": b["declared"], "host": b["host"],
            })

    cols = ["page_id", "url", "p", "own", "text", "host_sums", "suffix_sums", "declared", "host"]
    return both.select(*cols).mapInPandas(fuse, "page_id long, url string, lang string, score double, text_lang string, declared string, host string")
