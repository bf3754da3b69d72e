"""Business questions on consolidated rows (duplicates merged)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import exact_div, floor_int, full_name, match_key, mean, ratio, round2
from touchline.operators.listing import distinct_lists
from touchline.operators.ranking import asc, best_per_group, desc, ranked_shortlist, top_k
from touchline.operators.shares import share_of_total
from touchline.plans.model import (
    ATTACK_PATTERN,
    CONSOLIDATED_MEASURES,
    CONSOLIDATED_LABEL,
    CONSOLIDATION_KEYS,
    GOALS_MIN_SHORTLIST,
    RAW_LABEL_COMPARISONS,
    RAW_LABEL_QUESTIONS,
    SALARY_CAP,
    SALARY_UNIT,
    conform,
    season,
)
from touchline.plans.registry import register
from touchline.plans.sqltext import big, dbl, floor_ratio, mean as smean, ratio as sratio, teams

_DECIMAL_MEASURES = {"minutes_jouees", "matchs_90", "xg", "npxg", "xag", "progression_passe"}
_VIEW_COLUMNS = ", ".join(
    ["CAST(id_joueur_reference AS BIGINT) AS id_joueur_reference", "nom_joueur", "code_position",
     "id_equipe"]
    + [(dbl(m) if m in _DECIMAL_MEASURES else big(m)) + f" AS {m}" for m in CONSOLIDATED_MEASURES]
)


@register("consolidate", f"SELECT {_VIEW_COLUMNS} FROM v")
def consolidate_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated view: one row per (name, position, team), MIN(id), sixteen sums."""
    return conform(season(spark, sf_dir).consolidated)


def _counts(spark: SparkSession, sf_dir: str, raw_label: str) -> DataFrame:
    s = season(spark, sf_dir)
    raw = s.joueur.agg(F.count(F.lit(1)).alias("nombre_lignes")).select(F.lit(raw_label).alias("source"), "nombre_lignes")
    cons = s.consolidated.agg(F.count(F.lit(1)).alias("nombre_lignes")).select(
        F.lit(CONSOLIDATED_LABEL).alias("source"), "nombre_lignes"
    )
    return raw.unionByName(cons)


def _counts_sql(raw_label: str) -> str:
    return (
        f"SELECT '{raw_label}' AS source, count(*) AS nombre_lignes FROM joueur\n"
        f"UNION ALL SELECT '{CONSOLIDATED_LABEL}', count(*) FROM v"
    )


@register("c00", _counts_sql(RAW_LABEL_QUESTIONS))
def c00(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count before / after consolidation."""
    return _counts(spark, sf_dir, RAW_LABEL_QUESTIONS)


@register("d00", _counts_sql(RAW_LABEL_COMPARISONS))
def d00(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count control of the comparison script."""
    return _counts(spark, sf_dir, RAW_LABEL_COMPARISONS)


@register(
    "c02",
    f"""
SELECT e.nom_equipe AS equipe, {dbl(smean('v.matchs_joues'))} AS moyenne_matchs_joues_par_joueur
FROM v JOIN equipe e ON v.id_equipe = e.id_equipe
GROUP BY e.nom_equipe
""",
)
def c02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean matches per consolidated player, per team."""
    s = season(spark, sf_dir)
    df = s.consolidated.join(s.equipe, "id_equipe")
    out = df.groupBy(F.col("nom_equipe").alias("equipe")).agg(
        mean("matchs_joues").alias("moyenne_matchs_joues_par_joueur")
    )
    return conform(out.orderBy(desc("moyenne_matchs_joues_par_joueur"), asc("equipe")))


@register(
    "c03",
    f"""
SELECT code_position, count(*) AS nombre_joueurs,
       {dbl(sratio('count(*)', 'SUM(count(*)) OVER ()', percent=True))} AS pourcentage_total
FROM (SELECT nom_joueur, code_position FROM v GROUP BY nom_joueur, code_position) x
GROUP BY code_position
""",
)
def c03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players per position counted as distinct (name, position)."""
    s = season(spark, sf_dir)
    distinct = s.consolidated.select("nom_joueur", "code_position").distinct()
    grouped = distinct.groupBy("code_position").agg(F.count(F.lit(1)).alias("nombre_joueurs"))
    out = share_of_total(grouped, "nombre_joueurs", "pourcentage_total")
    return conform(out.orderBy(desc("nombre_joueurs"), asc("code_position")))


@register(
    "c03_rows",
    f"""
SELECT code_position, count(*) AS nombre_joueurs,
       {dbl(sratio('count(*)', 'SUM(count(*)) OVER ()', percent=True))} AS pourcentage_total
FROM v GROUP BY code_position
""",
)
def c03_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players per position counted as consolidated rows (the comparison script's reading)."""
    s = season(spark, sf_dir)
    grouped = s.consolidated.groupBy("code_position").agg(F.count(F.lit(1)).alias("nombre_joueurs"))
    out = share_of_total(grouped, "nombre_joueurs", "pourcentage_total")
    return conform(out.orderBy(desc("nombre_joueurs"), asc("code_position")))


@register(
    "c04",
    f"""
SELECT {dbl(smean('v.buts'))} AS moyenne_buts_attaquants FROM v WHERE v.code_position LIKE '{{attack}}'
""",
)
def c04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean goals of consolidated attackers."""
    s = season(spark, sf_dir)
    df = s.consolidated.filter(F.col("code_position").like(ATTACK_PATTERN))
    return conform(df.agg(mean("buts").alias("moyenne_buts_attaquants")))


@register(
    "c06",
    f"""
SELECT v.nom_joueur, {teams()} AS equipes, {big('SUM(v.buts)')} AS total_buts
FROM v JOIN equipe e ON v.id_equipe = e.id_equipe
GROUP BY v.nom_joueur
ORDER BY SUM(v.buts) DESC NULLS FIRST, v.nom_joueur
LIMIT 10
""",
)
def c06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 scorers by name, with the teams they played for."""
    s = season(spark, sf_dir)
    df = s.consolidated.join(s.equipe, "id_equipe")
    by_name = distinct_lists(df, ["nom_joueur"], "nom_equipe", "equipes", ["buts"]).withColumnRenamed("buts", "total_buts")
    return conform(top_k(by_name, [desc("total_buts")], 10, tie=["nom_joueur"]))


@register(
    "c07",
    f"""
SELECT code_position, {dbl(smean('minutes_jouees'))} AS moyenne_minutes_jouees,
       {dbl(smean('matchs_90'))} AS moyenne_matchs_90
FROM (SELECT nom_joueur, code_position, SUM(minutes_jouees) AS minutes_jouees, SUM(matchs_90) AS matchs_90
      FROM v GROUP BY nom_joueur, code_position) x
GROUP BY code_position
""",
)
def c07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean minutes / nineties per position, players regrouped by (name, position) first."""
    s = season(spark, sf_dir)
    per_player = s.consolidated.groupBy("nom_joueur", "code_position").agg(
        F.sum("minutes_jouees").alias("minutes_jouees"), F.sum("matchs_90").alias("matchs_90")
    )
    out = per_player.groupBy("code_position").agg(
        mean("minutes_jouees").alias("moyenne_minutes_jouees"), mean("matchs_90").alias("moyenne_matchs_90")
    )
    return conform(out.orderBy(desc("moyenne_minutes_jouees"), asc("code_position")))


@register(
    "c07_rows",
    f"""
SELECT code_position, {dbl(smean('minutes_jouees'))} AS moyenne_minutes_jouees,
       {dbl(smean('matchs_90'))} AS moyenne_matchs_90
FROM v GROUP BY code_position
""",
)
def c07_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean minutes / nineties per position over consolidated rows (comparison script's reading)."""
    s = season(spark, sf_dir)
    out = s.consolidated.groupBy("code_position").agg(
        mean("minutes_jouees").alias("moyenne_minutes_jouees"), mean("matchs_90").alias("moyenne_matchs_90")
    )
    return conform(out.orderBy(desc("moyenne_minutes_jouees"), asc("code_position")))


@register(
    "c09",
    f"""
SELECT v.nom_joueur, {teams()} AS equipes, {big('SUM(v.buts)')} AS total_buts,
       {dbl('round(SUM(v.xg), 2)')} AS total_xg,
       {dbl('round(SUM(v.buts) - SUM(v.xg), 2)')} AS difference_buts_xg
FROM v JOIN equipe e ON v.id_equipe = e.id_equipe
GROUP BY v.nom_joueur
ORDER BY round(SUM(v.buts) - SUM(v.xg), 2) DESC NULLS FIRST, v.nom_joueur
LIMIT 10
""",
)
def c09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 goals above expected, by name."""
    s = season(spark, sf_dir)
    df = s.consolidated.join(s.equipe, "id_equipe")
    by_name = distinct_lists(df, ["nom_joueur"], "nom_equipe", "equipes", ["buts", "xg"])
    by_name = by_name.select(
        "nom_joueur",
        "equipes",
        F.col("buts").alias("total_buts"),
        round2("xg").alias("total_xg"),
        round2(F.col("buts") - F.col("xg")).alias("difference_buts_xg"),
    )
    return conform(top_k(by_name, [desc("difference_buts_xg")], 10, tie=["nom_joueur"]))


@register(
    "c10",
    f"""
SELECT nom_equipe, nom_joueur, {dbl('progression_passe')} AS prgp FROM v JOIN equipe USING (id_equipe)
QUALIFY ROW_NUMBER() OVER (PARTITION BY id_equipe ORDER BY progression_passe DESC NULLS FIRST, id_joueur_reference) = 1
ORDER BY prgp DESC NULLS FIRST, nom_equipe
""",
)
def c10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best progressive-pass consolidated player of each club."""
    s = season(spark, sf_dir)
    df = s.consolidated.join(s.equipe, "id_equipe").select(
        "id_equipe", "id_joueur_reference", "nom_equipe", "nom_joueur", F.col("progression_passe").alias("prgp")
    )
    best = best_per_group(df, ["id_equipe"], [desc("prgp")], tie=["id_joueur_reference"])
    return conform(best.select("nom_equipe", "nom_joueur", "prgp").orderBy(desc("prgp"), asc("nom_equipe")))


def consolidated_shortlist(s, by: str) -> DataFrame:
    """Candidates of the consolidated shortlist, one row per name.

    ``by="id"``: salary rows linked to the view's reference id.  Every
    linked row counts, as in the source query, where a player with m salary
    rows adds his goals m times; the rows are pre-aggregated per id (m and
    the lowest salary) and the sums weighted by m, which gives the same
    result without building the fan-out (a hot id cannot flood one task).
    ``by="name"``: the lowest capped salary per source name, matched on the
    normalised full name (name + club) of each consolidated row.
    """
    v = s.consolidated.filter(F.col("code_position").like(ATTACK_PATTERN)).join(s.equipe, "id_equipe")
    capped = s.salaire_source.filter(F.col("salaire_annuel") <= SALARY_CAP)
    if by == "id":
        sal = capped.groupBy(F.col("id_joueur").alias("id_joueur_reference")).agg(
            F.count(F.lit(1)).alias("__copies"), F.min("salaire_annuel").alias("salaire_annuel")
        )
        joined = v.join(sal, "id_joueur_reference")
    else:
        sal = capped.groupBy(match_key("nom_joueur").alias("__k")).agg(F.min("salaire_annuel").alias("salaire_annuel"))
        joined = v.withColumn("__k", match_key(full_name("nom_joueur", "nom_equipe"))).join(sal, "__k")
        joined = joined.withColumn("__copies", F.lit(1).cast("long"))
    weighed = joined.select(
        "nom_joueur", "nom_equipe", "salaire_annuel",
        (F.col("buts") * F.col("__copies")).alias("buts"), (F.col("progression_passe") * F.col("__copies")).alias("prgp"),
    )
    grouped = distinct_lists(weighed, ["nom_joueur"], "nom_equipe", "equipes", ["buts", "prgp"], ["salaire_annuel"])
    grouped = grouped.select("nom_joueur", "equipes", ratio("salaire_annuel", F.lit(SALARY_UNIT)).alias("salaire_millions_euros"), "buts", "prgp")
    return grouped.filter(F.col("buts") >= GOALS_MIN_SHORTLIST).withColumn(
        "ratio", floor_int(exact_div("prgp", F.nullif(F.col("buts"), F.lit(0))))
    )


def _shortlist_sql(by: str) -> str:
    if by == "id":
        pay = "(SELECT id_joueur AS cle, salaire_annuel FROM salaire_source WHERE salaire_annuel <= {cap}) p ON cle = id_joueur_reference"
    else:
        pay = (
            "(SELECT lower(trim(nom_joueur)) AS cle, min(salaire_annuel) AS salaire_annuel FROM salaire_source "
            "WHERE salaire_annuel <= {cap} GROUP BY cle) p ON cle = lower(trim(v.nom_joueur || ' ' || nom_equipe))"
        )
    return f"""
WITH by_name AS (
  SELECT v.nom_joueur, {teams('nom_equipe')} AS equipes, min(salaire_annuel) AS paie, sum(v.buts) AS buts, sum(progression_passe) AS prgp
  FROM v JOIN equipe USING (id_equipe) JOIN {pay}
  WHERE code_position LIKE '{{attack}}' GROUP BY v.nom_joueur)
SELECT {big("row_number() OVER (ORDER BY buts DESC NULLS FIRST, " + floor_ratio('prgp', 'buts') + " NULLS LAST, prgp NULLS LAST, nom_joueur)")} AS rang,
       nom_joueur, equipes, {dbl(sratio('paie', '{unit}'))} AS salaire_millions_euros, {big('buts')} AS buts, {dbl('prgp')} AS prgp,
       {big(floor_ratio('prgp', 'buts'))} AS ratio
FROM by_name WHERE buts >= {{goals_min}} ORDER BY rang LIMIT 10
"""


def shortlist_order() -> list:
    """Goals first, then the lowest ratio, then the lowest PrgP."""
    return [desc("buts"), asc("ratio"), asc("prgp")]


def _shortlist(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    cand = consolidated_shortlist(season(spark, sf_dir), by)
    ranked = ranked_shortlist(cand, shortlist_order(), 10, tie=["nom_joueur"])
    out = ranked.select("rang", "nom_joueur", "equipes", "salaire_millions_euros", "buts", "prgp", "ratio")
    return conform(out.orderBy("rang"))


@register("c11", _shortlist_sql("id"))
def c11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated shortlist, salary joined on the reference id."""
    return _shortlist(spark, sf_dir, "id")


@register("c11_by_name", _shortlist_sql("name"))
def c11_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidated shortlist, lowest capped salary joined by name."""
    return _shortlist(spark, sf_dir, "name")


__all__ = ["CONSOLIDATION_KEYS", "consolidated_shortlist"]
