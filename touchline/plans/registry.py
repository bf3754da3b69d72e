"""Query registry: every catalogue key, its Spark recipe and its SQL oracle.

The oracle is an independent ANSI-SQL statement over the same driver tables
(run by DuckDB in the correctness check).  It starts from ``MODEL_SQL``, the
season model written as common table expressions, so each recipe's SQL only
states the question itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.plans.model import (
    ATTACK_PATTERN,
    GOALS_MIN_LIMITED,
    GOALS_MIN_SHORTLIST,
    MINUTES_MIN,
    NINETIES_MIN,
    NINETIES_RANGE,
    REFERENCE_YEAR,
    SALARY_CAP,
    SALARY_UNIT,
)

Recipe = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Recipe] = {}
ORACLE: dict[str, str] = {}

# Placeholders usable in oracle SQL.
PARAMS = {
    "year": REFERENCE_YEAR,
    "attack": ATTACK_PATTERN,
    "cap": SALARY_CAP,
    "unit": SALARY_UNIT,
    "goals_min": GOALS_MIN_SHORTLIST,
    "nineties_min": NINETIES_MIN,
    "nineties_lo": NINETIES_RANGE[0],
    "nineties_hi": NINETIES_RANGE[1],
    "goals_limited": GOALS_MIN_LIMITED,
    "minutes_min": MINUTES_MIN,
}

# The season model as CTEs (mirrors touchline.plans.model).  Ratios use
# DOUBLE division cast to DECIMAL(38,10) before ROUND, which rounds HALF_UP
# on the decimal; the recipes divide in wide decimals.
MODEL_SQL = """
equipe AS (
  SELECT DISTINCT p_brand AS id_equipe, p_brand AS nom_equipe FROM part),
position AS (
  SELECT DISTINCT p_type AS code_position, lower(p_type) AS libelle_position FROM part),
joueur AS (
  SELECT p_partkey AS id_joueur, p_name AS nom_joueur, {year} - p_size AS annee_naissance,
         p_type AS code_position, p_brand AS id_equipe
  FROM part),
stats0 AS (
  SELECT l_partkey AS id_joueur,
         count(*) AS matchs_joues,
         count_if(l_quantity >= 45) AS matchs_titulaires,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS minutes_jouees,
         count_if(l_discount >= 0.08) AS buts,
         count_if(l_tax >= 0.06) AS passes_decisives,
         count_if(l_discount >= 0.08 AND l_returnflag <> 'A') AS buts_hors_penalties,
         count_if(l_returnflag = 'A' AND l_linestatus = 'F') AS penalties_marques,
         count_if(l_returnflag = 'A') AS penalties_tentes,
         count_if(l_returnflag = 'N' AND l_linestatus = 'O') AS cartons_jaunes,
         count_if(l_returnflag = 'R') AS cartons_rouges,
         sum(CAST(l_discount AS DECIMAL(18,2))) AS xg,
         sum(CASE WHEN l_returnflag <> 'A' THEN CAST(l_discount AS DECIMAL(18,2)) ELSE 0 END) AS npxg,
         sum(CAST(l_tax AS DECIMAL(18,2))) AS xag,
         count_if(l_linenumber = 1) AS progression_conduite,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS progression_passe,
         count_if(l_linestatus = 'O') AS progression_course
  FROM lineitem GROUP BY l_partkey),
stats AS (
  SELECT *,
         CAST(round(CAST(minutes_jouees / 90 AS DECIMAL(38,10)), 2) AS DECIMAL(30,2)) AS matchs_90,
         buts + passes_decisives AS buts_plus_passes,
         npxg + xag AS npxg_xag
  FROM stats0),
performance AS (
  SELECT id_joueur, buts, passes_decisives, buts_hors_penalties, penalties_marques, penalties_tentes,
         cartons_jaunes, cartons_rouges, buts_plus_passes FROM stats),
temps_de_jeu AS (
  SELECT id_joueur, matchs_joues, matchs_titulaires, minutes_jouees, matchs_90 FROM stats),
attendu AS (SELECT id_joueur, xg, npxg, xag, npxg_xag FROM stats),
progression AS (
  SELECT id_joueur, progression_conduite, progression_passe, progression_course FROM stats),
salaire_brut AS (
  SELECT p_partkey * 10 + 7 AS id_joueur_source,
         '  ' || CASE WHEN p_partkey % 11 = 0 THEN 'X ' ELSE '' END || upper(p_name || ' ' || p_brand) || ' '
           AS nom_joueur,
         CAST(p_size + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS age,
         CAST(p_retailprice AS DECIMAL(12,2)) AS salaire_annuel,
         'derived from part' AS note_source
  FROM part),
cible AS (
  SELECT j.id_joueur, lower(trim(j.nom_joueur || ' ' || e.nom_equipe)) AS k_name,
         {year} - j.annee_naissance AS k_age
  FROM joueur j JOIN equipe e ON j.id_equipe = e.id_equipe),
passe1 AS (SELECT k_name, k_age, min(id_joueur) AS id1, count(*) AS n1 FROM cible GROUP BY k_name, k_age),
passe2 AS (SELECT k_name, min(id_joueur) AS id2, count(*) AS n2 FROM cible GROUP BY k_name),
salaire_source AS (
  SELECT s.id_joueur_source, s.nom_joueur, s.age, s.salaire_annuel, s.note_source,
         coalesce(p1.id1, p2.id2) AS id_joueur,
         CASE WHEN p1.id1 IS NOT NULL THEN 1 WHEN p2.id2 IS NOT NULL THEN 2 END AS matched_pass,
         CASE WHEN p1.id1 IS NOT NULL THEN p1.n1 WHEN p2.id2 IS NOT NULL THEN p2.n2 END AS n_candidates
  FROM salaire_brut s
  LEFT JOIN passe1 p1 ON lower(trim(s.nom_joueur)) = p1.k_name AND s.age = p1.k_age
  LEFT JOIN passe2 p2 ON lower(trim(s.nom_joueur)) = p2.k_name),
v AS (
  SELECT MIN(j.id_joueur) AS id_joueur_reference, j.nom_joueur, j.code_position, j.id_equipe,
         SUM(s.buts) AS buts, SUM(s.passes_decisives) AS passes_decisives,
         SUM(s.penalties_marques) AS penalties_marques, SUM(s.penalties_tentes) AS penalties_tentes,
         SUM(s.cartons_jaunes) AS cartons_jaunes, SUM(s.cartons_rouges) AS cartons_rouges,
         SUM(s.matchs_joues) AS matchs_joues, SUM(s.matchs_titulaires) AS matchs_titulaires,
         SUM(s.minutes_jouees) AS minutes_jouees, SUM(s.matchs_90) AS matchs_90,
         SUM(s.xg) AS xg, SUM(s.npxg) AS npxg, SUM(s.xag) AS xag,
         SUM(s.progression_conduite) AS progression_conduite,
         SUM(s.progression_passe) AS progression_passe,
         SUM(s.progression_course) AS progression_course
  FROM joueur j JOIN stats s ON j.id_joueur = s.id_joueur
  GROUP BY j.nom_joueur, j.code_position, j.id_equipe)
"""


def _sql(body: str) -> str:
    model = MODEL_SQL.format(**PARAMS).strip()
    body = body.format(**PARAMS).strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {model},\n{body[5:]}"
    return f"WITH {model}\n{body}"


def register(key: str, sql: str | None = None) -> Callable[[Recipe], Recipe]:
    """Register a recipe under ``key`` with an optional SQL oracle body."""

    def deco(fn: Recipe) -> Recipe:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = _sql(sql)
        return fn

    return deco
