"""The main flow end to end: load the eight season files, then ask the questions.

The files are written from the model in their delivered layouts (serial team
ids, gaps in the birth years, whole progressive distances, as the layouts
declare), loaded with the same layouts, corrected in fill mode, reconciled and
questioned.  :class:`FileSeason` is the model over loaded tables; a user with
the eight files opens it on their folder.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.derive import apply_corrections, generated_columns, surrogate_key
from touchline.plans.model import PERFORMANCE, PROGRESSION, TEMPS_DE_JEU, Season, opened, season
from touchline.plans.registry import MODEL_SQL, ORACLE, PARAMS, register
from touchline.session import scratch_path
from touchline.sources.delimited import Field, load_delimited, write_delimited
from touchline.sources.layouts import LAYOUTS, LOAD_ORDER
from touchline.sources.schemas import TABLES, insert_into

CORRECTIONS = [Field("id", "id_joueur", "bigint"), Field("column", "column"), Field("value", "value"), Field("reason", "reason")]

#: Players whose birth year the file leaves out; those divisible by GAP_FIXED are documented in the corrections file.
GAP, GAP_FIXED = 7, 14


class FileSeason(Season):
    """The season model over a folder with one delimited file (or folder of parts) per table."""

    def loaded(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = load_delimited(self.spark, f"{self.sf_dir}/{name}", LAYOUTS[name])
        return self._tables[name]

    @cached_property
    def equipe(self) -> DataFrame:
        return self._dim(self.loaded("equipe"))

    @cached_property
    def position(self) -> DataFrame:
        return self._dim(self.loaded("position"))

    @cached_property
    def joueur(self) -> DataFrame:
        fixes = load_delimited(self.spark, f"{self.sf_dir}/corrections", CORRECTIONS)
        hub = apply_corrections(self.loaded("joueur"), fixes, "id_joueur", ["annee_naissance"], mode="fill")
        return hub.select("id_joueur", "nom_joueur", "annee_naissance", "code_position", "id_equipe")

    @cached_property
    def stats(self) -> DataFrame:
        """The four fact files on the player id, their generated columns recomputed."""
        facts = [self.loaded(t) for t in ("temps_de_jeu", "performance", "attendu", "progression")]
        facts = [insert_into(generated_columns(f, {c: F.lit(None) for c in missing}), TABLES[t]).drop(*missing) for f, t, missing in (
            (facts[0], "temps_de_jeu", []), (facts[1], "performance", ["buts_plus_passes"]), (facts[2], "attendu", ["npxg_xag"]), (facts[3], "progression", []),
        )]
        both = reduce(lambda a, b: a.join(b, "id_joueur"), facts)
        return self._keep(generated_columns(both, {"buts_plus_passes": F.col("buts") + F.col("passes_decisives"), "npxg_xag": F.col("npxg") + F.col("xag")}))

    @cached_property
    def salaire_source_raw(self) -> DataFrame:
        return self.loaded("salaire_source")


def write_season_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The eight files and the corrections file, from the model of a driver folder."""
    s = season(spark, sf_dir)
    teams = surrogate_key(s.equipe.select("nom_equipe", F.col("id_equipe").alias("label")), ["nom_equipe"], "id_equipe")
    numbered = f"{root}/_teams"
    teams.write.parquet(numbered)
    teams = spark.read.parquet(numbered)
    hub = s.joueur.withColumnRenamed("id_equipe", "label").join(teams.select("label", "id_equipe"), "label", "left")
    year = F.col("annee_naissance")
    stats = s.stats.withColumn("progression_passe", F.round("progression_passe").cast("bigint"))
    tables = {
        "equipe": teams,
        "position": s.position,
        "joueur": hub.withColumn("annee_naissance", F.when(F.col("id_joueur") % GAP == 0, None).otherwise(year)),
        "temps_de_jeu": stats.select("id_joueur", *[c for c in TEMPS_DE_JEU if c != "minutes_jouees"], F.round("minutes_jouees").cast("bigint").alias("minutes_jouees")),
        "performance": stats.select("id_joueur", *PERFORMANCE, F.col("buts_plus_passes").alias("_f3")),
        "attendu": stats,
        "progression": stats.select("id_joueur", *PROGRESSION),
        "salaire_source": s.salaire_source_raw,
    }
    for name in LOAD_ORDER:
        write_delimited(tables[name], f"{root}/{name}", LAYOUTS[name])
    fixes = s.joueur.filter((F.col("id_joueur") % GAP_FIXED == 0) & year.isNotNull()).select(
        "id_joueur", F.lit("annee_naissance").alias("column"), year.cast("string").alias("value"), F.lit("documented").alias("reason")
    )
    write_delimited(fixes, f"{root}/corrections", CORRECTIONS)


_FILES_MODEL = (
    MODEL_SQL.replace("{year} - p_size AS annee_naissance", f"CASE WHEN p_partkey % {GAP} = 0 AND p_partkey % {GAP_FIXED} <> 0 THEN NULL ELSE {{year}} - p_size END AS annee_naissance")
    .replace("sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS progression_passe", "CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS progression_passe")
    .format(**PARAMS).strip()
)


def _files_oracle(key: str) -> str:
    """The question's own SQL over the model as the files carry it."""
    plain = MODEL_SQL.format(**PARAMS).strip()
    if plain not in ORACLE[key]:
        raise ValueError(key)
    return ORACLE[key].replace(plain, _FILES_MODEL)


def _register(key: str) -> None:
    from touchline.plans.registry import QUERIES

    question = QUERIES[key]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, "season_files")
        write_season_files(spark, sf_dir, root)
        with opened(FileSeason(spark, root)):
            return question(spark, root)

    run.__doc__ = f"{question.__doc__} (from the loaded files)"
    register(f"files_{key}")(run)
    ORACLE[f"files_{key}"] = _files_oracle(key)


for _key in ("q01", "q11", "c11"):
    _register(_key)
