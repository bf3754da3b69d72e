"""The season model: hub, dimensions, facts and external source as DataFrames.

The statistics model (one hub of players, two dimensions, four one-row-per-
player fact tables and an external salary source) is derived from the
driver's tables:

* hub ``joueur``      <- ``part`` (one row per part)
* dim ``equipe``      <- distinct ``p_brand`` (its own key); dim ``position`` <- distinct ``p_type``
* facts               <- ``lineitem`` aggregated per ``l_partkey`` (one pass)
* ``salaire_source``  <- ``part`` re-keyed and re-spelled, then reconciled

All four facts come out of a single aggregation of ``lineitem`` (one scan,
one shuffle on the part key) instead of four tables joined back together;
each fact table is a projection of it.  The aggregation's output is hash-
partitioned on the player id, so the hub join only shuffles ``part``.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import exact_div, full_name, match_key
from touchline.operators.consolidate import consolidate
from touchline.operators.derive import generated_columns
from touchline.operators.joins import DIM_BROADCAST_MAX_ROWS, HOT_KEY_MIN_ROWS, bounded_rows
from touchline.operators.reconcile import reconcile
from touchline.session import written

# ---------------------------------------------------------------------------
# Fixed values of the mapping onto the driver tables.
# REFERENCE_YEAR: season year; age = REFERENCE_YEAR - birth year.
# ATTACK_PATTERN: the attacker filter (LIKE '%AT%' on positions) re-aimed.
# SALARY_CAP / SALARY_UNIT: the 3,000,000 cap and the 1,000,000 display unit
#   re-aimed to the 900..2000 range of p_retailprice.
# GOALS_MIN_SHORTLIST: goals >= 5 in the shortlists.
# NINETIES_MIN: nineties >= 5 (goals per 90).
# NINETIES_RANGE / GOALS_MIN_LIMITED: BETWEEN 5 AND 20, goals >= 3 (limited time).
# MINUTES_MIN: minutes >= 1500 (most used attackers).
REFERENCE_YEAR = 2025
ATTACK_PATTERN = "%MO%"
SALARY_CAP = 980
SALARY_UNIT = 100
GOALS_MIN_SHORTLIST = 5
NINETIES_MIN = 5
NINETIES_RANGE = (5, 10)
GOALS_MIN_LIMITED = 3
MINUTES_MIN = 700
# ---------------------------------------------------------------------------
# Labels printed by the row-count controls, in their order.
#   per table:      Joueurs, Équipes, Performances, Temps de jeu, Attendu, Progression
#   before/after:   joueurs bruts (questions), joueur brut (comparisons), joueurs consolidés
ROW_COUNT_LABELS = ("Joueurs", "Équipes", "Performances", "Temps de jeu", "Attendu", "Progression")
RAW_LABEL_QUESTIONS = "joueurs bruts"
RAW_LABEL_COMPARISONS = "joueur brut"
CONSOLIDATED_LABEL = "joueurs consolidés"
# ---------------------------------------------------------------------------

# The measures of each fact table, and the consolidated sums, in column order.
PERFORMANCE = [
    "buts",
    "passes_decisives",
    "buts_hors_penalties",
    "penalties_marques",
    "penalties_tentes",
    "cartons_jaunes",
    "cartons_rouges",
]
TEMPS_DE_JEU = ["matchs_joues", "matchs_titulaires", "minutes_jouees", "matchs_90"]
ATTENDU = ["xg", "npxg", "xag"]
PROGRESSION = ["progression_conduite", "progression_passe", "progression_course"]

# The sixteen sums of the consolidated view, in its column order.
CONSOLIDATED_MEASURES = [
    "buts",
    "passes_decisives",
    "penalties_marques",
    "penalties_tentes",
    "cartons_jaunes",
    "cartons_rouges",
    "matchs_joues",
    "matchs_titulaires",
    "minutes_jouees",
    "matchs_90",
    "xg",
    "npxg",
    "xag",
    "progression_conduite",
    "progression_passe",
    "progression_course",
]
CONSOLIDATION_KEYS = ["nom_joueur", "code_position", "id_equipe"]

# Line amounts are taken as DECIMAL(18,2) and summed without narrowing: SUM
# widens to DECIMAL(28,2).
MONEY = "decimal(18,2)"
MINUTES = "decimal(30,2)"


def conform(df: DataFrame) -> DataFrame:
    """Output types of the query catalogue: exact decimals as DOUBLE, integers as BIGINT.

    Applied last, after all rounding was done in decimal.
    """
    out = []
    for f in df.schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, T.DecimalType):
            out.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            out.append(name)
    # One expression list, one call into the JVM.
    return df.selectExpr(*out)


class Season:
    """Lazily built DataFrames of the season model for one data folder.

    With ``keep`` the three derived tables that every question reads (the
    fact aggregate, the reconciled salary source and the consolidated view)
    are persisted (memory, spilling to disk) the first time a query computes
    them; a lost block is rebuilt from its short lineage (one aggregation)
    and :meth:`release` frees them.  Without it (the default) each question
    is planned from the files and prunes the aggregate to the measures it
    uses.  ``hot_key_rows`` is the plan-only hot-key threshold.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, keep: bool = False, hot_key_rows: int = HOT_KEY_MIN_ROWS
    ):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.keep = keep
        self.hot_key_rows = hot_key_rows
        self._tables: dict[str, DataFrame] = {}
        self._kept: list[DataFrame] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        if not self.keep:
            return df
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(kept)
        return kept

    def release(self) -> None:
        """Unpersist the loaded model tables and the dimension values."""
        for df in self._kept:
            df.unpersist()
        self._kept.clear()

    def table(self, name: str) -> DataFrame:
        """A driver table (read lazily once; the plan is reused, not the data)."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def _dim_values(self) -> DataFrame:
        """Distinct brands and distinct types of ``part`` in one aggregation (GROUPING SETS).

        Both dimensions come from one scan and one shuffle; the result (a row
        per brand and per type) is cached.
        """
        part = self.table("part")
        values = part.groupingSets([["p_brand"], ["p_type"]], "p_brand", "p_type").agg(F.grouping_id().alias("__level"))
        values = values.cache()
        self._kept.append(values)
        return values

    def _dim(self, df: DataFrame) -> DataFrame:
        # A dimension is the distinct values of a low-cardinality column; it
        # is broadcast only after its row count is checked.  A larger one is
        # written to the shared folder: joins with it then have plain shuffles
        # on both sides, which adaptive execution splits at a hot key.
        if bounded_rows(df, DIM_BROADCAST_MAX_ROWS):
            return F.broadcast(df)
        return written(df, "dimension")

    @cached_property
    def equipe(self) -> DataFrame:
        brands = self._dim_values.filter(F.col("__level") == 1)  # p_type aggregated away
        return self._dim(
            brands.select(F.col("p_brand").alias("id_equipe"), F.col("p_brand").alias("nom_equipe"))
        )

    @cached_property
    def position(self) -> DataFrame:
        types = self._dim_values.filter(F.col("__level") == 2)  # p_brand aggregated away
        return self._dim(
            types.select(F.col("p_type").alias("code_position"), F.lower("p_type").alias("libelle_position"))
        )

    # -- hub ----------------------------------------------------------------
    @cached_property
    def joueur(self) -> DataFrame:
        part = self.table("part")
        return part.select(
            F.col("p_partkey").alias("id_joueur"),
            F.col("p_name").alias("nom_joueur"),
            (F.lit(REFERENCE_YEAR) - F.col("p_size")).alias("annee_naissance"),
            F.col("p_type").alias("code_position"),
            F.col("p_brand").alias("id_equipe"),
        )

    # -- facts --------------------------------------------------------------
    @cached_property
    def stats(self) -> DataFrame:
        """All fact measures per player id, from one aggregation of ``lineitem``."""
        li = self.table("lineitem")
        disc = F.col("l_discount").cast(MONEY)
        deep = F.col("l_discount") >= 0.08
        accepted = F.col("l_returnflag") == "A"
        agg = li.groupBy(F.col("l_partkey").alias("id_joueur")).agg(
            # temps_de_jeu
            F.count(F.lit(1)).alias("matchs_joues"),
            F.count_if(F.col("l_quantity") >= 45).alias("matchs_titulaires"),
            F.sum(F.col("l_quantity").cast(MONEY)).alias("minutes_jouees"),
            # performance
            F.count_if(deep).alias("buts"),
            F.count_if(F.col("l_tax") >= 0.06).alias("passes_decisives"),
            F.count_if(deep & ~accepted).alias("buts_hors_penalties"),
            F.count_if(accepted & (F.col("l_linestatus") == "F")).alias("penalties_marques"),
            F.count_if(accepted).alias("penalties_tentes"),
            F.count_if((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")).alias("cartons_jaunes"),
            F.count_if(F.col("l_returnflag") == "R").alias("cartons_rouges"),
            # attendu
            F.sum(disc).alias("xg"),
            F.sum(F.when(~accepted, disc).otherwise(F.lit(0).cast(MONEY))).alias("npxg"),
            F.sum(F.col("l_tax").cast(MONEY)).alias("xag"),
            # progression
            F.count_if(F.col("l_linenumber") == 1).alias("progression_conduite"),
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("progression_passe"),
            F.count_if(F.col("l_linestatus") == "O").alias("progression_course"),
        )
        agg = agg.withColumn("matchs_90", F.round(exact_div("minutes_jouees", F.lit(90)), 2).cast(MINUTES))
        return self._keep(
            generated_columns(
                agg,
                {
                    "buts_plus_passes": F.col("buts") + F.col("passes_decisives"),
                    "npxg_xag": F.col("npxg") + F.col("xag"),
                },
            )
        )

    @cached_property
    def performance(self) -> DataFrame:
        return self.stats.select("id_joueur", *PERFORMANCE, "buts_plus_passes")

    @cached_property
    def temps_de_jeu(self) -> DataFrame:
        return self.stats.select("id_joueur", *TEMPS_DE_JEU)

    @cached_property
    def attendu(self) -> DataFrame:
        return self.stats.select("id_joueur", *ATTENDU, "npxg_xag")

    @cached_property
    def progression(self) -> DataFrame:
        return self.stats.select("id_joueur", *PROGRESSION)

    @cached_property
    def _players(self) -> DataFrame:
        return self.joueur.join(self.stats, "id_joueur").join(self.equipe, "id_equipe")

    def players(self) -> DataFrame:
        """Hub joined to its facts (inner) and to the team name."""
        return self._players

    # -- external source ----------------------------------------------------
    @cached_property
    def salaire_source_raw(self) -> DataFrame:
        """The external salary file as delivered: own ids, names spelled its own way.

        Names are upper-cased, padded with blanks and carry the club; one
        in eleven is misspelled (never matches); one in three gives an age
        one year off (fails the name + age pass).
        """
        part = self.table("part")
        key = F.col("p_partkey")
        name = F.concat(
            F.lit("  "),
            F.when(key % 11 == 0, F.lit("X ")).otherwise(F.lit("")),
            F.upper(full_name("p_name", "p_brand")),
            F.lit(" "),
        )
        return part.select(
            (key * 10 + 7).alias("id_joueur_source"),
            name.alias("nom_joueur"),
            (F.col("p_size") + F.when(key % 3 == 0, F.lit(1)).otherwise(F.lit(0))).cast("int").alias("age"),
            F.col("p_retailprice").cast("decimal(12,2)").alias("salaire_annuel"),
            F.lit("derived from part").alias("note_source"),
        )

    def match_target(self) -> DataFrame:
        """Hub rows with their match keys: full name (name + club) and age."""
        return self.joueur.join(self.equipe, "id_equipe").select(
            "id_joueur",
            match_key(full_name("nom_joueur", "nom_equipe")).alias("k_name"),
            (F.lit(REFERENCE_YEAR) - F.col("annee_naissance")).alias("k_age"),
        )

    @cached_property
    def salaire_source(self) -> DataFrame:
        """The salary source with ``id_joueur`` set by name + age, then by name."""
        src = self.salaire_source_raw.withColumns({"k_name": match_key("nom_joueur"), "k_age": F.col("age")})
        linked = reconcile(
            src, self.match_target(), [["k_name", "k_age"], ["k_name"]], "id_joueur", "id_joueur",
            hot_key_rows=self.hot_key_rows,
        )
        return self._keep(linked.drop("k_name", "k_age"))

    # -- consolidated view ----------------------------------------------------
    @cached_property
    def consolidated(self) -> DataFrame:
        """One row per (name, position, team): MIN(id) and sixteen sums."""
        return self._keep(
            consolidate(
                self.joueur,
                [self.stats],
                CONSOLIDATION_KEYS,
                CONSOLIDATED_MEASURES,
                "id_joueur",
                "id_joueur_reference",
            )
        )


_OPEN: dict[tuple[str, str], Season] = {}
_LOCK = threading.Lock()


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.conf.get("spark.app.id", None) or str(id(spark)), sf_dir.rstrip("/"))


def season(spark: SparkSession, sf_dir: str) -> Season:
    """The opened :class:`Season` of a data folder, else a new one that reads the files as they are now."""
    return _OPEN.get(_key(spark, sf_dir)) or Season(spark, sf_dir)


@contextmanager
def opened(s: Season):
    """While open, every question about the season's folder uses ``s`` (e.g. one that keeps its tables)."""
    key = _key(s.spark, s.sf_dir)
    with _LOCK:
        before, _OPEN[key] = _OPEN.get(key), s
    try:
        yield s
    finally:
        with _LOCK:
            _OPEN.pop(key) if before is None else _OPEN.__setitem__(key, before)
        s.release()
