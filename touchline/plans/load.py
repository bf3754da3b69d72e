"""Load-side recipes: files, data-quality reports, reconciliation, document checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.operators.derive import apply_corrections, delete_cascade, delete_set_null, surrogate_key
from touchline.operators.ranking import asc, desc, top_k
from touchline.operators.reconcile import ambiguous, summary, unmatched
from touchline.operators.shares import share_of_total
from touchline.plans.model import ATTENDU as ATTENDU_COLUMNS
from touchline.plans.model import PERFORMANCE as PERFORMANCE_COLUMNS
from touchline.plans.model import PROGRESSION, REFERENCE_YEAR, TEMPS_DE_JEU, Season, conform, season
from touchline.plans.registry import register
from touchline.plans.sqltext import big, dbl, ratio as sratio
from touchline.session import drop_path, ensure_checkpoint_dir, scratch_path
from touchline.sources.delimited import Field, load_counted, load_delimited, load_numbered, read_ordered, write_delimited, write_ordered
from touchline.sources.layouts import ATTENDU, JOUEUR, LOAD_ORDER, PERFORMANCE
from touchline.sources.tables import read_tables, reload_tables

# ---------------------------------------------------------------------------
# Data-quality rules, stated once and used for both the Spark job and its SQL.
# ``table`` names a season-model table (or a driver table when ``raw``).


@dataclass(frozen=True)
class Rule:
    table: str
    columns: tuple[str, ...]
    raw: bool = False
    parent: str | None = None
    parent_columns: tuple[str, ...] = field(default_factory=tuple)
    arg: int | tuple[int, int] | None = None


_FACTS = ("temps_de_jeu", "performance", "attendu", "progression")

PRIMARY_KEYS = [
    Rule("equipe", ("id_equipe",)),
    Rule("position", ("code_position",)),
    Rule("joueur", ("id_joueur",)),
    *[Rule(f, ("id_joueur",)) for f in _FACTS],
    Rule("salaire_source", ("id_joueur_source",)),
    Rule("lineitem", ("l_orderkey", "l_linenumber"), raw=True),
]

UNIQUES = [Rule("equipe", ("nom_equipe",))]

NOT_NULLS = [
    Rule("equipe", ("nom_equipe",)),
    Rule("position", ("libelle_position",)),
    Rule("joueur", ("nom_joueur", "code_position", "id_equipe")),
    Rule("temps_de_jeu", ("id_joueur", "matchs_joues", "matchs_titulaires", "minutes_jouees", "matchs_90")),
    Rule("performance", ("id_joueur", "buts", "passes_decisives", "buts_hors_penalties", "penalties_marques",
                         "penalties_tentes", "cartons_jaunes", "cartons_rouges")),
    Rule("attendu", ("id_joueur", "xg", "npxg", "xag")),
    Rule("progression", ("id_joueur", "progression_conduite", "progression_passe", "progression_course")),
    Rule("salaire_source", ("nom_joueur",)),
]

NON_NEGATIVE = [
    Rule("temps_de_jeu", ("matchs_joues", "matchs_titulaires", "minutes_jouees", "matchs_90")),
    Rule("performance", ("buts", "passes_decisives", "buts_hors_penalties", "penalties_marques", "penalties_tentes",
                         "cartons_jaunes", "cartons_rouges")),
    Rule("attendu", ("xg", "npxg", "xag")),
    Rule("progression", ("progression_conduite", "progression_passe", "progression_course")),
    Rule("salaire_source", ("age", "salaire_annuel")),
    Rule("customer", ("c_acctbal",), raw=True),
]

FOREIGN_KEYS = [
    Rule("joueur", ("code_position",), parent="position", parent_columns=("code_position",)),
    Rule("joueur", ("id_equipe",), parent="equipe", parent_columns=("id_equipe",)),
    *[Rule(f, ("id_joueur",), parent="joueur", parent_columns=("id_joueur",)) for f in _FACTS],
    Rule("salaire_source", ("id_joueur",), parent="joueur", parent_columns=("id_joueur",)),
    Rule("lineitem", ("l_orderkey",), raw=True, parent="orders", parent_columns=("o_orderkey",)),
    Rule("lineitem", ("l_partkey",), raw=True, parent="part", parent_columns=("p_partkey",)),
    Rule("orders", ("o_custkey",), raw=True, parent="customer", parent_columns=("c_custkey",)),
]

LENGTHS = [
    Rule("equipe", ("nom_equipe",), arg=100),
    Rule("position", ("code_position",), arg=10),
    Rule("position", ("libelle_position",), arg=50),
    Rule("joueur", ("nom_joueur",), arg=100),
    Rule("joueur", ("code_position",), arg=10),
    Rule("salaire_source", ("nom_joueur",), arg=100),
]

NUMERIC_TYPES = [
    Rule("temps_de_jeu", ("matchs_90",), arg=(6, 2)),
    Rule("attendu", ("xg",), arg=(6, 2)),
    Rule("attendu", ("npxg",), arg=(6, 2)),
    Rule("attendu", ("xag",), arg=(6, 2)),
    Rule("attendu", ("npxg_xag",), arg=(6, 2)),
    Rule("salaire_source", ("salaire_annuel",), arg=(12, 2)),
]

_RAW_TABLES = {"lineitem", "orders", "part", "customer"}


def _frame(s: Season, name: str) -> DataFrame:
    return s.table(name) if name in _RAW_TABLES else getattr(s, name)


# The four fact tables are projections of one aggregate (``stats``): their
# rules are evaluated together on it, in one pass, and reported per table.
_SHARED = "stats"


def _source(r: Rule) -> str:
    return _SHARED if r.table in _FACTS else r.table


def _by_source(rules: list[Rule]) -> dict[str, list[Rule]]:
    groups: dict[str, list[Rule]] = {}
    for r in rules:
        groups.setdefault(_source(r), []).append(r)
    return groups


def _by_check(rules: list[Rule]) -> dict[tuple, list[str]]:
    """Identical checks on one source (a key of the shared aggregate) -> the tables reporting it."""
    groups: dict[tuple, list[str]] = {}
    for r in rules:
        groups.setdefault((_source(r), r.columns, r.parent, r.parent_columns), []).append(r.table)
    return groups


def _report_sql(table: str, kind: str, columns: str, violations: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS constraint_type, '{columns}' AS columns, "
        f"CAST(COALESCE(({violations}), 0) AS BIGINT) AS violations"
    )


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _pk_sql(r: Rule, nulls_violate: bool = True, kind: str = "PRIMARY KEY") -> str:
    cols = ", ".join(r.columns)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in r.columns)
    any_null = " OR ".join(f"{c} IS NULL" for c in r.columns)
    dups = f"SELECT count(*) FROM (SELECT {cols} FROM {r.table} GROUP BY {cols} HAVING count(*) > 1) d WHERE {not_null}"
    v = f"({dups}) + (SELECT count(*) FROM {r.table} WHERE {any_null})" if nulls_violate else dups
    return _report_sql(r.table, kind, cols, v)


@register("dq_primary_key", _union_sql([_pk_sql(r) for r in PRIMARY_KEYS]))
def dq_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRIMARY KEY violations: duplicated key values plus rows with a NULL key part."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.relabel(quality.primary_key(_frame(s, src), src, list(cols)), tables)
            for (src, cols, _, _), tables in _by_check(PRIMARY_KEYS).items()
        ]
    )


@register("dq_unique", _union_sql([_pk_sql(r, nulls_violate=False, kind="UNIQUE") for r in UNIQUES]))
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNIQUE violations (NULLs never clash)."""
    s = season(spark, sf_dir)
    return quality.union_reports([quality.unique(_frame(s, r.table), r.table, r.columns) for r in UNIQUES])


@register(
    "dq_not_null",
    _union_sql(
        [_report_sql(r.table, "NOT NULL", c, f"SELECT count(*) FROM {r.table} WHERE {c} IS NULL")
         for r in NOT_NULLS for c in r.columns]
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL violations, one scan per table."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.not_null(
                _frame(s, src), src, [c for r in rs for c in r.columns], [r.table for r in rs for _ in r.columns]
            )
            for src, rs in _by_source(NOT_NULLS).items()
        ]
    )


@register(
    "dq_check",
    _union_sql(
        [_report_sql(r.table, "CHECK", f"{c} >= 0", f"SELECT count(*) FROM {r.table} WHERE NOT ({c} >= 0)")
         for r in NON_NEGATIVE for c in r.columns]
    ),
)
def dq_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CHECK (x >= 0) violations; a NULL value passes."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.check(
                _frame(s, src),
                src,
                {f"{c} >= 0": F.col(c) >= 0 for r in rs for c in r.columns},
                [r.table for r in rs for _ in r.columns],
            )
            for src, rs in _by_source(NON_NEGATIVE).items()
        ]
    )


def _fk_sql(r: Rule) -> str:
    on = " AND ".join(f"c.{a} = p.{b}" for a, b in zip(r.columns, r.parent_columns))
    not_null = " AND ".join(f"c.{a} IS NOT NULL" for a in r.columns)
    v = f"SELECT count(*) FROM {r.table} c WHERE {not_null} AND NOT EXISTS (SELECT 1 FROM {r.parent} p WHERE {on})"
    return _report_sql(r.table, "FOREIGN KEY", ", ".join(r.columns), v)


@register("dq_foreign_key", _union_sql([_fk_sql(r) for r in FOREIGN_KEYS]))
def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FOREIGN KEY violations: non-NULL child keys without a parent."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.relabel(quality.foreign_key(_frame(s, src), src, cols, _frame(s, parent), pcols), tables)
            for (src, cols, parent, pcols), tables in _by_check(FOREIGN_KEYS).items()
        ]
    )


@register(
    "dq_length",
    _union_sql(
        [_report_sql(r.table, "LENGTH", f"length({r.columns[0]}) <= {r.arg}",
                     f"SELECT count(*) FROM {r.table} WHERE NOT (length({r.columns[0]}) <= {r.arg})")
         for r in LENGTHS]
    ),
)
def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VARCHAR(n) violations: values longer than n characters."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.max_length(_frame(s, src), src, {r.columns[0]: r.arg for r in rs}, [r.table for r in rs])
            for src, rs in _by_source(LENGTHS).items()
        ]
    )


@register(
    "dq_numeric_range",
    _union_sql(
        [_report_sql(r.table, "NUMERIC RANGE", f"{r.columns[0]} as decimal({r.arg[0]},{r.arg[1]})",
                     f"SELECT count(*) FROM {r.table} WHERE {r.columns[0]} IS NOT NULL "
                     f"AND TRY_CAST({r.columns[0]} AS DECIMAL({r.arg[0]},{r.arg[1]})) IS NULL")
         for r in NUMERIC_TYPES]
    ),
)
def dq_numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUMERIC(p, s) violations: values that would not fit the declared type."""
    s = season(spark, sf_dir)
    return quality.union_reports(
        [
            quality.numeric_range(_frame(s, src), src, {r.columns[0]: r.arg for r in rs}, [r.table for r in rs])
            for src, rs in _by_source(NUMERIC_TYPES).items()
        ]
    )


# ---------------------------------------------------------------------------
# Generated columns, surrogate keys, corrections, deletes.


@register(
    "generated_columns",
    f"""
SELECT CAST(p.id_joueur AS BIGINT) AS id_joueur, p.buts, p.passes_decisives, p.buts_plus_passes,
       {dbl('a.npxg')} AS npxg, {dbl('a.xag')} AS xag, {dbl('a.npxg_xag')} AS npxg_xag
FROM performance p JOIN attendu a ON p.id_joueur = a.id_joueur
""",
)
def generated_columns_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored generated columns: goals + assists, npxG + xAG (recomputed at load)."""
    s = season(spark, sf_dir)
    # performance JOIN attendu USING (id): both are one-row-per-id projections
    # of the same aggregate, so the join keeps exactly its rows with an id.
    both = s.stats.filter(F.col("id_joueur").isNotNull())
    return conform(both.select("id_joueur", "buts", "passes_decisives", "buts_plus_passes", "npxg", "xag", "npxg_xag"))


@register(
    "surrogate_key",
    """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY id_joueur) AS BIGINT) AS id_performance,
       CAST(id_joueur AS BIGINT) AS id_joueur, buts
FROM performance
""",
)
def surrogate_key_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SERIAL keys 1..n for the performance rows, in player-id order."""
    s = season(spark, sf_dir)
    return conform(surrogate_key(s.performance.select("id_joueur", "buts"), ["id_joueur"], "id_performance"))


def _age_corrections(s: Season) -> DataFrame:
    """Birth years documented by the salary source for players it matched by name only."""
    linked = s.salaire_source.filter(F.col("matched_pass") == 2)
    return linked.select(
        F.col("id_joueur"),
        F.lit("annee_naissance").alias("column"),
        (F.lit(REFERENCE_YEAR) - F.col("age")).cast("string").alias("value"),
        F.lit("age given by the salary source").alias("reason"),
    )


@register(
    "apply_corrections",
    """
WITH fixes AS (
  SELECT id_joueur, max(CAST({year} - age AS VARCHAR)) AS fix
  FROM salaire_source WHERE matched_pass = 2 GROUP BY id_joueur)
SELECT CAST(j.id_joueur AS BIGINT) AS id_joueur, j.nom_joueur,
       CAST(COALESCE(CAST(f.fix AS INTEGER), j.annee_naissance) AS BIGINT) AS annee_naissance,
       j.code_position, j.id_equipe
FROM joueur j LEFT JOIN fixes f ON j.id_joueur = f.id_joueur
""",
)
def apply_corrections_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub with documented corrections applied (birth year from the external source)."""
    s = season(spark, sf_dir)
    fixed = apply_corrections(s.joueur, _age_corrections(s), "id_joueur", ["annee_naissance"], mode="override")
    return conform(fixed)


_GAPS_SQL = "CASE WHEN id_joueur % 7 = 0 THEN NULL ELSE annee_naissance END"


@register(
    "apply_corrections_fill",
    f"""
WITH fixes AS (
  SELECT id_joueur, max(CAST({{year}} - age AS VARCHAR)) AS fix
  FROM salaire_source WHERE matched_pass = 2 GROUP BY id_joueur)
SELECT CAST(j.id_joueur AS BIGINT) AS id_joueur, j.nom_joueur,
       CAST(COALESCE({_GAPS_SQL.replace("id_joueur", "j.id_joueur")}, CAST(f.fix AS INTEGER)) AS BIGINT) AS annee_naissance,
       j.code_position, j.id_equipe
FROM joueur j LEFT JOIN fixes f ON j.id_joueur = f.id_joueur
""",
)
def apply_corrections_fill_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub with gaps in the birth years: corrections fill them where one is documented, other gaps stay."""
    s = season(spark, sf_dir)
    gaps = s.joueur.withColumn("annee_naissance", F.expr(_GAPS_SQL))
    return conform(apply_corrections(gaps, _age_corrections(s), "id_joueur", ["annee_naissance"], mode="fill"))


def _duplicates(s: Season) -> DataFrame:
    """Hub rows merged into another row by consolidation (not the group's lowest id)."""
    refs = s.consolidated.select(F.col("id_joueur_reference").alias("id_joueur"))
    return s.joueur.select("id_joueur").join(refs, "id_joueur", "left_anti")


_DUPLICATES_SQL = (
    "duplicates AS (SELECT id_joueur FROM joueur j "
    "WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.id_joueur_reference = j.id_joueur))"
)


@register(
    "delete_cascade",
    f"""
WITH {_DUPLICATES_SQL}
SELECT CAST(id_joueur AS BIGINT) AS id_joueur, buts FROM performance p
WHERE NOT EXISTS (SELECT 1 FROM duplicates d WHERE d.id_joueur = p.id_joueur)
""",
)
def delete_cascade_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance rows left after deleting merged duplicate players (ON DELETE CASCADE)."""
    s = season(spark, sf_dir)
    kept = delete_cascade(s.performance.select("id_joueur", "buts"), _duplicates(s), "id_joueur", "id_joueur")
    return conform(kept)


@register(
    "delete_set_null",
    f"""
WITH {_DUPLICATES_SQL}
SELECT CAST(id_joueur_source AS BIGINT) AS id_joueur_source,
       CAST(CASE WHEN EXISTS (SELECT 1 FROM duplicates d WHERE d.id_joueur = s.id_joueur) THEN NULL
                 ELSE s.id_joueur END AS BIGINT) AS id_joueur
FROM salaire_source s
""",
)
def delete_set_null_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary links cleared where the linked player was deleted (ON DELETE SET NULL)."""
    s = season(spark, sf_dir)
    src = s.salaire_source.select("id_joueur_source", "id_joueur")
    return conform(delete_set_null(src, _duplicates(s), "id_joueur", "id_joueur"))


# ---------------------------------------------------------------------------
# Reconciliation.

_SALARY_COLUMNS = (
    "CAST(id_joueur_source AS BIGINT) AS id_joueur_source, nom_joueur, CAST(age AS BIGINT) AS age, "
    "CAST(salaire_annuel AS DOUBLE) AS salaire_annuel, note_source, CAST(id_joueur AS BIGINT) AS id_joueur"
)


@register(
    "reconcile",
    f"""
SELECT {_SALARY_COLUMNS}, CAST(matched_pass AS BIGINT) AS matched_pass,
       CAST(n_candidates AS BIGINT) AS n_candidates
FROM salaire_source
""",
)
def reconcile_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External salary rows linked to players: name + age first, then name only."""
    return conform(season(spark, sf_dir).salaire_source)


@register(
    "reconcile_summary",
    """
SELECT count(*) AS total, count(id_joueur) AS linked, count(*) - count(id_joueur) AS unlinked FROM salaire_source
""",
)
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total, linked and unlinked salary rows."""
    return conform(summary(season(spark, sf_dir).salaire_source, "id_joueur"))


@register("reconcile_unmatched", f"SELECT {_SALARY_COLUMNS} FROM salaire_source WHERE id_joueur IS NULL")
def reconcile_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary rows left unlinked, by name."""
    s = season(spark, sf_dir)
    rows = unmatched(s.salaire_source, "id_joueur", ["nom_joueur", "id_joueur_source"])
    return conform(rows.drop("matched_pass", "n_candidates"))


@register(
    "reconcile_ambiguous",
    """
SELECT CAST(id_joueur_source AS BIGINT) AS id_joueur_source, nom_joueur, CAST(matched_pass AS BIGINT) AS matched_pass,
       CAST(n_candidates AS BIGINT) AS n_candidates, CAST(id_joueur AS BIGINT) AS id_joueur
FROM salaire_source WHERE n_candidates > 1
""",
)
def reconcile_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salary rows whose winning pass had several candidate players (lowest id kept)."""
    s = season(spark, sf_dir)
    rows = ambiguous(s.salaire_source).select("id_joueur_source", "nom_joueur", "matched_pass", "n_candidates", "id_joueur")
    return conform(rows.orderBy("id_joueur_source"))


# ---------------------------------------------------------------------------
# Files: export in the delivered layout and load back.


def _taken(loaded: DataFrame, path: str) -> DataFrame:
    """The loaded rows, checkpointed; the file they came from is removed."""
    ensure_checkpoint_dir(loaded.sparkSession)
    out = loaded.checkpoint(eager=True)
    drop_path(loaded.sparkSession, path)
    return out


def _performance_file(s: Season) -> DataFrame:
    # Columns 3, 9 and 10 of the file: goals + assists, team id, team name
    # (informational: a row whose player or team is unknown is still written).
    teams = s.joueur.select("id_joueur", "id_equipe").join(s.equipe, "id_equipe", "left")
    return s.performance.join(teams, "id_joueur", "left").select(
        "*", F.col("buts_plus_passes").alias("_f3"), F.col("id_equipe").alias("_f9"), F.col("nom_equipe").alias("_f10")
    )


@register(
    "load_delimited",
    """
SELECT CAST(id_joueur AS BIGINT) AS id_joueur, CAST(buts AS BIGINT) AS buts,
       CAST(passes_decisives AS BIGINT) AS passes_decisives, CAST(buts_hors_penalties AS BIGINT) AS buts_hors_penalties,
       CAST(penalties_marques AS BIGINT) AS penalties_marques, CAST(penalties_tentes AS BIGINT) AS penalties_tentes,
       CAST(cartons_jaunes AS BIGINT) AS cartons_jaunes, CAST(cartons_rouges AS BIGINT) AS cartons_rouges
FROM performance
""",
)
def load_delimited_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Performance written as the delivered 11-column file, then loaded (8 columns kept)."""
    s = season(spark, sf_dir)
    path = scratch_path(spark, "performance_csv")
    write_delimited(_performance_file(s), path, PERFORMANCE)
    return conform(_taken(load_delimited(spark, path, PERFORMANCE), path))


@register(
    "coerce_decimal_comma",
    f"""
SELECT CAST(id_joueur AS BIGINT) AS id_joueur, {dbl('xg')} AS xg, {dbl('npxg')} AS npxg, {dbl('xag')} AS xag,
       {dbl('npxg + xag')} AS npxg_xag
FROM attendu
""",
)
def coerce_decimal_comma_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected-goals file with decimal commas and a stale total: load, coerce, recompute."""
    s = season(spark, sf_dir)
    path = scratch_path(spark, "attendu_csv")
    # The delivered total column is not trusted: write a different value there.
    delivered = s.attendu.withColumn("_f4", F.col("npxg_xag") + F.lit(1))
    write_delimited(delivered, path, ATTENDU)
    loaded = _taken(load_delimited(spark, path, ATTENDU), path)
    return conform(loaded.withColumn("npxg_xag", F.col("npxg") + F.col("xag")))


def _model_tables(s: Season, stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight tables of the model; facts are projections of ``stats`` (staged when given)."""
    st = s.stats if stats is None else stats
    return {
        "equipe": s.equipe,
        "position": s.position,
        "joueur": s.joueur,
        "temps_de_jeu": st.select("id_joueur", *TEMPS_DE_JEU),
        "performance": st.select("id_joueur", *PERFORMANCE_COLUMNS, "buts_plus_passes"),
        "attendu": st.select("id_joueur", *ATTENDU_COLUMNS, "npxg_xag"),
        "progression": st.select("id_joueur", *PROGRESSION),
        "salaire_source": s.salaire_source,
    }


def load_season(spark: SparkSession, s: Season, root: str) -> dict[str, str]:
    """Write the model under ``root`` (TRUNCATE + load); returns the table paths.

    The four fact tables are written from one fact aggregate, so
    ``lineitem`` is aggregated once per load, not once per fact: the
    season's persisted aggregate, or a staged copy when it is not persisted.
    """
    staged = None
    if not s.keep:
        staged = scratch_path(spark, "staging_stats")
        s.stats.write.parquet(staged)
    try:
        return reload_tables(_model_tables(s, spark.read.parquet(staged) if staged else None), root, LOAD_ORDER)
    finally:
        if staged:
            drop_path(spark, staged)


def _content(table: str, df: DataFrame) -> DataFrame:
    """Row count and an order-free content hash of a stored table."""
    h = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("nombre_lignes"), h.alias("contenu")).select(F.lit(table).alias("table_name"), "*")


_COUNTS_SQL = _union_sql([f"SELECT '{t}' AS table_name, count(*) AS nombre_lignes FROM {t}" for t in LOAD_ORDER])


@register("table_counts", _COUNTS_SQL)
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of the model, the post-import check (one union of counts)."""
    s = season(spark, sf_dir)
    tables = _model_tables(s)
    counts = [
        tables[t].agg(F.count(F.lit(1)).alias("nombre_lignes")).select(F.lit(t).alias("table_name"), "nombre_lignes")
        for t in LOAD_ORDER
    ]
    return reduce(DataFrame.unionByName, counts)


@register("reload_idempotent", _COUNTS_SQL)
def reload_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every table twice (overwrite, dimensions first): what is stored, and only if both loads left the same content."""
    s = season(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    root = scratch_path(spark, "season")
    first, second = (
        reduce(DataFrame.unionByName, [_content(t, df) for t, df in read_tables(spark, load_season(spark, s, root)).items()])
        .checkpoint(eager=True)
        for _ in range(2)
    )
    drop_path(spark, root)
    return second.join(first, ["table_name", "nombre_lignes", "contenu"], "left_semi").drop("contenu")


@register("export_results", f"SELECT e.nom_equipe, {big('SUM(p.buts)')} AS total_buts FROM equipe e "
          "JOIN joueur j ON e.id_equipe = j.id_equipe JOIN performance p ON j.id_joueur = p.id_joueur "
          "GROUP BY e.nom_equipe ORDER BY SUM(p.buts) DESC NULLS FIRST, e.nom_equipe")
def export_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result (team goals) exported to delimited files in its order and read back in it."""
    from touchline.plans.raw import q01

    layout = [Field("nom_equipe", "nom_equipe"), Field("total_buts", "total_buts", "bigint")]
    path = scratch_path(spark, "export_q01")
    write_ordered(q01(spark, sf_dir), path, layout, [desc("total_buts"), asc("nom_equipe")])
    return _taken(read_ordered(spark, path, layout), path)


@register(
    "insertion_key",
    f"""
SELECT CAST(row_number() OVER (ORDER BY nom_joueur, id_joueur) AS BIGINT) AS cle, {big('id_joueur')} AS id_joueur, nom_joueur
FROM joueur
""",
)
def insertion_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players written by name over several files, then loaded with serial keys: the key is the line's place in the files."""
    s = season(spark, sf_dir)
    path = scratch_path(spark, "joueur_csv")
    write_delimited(s.joueur.orderBy(asc("nom_joueur"), asc("id_joueur")), path, JOUEUR)
    rows = load_numbered(spark, path, JOUEUR, "cle").select("cle", "id_joueur", "nom_joueur")
    return conform(_taken(rows, path))


@register(
    "load_quoted",
    f"""
SELECT {big('id_joueur')} AS id_joueur,
       nom_joueur || CASE WHEN id_joueur % 3 = 0 THEN chr(10) || '"' || nom_joueur || '"; ' || code_position ELSE '' END
       || CASE WHEN id_joueur % 7 = 0 THEN repeat(chr(10) || 'line', 5) ELSE '' END AS note
FROM joueur
""",
)
def load_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players with notes that hold line breaks, quotes and separators: written quoted, loaded by as many tasks as the files have splits."""
    s = season(spark, sf_dir)
    path = scratch_path(spark, "notes_csv")
    layout = [Field("ID", "id_joueur", "bigint"), Field("Note", "note")]
    name, mark = F.col("nom_joueur"), F.col("id_joueur")
    quoted = F.when(mark % 3 == 0, F.concat(F.lit('\n"'), name, F.lit('"; '), F.col("code_position"))).otherwise(F.lit(""))
    lines = F.when(mark % 7 == 0, F.lit("\nline" * 5)).otherwise(F.lit(""))
    write_delimited(s.joueur.select("id_joueur", F.concat(name, quoted, lines).alias("note")), path, layout)
    return conform(_taken(load_delimited(spark, path, layout, multi_line="split"), path))


#: One id in ten has a value that is no number in the file of ``load_errors``.
BROKEN = 10


@register(
    "load_errors",
    _union_sql([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE id_joueur % {n} = 0) AS failures, count(*) AS loaded FROM attendu" for c, n in (("xg", BROKEN), ("npxg", 2 * BROKEN))])
    + " UNION ALL SELECT c, 0, (SELECT count(*) FROM attendu) FROM (VALUES ('id_joueur'), ('xag')) AS t(c)",
)
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected goals with broken numbers: rows loaded and fields that did not cast, from the one read that loads them."""
    s = season(spark, sf_dir)
    path, table = scratch_path(spark, "attendu_csv"), scratch_path(spark, "attendu")
    bad = lambda c, n: F.when(F.col("id_joueur") % n == 0, F.lit("n/a")).otherwise(F.replace(F.col(c).cast("string"), F.lit("."), F.lit(",")))
    delivered = s.attendu.withColumns({"xg": bad("xg", BROKEN), "npxg": bad("npxg", 2 * BROKEN)})
    write_delimited(delivered, path, ATTENDU)
    rows, seen = load_counted(spark, path, ATTENDU)
    rows.write.parquet(table)
    counts = seen.get
    stored = spark.read.parquet(table).agg(F.count(F.lit(1)).alias("loaded"))
    names = [f.column for f in ATTENDU if f.column and f.type != "string"]
    told = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(counts[c]).cast("long").alias("failures")) for c in names])
    return stored.select(F.explode(told).alias("t"), "loaded").select("t.column_name", "t.failures", "loaded")


# ---------------------------------------------------------------------------
# Smoke and document checks.


@register("preview", "SELECT * REPLACE (CAST(annee_naissance AS BIGINT) AS annee_naissance) FROM joueur ORDER BY id_joueur LIMIT 10")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hub rows, the first by id."""
    return conform(top_k(season(spark, sf_dir).joueur, [asc("id_joueur")], 10))


@register(
    "simple_join",
    "SELECT nom_joueur, nom_equipe FROM joueur JOIN equipe USING (id_equipe) ORDER BY id_joueur LIMIT 10",
)
def simple_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten players with their team name, the first by id."""
    s = season(spark, sf_dir)
    df = s.joueur.join(s.equipe, "id_equipe").select("id_joueur", "nom_joueur", "nom_equipe")
    return top_k(df, [asc("id_joueur")], 10).drop("id_joueur")


@register(
    "perf_join",
    """
SELECT j.nom_joueur, e.nom_equipe, CAST(p.buts AS BIGINT) AS buts, CAST(p.passes_decisives AS BIGINT) AS passes_decisives
FROM joueur j JOIN equipe e ON j.id_equipe = e.id_equipe JOIN performance p ON j.id_joueur = p.id_joueur
ORDER BY p.buts DESC, j.id_joueur LIMIT 10
""",
)
def perf_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 scorers with assists."""
    s = season(spark, sf_dir)
    df = s.players().select("id_joueur", "nom_joueur", "nom_equipe", "buts", "passes_decisives")
    return conform(top_k(df, [desc("buts")], 10, tie=["id_joueur"]).drop("id_joueur"))


@register(
    "top_k",
    """
SELECT j.nom_joueur, e.nom_equipe, CAST(t.minutes_jouees AS DOUBLE) AS minutes_jouees
FROM joueur j JOIN equipe e ON j.id_equipe = e.id_equipe JOIN temps_de_jeu t ON j.id_joueur = t.id_joueur
ORDER BY t.minutes_jouees DESC, j.id_joueur LIMIT 10
""",
)
def top_k_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 players by minutes played."""
    s = season(spark, sf_dir)
    df = s.players().select("id_joueur", "nom_joueur", "nom_equipe", "minutes_jouees")
    return conform(top_k(df, [desc("minutes_jouees")], 10, tie=["id_joueur"]).drop("id_joueur"))


@register(
    "share_of_total",
    f"""
SELECT e.nom_equipe, count(*) AS nombre_joueurs,
       {dbl(sratio('count(*)', 'SUM(count(*)) OVER ()', percent=True))} AS pourcentage_total
FROM joueur j JOIN equipe e ON j.id_equipe = e.id_equipe GROUP BY e.nom_equipe
""",
)
def share_of_total_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players per team and their share of all players."""
    s = season(spark, sf_dir)
    grouped = s.joueur.join(s.equipe, "id_equipe").groupBy("nom_equipe").agg(F.count(F.lit(1)).alias("nombre_joueurs"))
    return conform(share_of_total(grouped, "nombre_joueurs", "pourcentage_total").orderBy(desc("nombre_joueurs"), asc("nom_equipe")))


_HUB_SQL = ("CAST(id_joueur AS BIGINT) AS id_joueur, nom_joueur, CAST(annee_naissance AS BIGINT) AS annee_naissance, "
            "code_position, id_equipe")


@register(
    "missing_dim",
    f"""
SELECT 'equipe' AS dimension_manquante, {_HUB_SQL} FROM joueur WHERE id_equipe IS NULL
UNION ALL
SELECT 'position', {_HUB_SQL} FROM joueur WHERE code_position IS NULL
""",
)
def missing_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players without a team / without a position."""
    hub = season(spark, sf_dir).joueur
    team = hub.filter(F.col("id_equipe").isNull()).select(F.lit("equipe").alias("dimension_manquante"), "*")
    pos = hub.filter(F.col("code_position").isNull()).select(F.lit("position").alias("dimension_manquante"), "*")
    return conform(team.unionByName(pos))


@register(
    "missing_facts",
    f"""
SELECT 'performance' AS fait_manquant, {_HUB_SQL} FROM joueur j
WHERE NOT EXISTS (SELECT 1 FROM performance p WHERE p.id_joueur = j.id_joueur)
UNION ALL
SELECT 'temps_de_jeu', {_HUB_SQL} FROM joueur j
WHERE NOT EXISTS (SELECT 1 FROM temps_de_jeu t WHERE t.id_joueur = j.id_joueur)
""",
)
def missing_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players without performance / without playing-time rows (anti joins)."""
    s = season(spark, sf_dir)
    hub = s.joueur
    # Both fact tables are projections of one aggregate: one anti join, two labels.
    without = hub.join(s.stats.select("id_joueur"), "id_joueur", "left_anti")
    labels = F.explode(F.array(F.lit("performance"), F.lit("temps_de_jeu")))
    return conform(without.select(labels.alias("fait_manquant"), *hub.columns))


@register(
    "duplicate_names",
    "SELECT nom_joueur, count(*) AS nombre_occurrences FROM joueur GROUP BY nom_joueur HAVING count(*) > 1",
)
def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that occur more than once, most frequent first."""
    hub = season(spark, sf_dir).joueur
    out = hub.groupBy("nom_joueur").agg(F.count(F.lit(1)).alias("nombre_occurrences")).filter(
        F.col("nombre_occurrences") > 1
    )
    return out.orderBy(desc("nombre_occurrences"), asc("nom_joueur"))


