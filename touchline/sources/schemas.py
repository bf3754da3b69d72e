"""Typed table definitions of the season model (the DDL as StructTypes).

Ids are BIGINT; counts produced by aggregation are BIGINT; decimals keep an
exact scale of 2.  Constraints that a file format cannot enforce (keys,
CHECK, foreign keys, lengths) are data-quality jobs in
``touchline.operators.quality``; generated columns are derived at load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


L, I, S = T.LongType(), T.IntegerType(), T.StringType()
SUM2 = T.DecimalType(28, 2)  # sums of DECIMAL(18,2) amounts, not narrowed

EQUIPE = _s(("id_equipe", S, True), ("nom_equipe", S, True))
POSITION = _s(("code_position", S, True), ("libelle_position", S, True))
JOUEUR = _s(
    ("id_joueur", L, True),
    ("nom_joueur", S, True),
    ("annee_naissance", I, True),
    ("code_position", S, True),
    ("id_equipe", S, True),
)
TEMPS_DE_JEU = _s(
    ("id_joueur", L, True),
    ("matchs_joues", L, False),
    ("matchs_titulaires", L, False),
    ("minutes_jouees", SUM2, True),
    ("matchs_90", T.DecimalType(30, 2), True),
)
PERFORMANCE = _s(
    ("id_joueur", L, True),
    ("buts", L, False),
    ("passes_decisives", L, False),
    ("buts_hors_penalties", L, False),
    ("penalties_marques", L, False),
    ("penalties_tentes", L, False),
    ("cartons_jaunes", L, False),
    ("cartons_rouges", L, False),
    ("buts_plus_passes", L, False),
)
ATTENDU = _s(("id_joueur", L, True), ("xg", SUM2, True), ("npxg", SUM2, True), ("xag", SUM2, True), ("npxg_xag", T.DecimalType(29, 2), True))
PROGRESSION = _s(
    ("id_joueur", L, True),
    ("progression_conduite", L, False),
    ("progression_passe", SUM2, True),
    ("progression_course", L, False),
)
SALAIRE_SOURCE = _s(
    ("id_joueur_source", L, True),
    ("nom_joueur", S, True),
    ("age", I, True),
    ("salaire_annuel", T.DecimalType(12, 2), True),
    ("note_source", S, True),
    ("id_joueur", L, True),
    ("matched_pass", I, True),
    ("n_candidates", L, True),
)

TABLES = {
    "equipe": EQUIPE,
    "position": POSITION,
    "joueur": JOUEUR,
    "temps_de_jeu": TEMPS_DE_JEU,
    "performance": PERFORMANCE,
    "attendu": ATTENDU,
    "progression": PROGRESSION,
    "salaire_source": SALAIRE_SOURCE,
}


def shape(schema: T.StructType) -> list[tuple[str, str]]:
    """(name, type) pairs, ignoring nullability."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def insert_into(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``INSERT INTO t SELECT ...``: select the table's columns by name and cast to its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
