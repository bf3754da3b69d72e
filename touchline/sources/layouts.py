"""Layouts of the season files: header text, target column, type.

Fixed values: the header line of each delivered file, in file order (the
header is not used to bind columns, only to write files in the same form).

    equipe          ID Equipe;Équipe
    position        ID;Position
    joueur          ID;Pos_Principale;ID Equipe;Joueur;Nation;Naissance
    temps_de_jeu    ID;MJ;Titulaire;Min;convertmatch 90m
    performance     ID;Buts;PD;B+PD;B-PénM;PénM;PénT;CJ;CR;ID équipe;equipe
    attendu         ID;xG;npxG;xAG;npxG+xAG
    progression     ID;PrgC;PrgP;PrgR
    salaire_source  ID joueurs;Joueur;Âge;Salaires annuels;Notes

Ids are widened to BIGINT (entity keys beyond 2^31 at scale); decimal
columns keep their declared NUMERIC(p, s).  ``performance`` carries three
columns that are read and dropped (goals + assists, team id, team name);
``attendu`` carries a file total that is dropped and recomputed.
"""

from __future__ import annotations

from touchline.sources.delimited import Field

EQUIPE = [Field("ID Equipe", "id_equipe", "int"), Field("Équipe", "nom_equipe")]

POSITION = [Field("ID", "code_position"), Field("Position", "libelle_position")]

JOUEUR = [
    Field("ID", "id_joueur", "bigint"),
    Field("Pos_Principale", "code_position"),
    Field("ID Equipe", "id_equipe", "int"),
    Field("Joueur", "nom_joueur"),
    Field("Nation", "nation"),
    Field("Naissance", "annee_naissance", "int"),
]

TEMPS_DE_JEU = [
    Field("ID", "id_joueur", "bigint"),
    Field("MJ", "matchs_joues", "int"),
    Field("Titulaire", "matchs_titulaires", "int"),
    Field("Min", "minutes_jouees", "int"),
    Field("convertmatch 90m", "matchs_90", "decimal(6,2)", decimal_comma=True),
]

PERFORMANCE = [
    Field("ID", "id_joueur", "bigint"),
    Field("Buts", "buts", "int"),
    Field("PD", "passes_decisives", "int"),
    Field("B+PD", None, "int"),
    Field("B-PénM", "buts_hors_penalties", "int"),
    Field("PénM", "penalties_marques", "int"),
    Field("PénT", "penalties_tentes", "int"),
    Field("CJ", "cartons_jaunes", "int"),
    Field("CR", "cartons_rouges", "int"),
    Field("ID équipe", None, "int"),
    Field("equipe", None),
]

ATTENDU = [
    Field("ID", "id_joueur", "bigint"),
    Field("xG", "xg", "decimal(6,2)", decimal_comma=True),
    Field("npxG", "npxg", "decimal(6,2)", decimal_comma=True),
    Field("xAG", "xag", "decimal(6,2)", decimal_comma=True),
    Field("npxG+xAG", None, "decimal(6,2)", decimal_comma=True),
]

PROGRESSION = [
    Field("ID", "id_joueur", "bigint"),
    Field("PrgC", "progression_conduite", "int"),
    Field("PrgP", "progression_passe", "bigint"),
    Field("PrgR", "progression_course", "int"),
]

SALAIRE_SOURCE = [
    Field("ID joueurs", "id_joueur_source", "bigint"),
    Field("Joueur", "nom_joueur"),
    Field("Âge", "age", "int"),
    Field("Salaires annuels", "salaire_annuel", "decimal(12,2)"),
    Field("Notes", "note_source"),
]

LAYOUTS = {
    "equipe": EQUIPE,
    "position": POSITION,
    "joueur": JOUEUR,
    "temps_de_jeu": TEMPS_DE_JEU,
    "performance": PERFORMANCE,
    "attendu": ATTENDU,
    "progression": PROGRESSION,
    "salaire_source": SALAIRE_SOURCE,
}

# Load order: dimensions before the hub, the hub before its facts.
LOAD_ORDER = ["equipe", "position", "joueur", "temps_de_jeu", "performance", "attendu", "progression", "salaire_source"]
