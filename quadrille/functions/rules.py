"""Ordered keyword rules as conditional expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import text_key

# Report categories and the keywords that assign them, in order.
REPORT_RULES = [
    ("proprete", ["proprete", "dechet", "ordure", "salissure", "epanchement"]),
    ("incivilite", ["incivilite", "tag", "graffiti", "affichage", "bruit"]),
    ("voirie", ["voirie", "trou", "potelet", "chaussee", "trottoir"]),
    ("eclairage", ["eclairage", "lampe", "feu"]),
]
REPORT_DEFAULT = "autre"

# Construction modes.
MODE_RULES = [(0, ["neuve"]), (1, ["rehabilitation"]), (2, ["conventionnement"])]

# Furnished or not.
RENTAL_CODES = {"meuble": 1, "non_meuble": 0}

# Report states that are dropped.
DROPPED_STATES = ["annule", "non_fonde", "nonfonde"]

# Severity of an incident; a rule fires when all its keywords occur.
SEVERITY_RULES = [
    (3.0, ["infest", "punaise"]),
    (2.0, ["urine", "panchement", "épanchement"]),
    (1.5, ["graffiti", "mur", "façade", "rideau"]),
    (1.5, ["déjection", "canine"]),
    (1.0, ["encombrant", "carton", "gravat"]),
    (1.3, ["graffiti"]),
]

# Weight of a public-works category.
WORKS_WEIGHTS = {
    "Espace public / Nature en ville": 2.0,
    "Écoles et crèches": 1.8,
    "Propreté": 1.5,
    "Sécurité et Prévention": 1.3,
    "Sport": 1.0,
}
WORKS_DEFAULT = 0.5

# Declaration types behind the cleanliness and incivility axes.
CLEANLINESS_TYPES = ["Propreté", "Voirie et espace public"]
INCIVILITY_TYPES = ["Objets abandonnés", "Graffitis, tags, affiches et autocollants", "Mobiliers urbains"]


def categorize(key: Column, rules: Iterable[tuple[str, list[str]]], default: str, word: bool = False) -> Column:
    """Label of the first rule with a keyword in a text key; see :func:`with_category`.

    Keywords match anywhere in the text; ``word=True`` asks for whole words.
    """
    text, edge = (F.concat(F.lit("_"), key, F.lit("_")), "_") if word else (key, "")
    labels = []
    for label, keywords in rules:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | F.contains(text, F.lit(f"{edge}{keyword}{edge}"))
        labels.append(F.when(hit, F.lit(label)))
    return F.coalesce(*labels, F.lit(default))


def with_category(
    df: DataFrame, cols: list[Column], out: Mapping[str, bool], rules=REPORT_RULES, default: str = REPORT_DEFAULT
) -> DataFrame:
    """Add category columns ``{name: whole words only}`` from the joined texts of a row.

    The key is a column of its own, so a row's text is folded once for all its rules.
    """
    keyed = df.withColumn("_key", text_key(F.concat_ws(" ", *cols)))
    return keyed.withColumns(
        {name: categorize(F.col("_key"), rules, default, word) for name, word in out.items()}
    ).drop("_key")


def encode_first(key: Column, rules: Iterable[tuple[int, list[str]]]) -> Column:
    """Code of the first rule with a keyword in the key; null when none fires."""
    return F.coalesce(*[F.when(key.rlike("|".join(words)), F.lit(code)) for code, words in rules])


def encode_exact(key: Column, codes: Mapping[str, int]) -> Column:
    return F.coalesce(*[F.when(key == value, F.lit(code)) for value, code in codes.items()])


def weight_all(col: Column, rules: Iterable[tuple[float, list[str]]], default: float = 1.0) -> Column:
    """Weight of the first rule whose keywords all occur in the lower-cased text."""
    text = F.lower(col)
    tried = []
    for weight, words in rules:
        every = F.lit(True)
        for w in words:
            every = every & F.contains(text, F.lit(w))
        tried.append(F.when(every, F.lit(weight)))
    return F.coalesce(*tried, F.lit(default))


def weight_exact(col: Column, weights: Mapping[str, float], default: float) -> Column:
    return F.coalesce(*[F.when(col == value, F.lit(w)) for value, w in weights.items()], F.lit(default))
