"""Closeness of two texts by matching blocks: no SQL function has it, so distinct values at a time in Arrow batches."""

from __future__ import annotations

from difflib import SequenceMatcher, get_close_matches

import pandas as pd
from pyspark.sql.types import DoubleType, StringType
from pyspark.sql import functions as F

# Section titles and their types in article XML.
SECTION_TITLES = {
    "Cases": "cases",
    "Case Reports": "cases",
    "Conclusions": "conclusions",
    "Comment": "conclusions",
    "Discussion": "discussion",
    "Interpretation": "discussion",
    "Introduction": "intro",
    "Synopsis": "intro",
    "Materials": "materials",
    "Methods": "methods",
    "Methodology": "methods",
    "Procedures": "methods",
    "Results": "results",
    "Statement of Findings": "results",
    "Subjects": "subjects",
    "Participants": "subjects",
    "Patients": "subjects",
    "Supplementary materials": "supplementary-material",
}


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all characters, 1 for equal texts; null where either is null.

    Pairs that a batch has several times are compared once.
    """
    pairs = list(zip(a, b, strict=True))
    known = {(x, y): 1.0 if x == y else SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in set(pairs) if x is not None and y is not None}
    return pd.Series([known.get(p) for p in pairs], dtype="float64")


def type_of(title: str, cutoff: float = 0.6) -> str:
    """Types of the parts of a title (between " and "), joined by |: each that of the closest known title, none below the cutoff."""
    closest = [get_close_matches(part, SECTION_TITLES, n=1, cutoff=cutoff) for part in title.split(" and ")]
    return "|".join(SECTION_TITLES[found[0]] for found in closest if found)


@F.pandas_udf(StringType())
def section_type(title: pd.Series) -> pd.Series:
    """type_of each distinct title; null for null."""
    return title.map({t: type_of(t) for t in title.dropna().unique()})


@F.pandas_udf(StringType())
def closest_name(word: pd.Series, words: pd.Series) -> pd.Series:
    """Of an array of names the one that equals word, else the first that differs from it by case only; null without one.

    Names of another length don't count; of several, the closest by matching blocks comes first, then array order.
    """

    def pick(w: str, names: list[str]) -> str | None:
        if w in names:
            return w
        as_long = [n for n in names if len(n) == len(w)]
        return next((n for n in [*get_close_matches(w, as_long), *as_long] if n.upper() == w.upper()), None)

    return pd.Series([None if w is None or n is None else pick(w, list(n)) for w, n in zip(word, words, strict=True)], dtype="object")
