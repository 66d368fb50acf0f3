"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and what each folds to.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüýÿñç"
FOLDED = "aaaaaaeeeeiiiiooooouuuuyync"


def fold_accents(text: Column) -> Column:
    """Lower case without accents; ß as ss."""
    return F.translate(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), ACCENTED, FOLDED)


def normalize_text(text: Column) -> Column:
    """Accents folded, lower case, every run of other than letters, digits and underscore one space, trimmed."""
    return F.trim(F.regexp_replace(fold_accents(text), r"[^\p{L}\p{N}_]+", " "))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def words(text: Column) -> Column:
    """Distinct words between spaces; none for an empty or null text."""
    return F.filter(F.array_distinct(F.split(F.coalesce(text, F.lit("")), " ")), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    """Shared words over all words of two texts; 0 if neither has any."""
    return overlap(words(a), words(b))


def overlap(x: Column, y: Column) -> Column:
    """Shared words over all words of two lists of distinct words; 0 if neither has any."""
    shared = F.size(F.array_intersect(x, y))
    return F.coalesce(F.try_divide(shared, F.size(x) + F.size(y) - shared), F.lit(0.0))


def percent(ratio: Column) -> Column:
    return F.format_string("%.2f%%", ratio * 100)


def leading_number(text: Column) -> Column:
    """The number that a reference begins with, or the first between > and <; '' if there is none."""
    first = F.regexp_extract(text, r"^\s*(\d+)", 1)
    return F.when(first != "", first).otherwise(F.regexp_extract(text, r">\s*(\d+)\s*<?", 1))


def fix_prefix(text: Column) -> Column:
    """Attributes w:name="..." as w-name="...", which XML parsers take without a namespace."""
    return F.regexp_replace(text, r'\bw:([a-z]+)="', 'w-$1="')


def clean_citation(text: Column) -> Column:
    """A citation without comments, font and br tags, with single spaces."""
    bare = F.regexp_replace(text, r"(?is)<!--.*?-->|<\s*/?\s*(?:font|br|span|p|small|o:p)\b[^>]*>", " ")
    return collapse_space(F.regexp_replace(bare, r"\bw:st", "w-st"))


def alnum_words(text: Column) -> Column:
    """Each word with letters and digits only; words left empty go."""
    kept = F.transform(F.split(text, r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]", ""))
    return F.filter(kept, lambda w: w != "")


def join_texts(texts: Column) -> Column:
    return F.array_join(F.filter(F.transform(texts, lambda t: F.trim(t)), lambda t: t != ""), " ")


def stem_and_extension(path: Column) -> Column:
    """(stem, ext) of a file name: stem without its last two extensions, ext the last one."""
    name = F.regexp_extract(path, r"([^/\\]*)$", 1)
    stem = F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), r"(?<=.)\.[^.]*$", "")
    return F.struct(stem.alias("stem"), F.regexp_extract(name, r"(\.[^.]*)$", 1).alias("ext"))


def name_and_languages(filename: Column, default: str = "pt") -> Column:
    """(name, lang) of `name.lang.ext`; the default language where the name has none."""
    parts = F.split(filename, r"\.")
    return F.struct(F.get(parts, F.lit(0)).alias("name"), F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).otherwise(default).alias("lang"))


def remove_texts(text: Column, unwanted: list[str]) -> Column:
    """text without any of the unwanted substrings, in order, in lower case and trimmed."""
    for x in unwanted:
        text = F.replace(text, F.lit(x), F.lit(""))
    return F.lower(F.trim(text))


def is_footnote_label(text: Column) -> Column:
    """Begins with a digit or with no letter at all, or is one lower-case letter."""
    return F.coalesce(text.rlike(r"^[\d]|^[^\p{L}\p{N}]|^\p{Ll}$"), F.lit(False))


def first_two_words_match(label: Column, text: Column) -> Column:
    """Both begin with the same words, up to two, each compared on the shorter of both."""
    a, b = F.slice(alnum_words(F.lower(label)), 1, 2), F.slice(alnum_words(F.lower(text)), 1, 2)
    n = F.least(F.size(a), F.size(b))
    same = F.forall(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x.startswith(y) | y.startswith(x)), lambda ok: ok)
    return (n > 0) & same
