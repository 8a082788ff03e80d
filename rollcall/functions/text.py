"""Text functions: Unicode folding, canonical names, tokens. Native expressions only."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are too common in names of organisations to tell them apart.
GENERIC_WORDS = (
    "AGENCE", "AU", "AUX", "BENIN", "BUSINESS", "CHEZ", "CIE", "COMPAGNIE", "DE", "DES", "DIEU", "DU", "EN", "ET", "ETABLISSEMENT", "ETABLISSEMENTS", "ETS", "FILS", "FRERES", "GENERAL", "GENERALE",
    "GIE", "GLOBAL", "GROUP", "GROUPE", "INTER", "INTERNATIONAL", "LA", "LE", "LES", "MULTI", "MULTISERVICES", "ONG", "PLUS", "SA", "SARL", "SAS", "SERVICE", "SERVICES", "SOCIETE", "SOEURS", "STE",
)
# Linking words of activity labels.
LINKING_WORDS = (
    "achat", "vente", "exercice", "toutes", "tous", "autres", "divers", "diverses", "activites", "prestations", "dans", "pour", "avec", "sans", "liees", "connexes", "generale", "general", "detail",
    "gros", "des", "les", "aux", "une", "ses", "sur", "via",
)
MIN_TOKEN = 3


@cache
def fold_table(limit: int = 0x2100) -> tuple[str, str]:
    """Characters that decompose into one base character and marks, and their base characters, from the Unicode data."""
    source, base = [], []
    for code in range(0x80, limit):
        letters = [c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c)]
        if len(letters) == 1 and letters[0] != chr(code):
            source.append(chr(code))
            base.append(letters[0])
    return "".join(source), "".join(base)


def unaccented(text: Column) -> Column:
    source, base = fold_table()
    return F.regexp_replace(F.translate(text, source, base), r"\p{Mn}", "")


def unicode_trim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def cell_text(cell: Column) -> Column:
    """A cell's text without outer white space of any script; empty as null."""
    return F.nullif(unicode_trim(cell.cast("string")), F.lit(""))


def phone_text(cell: Column, is_numeric: Column) -> Column:
    """A phone cell's text: a numeric cell with no fraction loses its `.0`; null as empty."""
    text = F.coalesce(cell.cast("string"), F.lit(""))
    return unicode_trim(F.when(is_numeric, F.regexp_replace(text, r"^(-?\d+)\.0$", "$1")).otherwise(text))


def canonical(name: Column) -> Column:
    """Upper case, without marks, with one space for every run of anything but A-Z and 0-9; null as empty."""
    return F.trim(F.regexp_replace(F.upper(unaccented(F.coalesce(name, F.lit("")))), "[^A-Z0-9]+", " "))


def tokens_of(canonical_name: Column) -> Column:
    return F.filter(F.split(canonical_name, " "), lambda t: t != "")


def tokens(name: Column) -> Column:
    return tokens_of(canonical(name))


def core_of(token_array: Column) -> Column:
    """The tokens that tell names apart: no generic word, three characters or more, not all digits; order and repeats stay."""
    generic = F.array(*map(F.lit, GENERIC_WORDS))
    return F.filter(token_array, lambda t: ~F.array_contains(generic, t) & (F.length(t) >= MIN_TOKEN) & ~t.rlike("^[0-9]+$"))


def blocking_tokens(name: Column) -> Column:
    return core_of(tokens(name))


def fold(text: Column) -> Column:
    return unaccented(F.lower(text))


def label_tokens(text: Column) -> Column:
    """Runs of a-z in the folded text, three letters or more, without linking words."""
    linking = F.array(*map(F.lit, LINKING_WORDS))
    return F.filter(F.regexp_extract_all(fold(text), F.lit("([a-z]+)"), F.lit(1)), lambda t: (F.length(t) >= MIN_TOKEN) & ~F.array_contains(linking, t))


def place_key(name: Column) -> Column:
    """The folded name's letters and digits in upper case, for joins of place names."""
    return F.regexp_replace(unaccented(F.upper(name)), r"[^\p{L}\p{N}]", "")


def french_number(value: Column, decimals: int = 1) -> Column:
    """A number as French readers write it: thousands apart by a narrow space, a comma, no closing zeros, halves rounded up; null as null."""
    text = F.round(F.abs(value), decimals).cast(f"decimal(38,{decimals})").cast("string")
    whole = F.regexp_replace(F.split(text, r"\.")[0], r"(?<=\d)(?=(\d{3})+$)", "\u202f")
    part = F.regexp_replace(F.coalesce(F.get(F.split(text, r"\."), F.lit(1)), F.lit("")), "0+$", "")
    shown = F.when(part == "", whole).otherwise(F.concat(whole, F.lit(","), part))
    return F.when((value < 0) & (shown != "0"), F.concat(F.lit("-"), shown)).otherwise(shown)


def ordinal(rank: Column) -> Column:
    """A rank with its raised French ending."""
    return F.concat(rank.cast("string"), F.when(rank == 1, F.lit("\u02b3\u1d49")).otherwise(F.lit("\u1d49")))
