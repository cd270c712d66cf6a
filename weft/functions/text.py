"""Normalizers, token sets and n-gram sets as column expressions.

Everything here is built from JVM expressions. Strings are compared as UTF-8 bytes where lengths, edit
distances and n-grams are concerned (``byte_view``, ``byte_trigrams``); a trigram is written as the six
hexadecimal digits of its bytes, so that no half character ever becomes a string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal words dropped from names.
LEGAL_WORDS = ("inc", "incorporated", "corp", "corporation", "company", "co", "llc", "limited", "ltd", "private", "pvt", "plc", "llp", "sarl", "sas", "sa")
# The noise audit keeps "sa".
AUDIT_LEGAL_WORDS = tuple(w for w in LEGAL_WORDS if w != "sa")
# Abbreviations of address words.
ADDRESS_WORDS = {
    "road": "rd", "street": "st", "avenue": "ave", "boulevard": "blvd", "drive": "dr", "lane": "ln", "highway": "hwy", "suite": "ste", "apartment": "apt", "building": "bldg", "floor": "fl",
}
# Accented letters folded to a plain one, and signs read as blanks.
FOLDED = {"a": "ÀÁÂÃÄÅàáâãäå", "c": "Çç", "e": "ÈÉÊËèéêë", "i": "ÌÍÎÏìíîï", "n": "Ññ", "o": "ÒÓÔÕÖØòóôõöø", "u": "ÙÚÛÜùúûü", "y": "ÝŸýÿ", " ": "‘’–—«»"}

TRANSLATE_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(FOLDED.values())
TRANSLATE_TO = "abcdefghijklmnopqrstuvwxyz" + "".join(k * len(v) for k, v in FOLDED.items())


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, " ", -1), lambda w: w != "")


def _mapped(value: Column) -> Column:
    """ASCII to lower case, accents folded, marks dropped, other ASCII to blanks; the rest as it is."""
    text = F.translate(F.coalesce(value, F.lit("")), TRANSLATE_FROM, TRANSLATE_TO)
    text = F.regexp_replace(text, r"[\x{0300}-\x{036F}]", "")
    return F.regexp_replace(F.regexp_replace(text, "&", " and "), r"[^a-z0-9\x{80}-\x{10FFFF}]", " ")


def normalize_name(value: Column, legal: tuple[str, ...] = LEGAL_WORDS) -> Column:
    return F.array_join(F.filter(words_of(_mapped(value)), lambda w: ~w.isin(*legal)), " ")


def normalize_address(value: Column) -> Column:
    short = F.create_map(*[F.lit(x) for kv in ADDRESS_WORDS.items() for x in kv])
    return F.array_join(F.transform(words_of(_mapped(value)), lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def token_set(text: Column) -> Column:
    return F.sort_array(F.array_distinct(words_of(text)))


def byte_view(text: Column) -> Column:
    """One character per UTF-8 byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def byte_trigrams(text: Column) -> Column:
    """Distinct trigrams of the padded bytes in hexadecimal; none for the empty text."""
    digits = F.hex(F.encode(F.concat(F.lit("^^"), text, F.lit("$$")), "UTF-8"))
    last = (F.length(digits) / 2 - 2).cast("int")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(digits, i * 2 - 1, F.lit(6)))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.sort_array(F.array_distinct(grams)))


def character_trigrams(text: Column) -> Column:
    """Distinct trigrams of the padded characters; the empty text has those of its padding."""
    padded = F.concat(F.lit("^^"), text, F.lit("$$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def numeric_tokens(text: Column) -> Column:
    return F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1))))


def postal_tokens(numbers: Column) -> Column:
    return F.filter(numbers, lambda n: F.length(n).isin(5, 6))


def bounded_postal_tokens(text: Column) -> Column:
    """Word-bounded codes of five digits (with or without four more) or six."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(\d{5}(?:-\d{4})?|\d{6})\b"), F.lit(1))))


def unordered_pairs(values: Column, first: Callable[[Column], Column] | None = None) -> Column:
    """All unordered pairs of an array as 'smaller|larger'; ``first``: of a sorted array only those whose smaller value it accepts."""
    rest = lambda i: F.slice(values, i + 2, F.size(values))
    own = lambda a, i: F.transform(rest(i), lambda b: F.concat_ws("|", F.least(a, b), F.greatest(a, b)))
    return F.flatten(F.transform(values, own if first is None else lambda a, i: F.when(first(a), own(a, i)).otherwise(F.array().cast("array<string>"))))


def minhash_bands(grams: Column, bands: int = 32, rows: int = 3) -> Column:
    """One key per band of minima over seeded hashes; none for an empty set."""
    minimum = lambda seed: F.array_min(F.transform(grams, lambda g: F.xxhash64(g, F.lit(seed))))
    keys = F.array(*[F.concat_ws(":", F.lit(b), F.xxhash64(*[minimum(b * rows + r) for r in range(rows)])) for b in range(bands)])
    return F.when(F.size(grams) > 0, keys).otherwise(F.array().cast("array<string>"))


def entity_number(entity_id: Column) -> Column:
    """The number after the first '-', or the whole id where there is none; null if it is no number."""
    tail = F.when(F.instr(entity_id, "-") > 0, F.substring_index(entity_id, "-", -1)).otherwise(entity_id)
    return tail.try_cast("bigint")


def entity_source(entity_id: Column) -> Column:
    return F.substring(entity_id, 2, 1).try_cast("int")


def entity_id(source: Column, number: Column) -> Column:
    return F.concat(F.lit("S"), source.cast("string"), F.lit("-"), number.cast("string"))


def starts_with_list(ids: Column, prefix: str) -> Column:
    return F.exists(ids, lambda x: F.startswith(x, F.lit(prefix)))


def id_list(text: Column) -> Column:
    """The ids of a comma list, trimmed, without empties; empty for null."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(F.regexp_replace(x, "\r", ""))), lambda x: x != "")
