"""Functions that need Unicode tables Spark has no expression for, as Arrow UDFs."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.text import ADDRESS_WORDS, AUDIT_LEGAL_WORDS

_NON_WORD, _TOKEN, _DIGITS = re.compile(r"[^\w]+"), re.compile(r"[^\W_]+"), re.compile(r"\d+")


def audit_normal(value: str) -> str:
    """NFKD, case folded, '&' as 'and', everything that is no word character a blank; marks split words."""
    text = unicodedata.normalize("NFKD", value).casefold().replace("&", " and ")
    return " ".join(_NON_WORD.sub(" ", text).split())


def sample_normal(value: str, address: bool) -> str:
    """NFKD, case folded, marks dropped, tokens of letters and digits; legal words dropped or address words shortened."""
    text = unicodedata.normalize("NFKD", value).casefold()
    tokens = _TOKEN.findall("".join(c for c in text if not unicodedata.combining(c)).replace("&", " and "))
    if address:
        return " ".join(ADDRESS_WORDS.get(t, t) for t in tokens)
    return " ".join(t for t in tokens if t not in AUDIT_LEGAL_WORDS)


def _each(f):
    def over(s: pd.Series) -> pd.Series:
        known = {v: f(v) for v in s.dropna().unique()}
        return pd.Series([None if v is None else known.get(v) for v in s], dtype=object)

    return over


@F.pandas_udf(T.StringType())
def audit_normalized(s: pd.Series) -> pd.Series:
    return _each(audit_normal)(s)


@F.pandas_udf(T.StringType())
def sample_name(s: pd.Series) -> pd.Series:
    return _each(lambda v: sample_normal(v, False))(s)


@F.pandas_udf(T.StringType())
def sample_address(s: pd.Series) -> pd.Series:
    return _each(lambda v: sample_normal(v, True))(s)


@F.pandas_udf(T.StringType())
def case_folded(s: pd.Series) -> pd.Series:
    return _each(str.casefold)(s)


@F.pandas_udf(T.ArrayType(T.StringType()))
def unicode_numbers(s: pd.Series) -> pd.Series:
    """Distinct runs of digits of any script."""
    return _each(lambda v: sorted(set(_DIGITS.findall(v))))(s)


@F.pandas_udf(T.DoubleType())
def gestalt_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching blocks found recursively from the longest; not symmetric."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")
