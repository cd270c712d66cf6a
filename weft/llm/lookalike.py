"""One consistent form for text that looks the same but differs in its characters.

Method: after invisible characters, blanks and compatibility variants are settled, every word gets its
resolved script set, the intersection of the script sets of its letters (digits, marks and signs belong
to every script). An empty intersection is a mixed-script word; the scripts that occur in it are tried
as spellings, each foreign letter being replaced by its look-alike of that script, and the script that
spells the whole word with the fewest replacements wins. A word of one script only whose letters all
have look-alikes in the script of the rest of the value is reported as a whole-script confusable; being
wholly in one alphabet it is in order and keeps its spelling unless ``respell_whole`` is set.

Only values with a character outside printable ASCII reach Python; all others are in order already.

Defined results
    * null stays null and is in order; the empty text is in order;
    * runs of U+0020 and upper case are kept; a blank at either end is kept;
    * a letter without a look-alike in the winning script is kept, and the word stays marked;
    * very long values are processed whole; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import ship

# Letters of Greek and Cyrillic that look like Latin ones.
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
}
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "Ӏ": "I",
    "а": "a", "в": "b", "г": "r", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ү": "y", "ӏ": "l", "ѵ": "v", "ь": "b", "п": "n", "и": "u",
}

SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Devanagari", "Bengali", "Tamil", "Telugu", "Thai", "Georgian", "Ethiopic", "Cherokee", "Coptic", "Han", "Hiragana", "Katakana", "Bopomofo", "Hangul")
#: writing systems that use several scripts in one word
COMBINED = {"Han": ("Japanese", "Korean", "Bopomofo+"), "Hiragana": ("Japanese",), "Katakana": ("Japanese",), "Hangul": ("Korean",), "Bopomofo": ("Bopomofo+",)}
EVERY = frozenset({"*"})

_SCRIPT_RE = {s: regex.compile(rf"\p{{Script_Extensions={s}}}") for s in SCRIPTS}
_PLAIN = regex.compile(r"[\x20-\x7e]*")
_UNSEEN = regex.compile(r"[\p{DI}\p{Cf}\p{Cc}--[\s]]", regex.V1)
_BLANK = regex.compile(r"[\s⠀--[ ]]", regex.V1)
_LOOSE = regex.compile(r"[\p{M}&&\p{Script=Inherited}]", regex.V1)
_HYPHEN = "\u2010"  # what NFKC makes of the non-breaking hyphen; written as the ordinary one
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


@lru_cache(20_000)
def script_set(ch: str) -> frozenset[str]:
    """The scripts a character can stand in; ``EVERY`` for what belongs to all of them."""
    if not ch.isalpha():
        return EVERY
    found = {s for s in SCRIPTS if _SCRIPT_RE[s].match(ch)}
    for s in list(found):
        found.update(COMBINED.get(s, ()))
    if found:
        return frozenset(found)
    return EVERY if regex.match(r"[\p{Script=Common}\p{Script=Inherited}]", ch) else frozenset({unicodedata.name(ch, "?").split(" ")[0]})


def resolved(word: str) -> frozenset[str]:
    """Intersection of the script sets of a word: EVERY, some scripts, or empty (mixed)."""
    out = EVERY
    for ch in word:
        s = script_set(ch)
        if s is not EVERY:
            out = s if out is EVERY else out & s
    return out


def _tables() -> dict[tuple[str, str], dict[str, str]]:
    back: dict[tuple[str, str], dict[str, str]] = {("Greek", "Latin"): GREEK, ("Cyrillic", "Latin"): CYRILLIC}
    for name in ("Greek", "Cyrillic"):
        into: dict[str, str] = {}
        for foreign, latin in back[name, "Latin"].items():
            into.setdefault(latin, foreign)
        back["Latin", name] = into
    for a, b in (("Greek", "Cyrillic"), ("Cyrillic", "Greek")):
        back[a, b] = {x: back["Latin", b][y] for x, y in back[a, "Latin"].items() if y in back["Latin", b]}
    return back


LOOKS = _tables()


def respelled(word: str, script: str) -> tuple[str, int, bool]:
    """The word in one script: spelling, letters replaced, whether every letter could be replaced."""
    out, changed, whole = [], 0, True
    for ch in word:
        s = script_set(ch)
        if s is EVERY or script in s:
            out.append(ch)
            continue
        twin = next((LOOKS[f, script][ch] for f in sorted(s) if ch in LOOKS.get((f, script), ())), None)
        changed, whole = changed + (twin is not None), whole and twin is not None
        out.append(twin or ch)
    return "".join(out), changed, whole


@lru_cache(50_000)
def consistent_word(word: str) -> tuple[str, bool]:
    """Spelling in the script that fits best, and whether the word was mixed."""
    if resolved(word):
        return word, False
    present = sorted({s for ch in word for s in script_set(ch) if script_set(ch) is not EVERY})
    tries = [(respelled(word, s), s) for s in present]
    (best, _, _), _ = min(tries, key=lambda x: (not x[0][2], sum(x[1] not in script_set(ch) for ch in word if script_set(ch) is not EVERY), x[1] != "Latin", x[1]))
    return best, True


def settle(value: str, respell_whole: bool = False) -> tuple[str, list[str], bool]:
    """One value: its consistent form, what was wrong with it, whether it holds a whole-script confusable.

    Faults: unseen, blank, variant, loose_accent, mixed_script.
    """
    if _PLAIN.fullmatch(value):
        return value, [], False
    faults = set()
    for ch in set(value):
        if ord(ch) < 127 and ch >= " ":
            continue
        if _BLANK.match(ch):
            faults.add("blank")
        elif _UNSEEN.match(ch):
            faults.add("unseen")
        elif _LOOSE.match(ch):
            faults.add("loose_accent")
        elif ch == _HYPHEN or unicodedata.normalize("NFKC", ch) != ch:
            faults.add("variant")
    text = unicodedata.normalize("NFKC", _UNSEEN.sub("", _BLANK.sub(" ", value)))
    text = _UNSEEN.sub("", _BLANK.sub(" ", text)).replace(_HYPHEN, "-")
    mixed = False

    def one(m: regex.Match) -> str:
        nonlocal mixed
        form, was_mixed = consistent_word(m[0])
        mixed |= was_mixed
        return form

    text = _WORD.sub(one, text)
    if mixed:
        faults.add("mixed_script")
    words = [w for w in _WORD.findall(text) if resolved(w) is not EVERY]
    scripts = [next((s for s in ("Latin", "Greek", "Cyrillic") if s in resolved(w)), None) for w in words]
    whole = False
    for w, s in zip(words, scripts):
        others = {x for x, v in zip(scripts, words) if v != w and x and x != s}
        for target in sorted(others):
            spelling, changed, full = respelled(w, target)
            if s and changed and full and scripts.count(target) > scripts.count(s):
                whole = True
                if respell_whole:
                    text = regex.sub(rf"(?<![\p{{L}}\p{{M}}\p{{N}}]){regex.escape(w)}(?![\p{{L}}\p{{M}}\p{{N}}])", spelling, text)
    return unicodedata.normalize("NFC", text), sorted(faults), whole


def consistent_forms(df: DataFrame, key: str, fields: Sequence[str], *, respell_whole: bool = False) -> DataFrame:
    """key, field, value, form, faults, whole_script for every non-null value of the fields."""
    ship(df.sparkSession)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    values = df.select(F.col(key), pairs.alias("_weft_v")).select(key, "_weft_v.field", "_weft_v.value").where(F.col("value").isNotNull())

    @F.pandas_udf("form string, faults array<string>, whole_script boolean")
    def settled(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in values:
            known = {v: settle(v, respell_whole) for v in s.dropna().unique()}
            rows = [known.get(v) if v is not None else None for v in s]
            yield pd.DataFrame({"form": [r and r[0] for r in rows], "faults": [r and r[1] for r in rows], "whole_script": [r[2] if r else None for r in rows]})

    odd = values.where(F.col("value").rlike(r"[^\x20-\x7e]")).withColumn("_weft_s", settled("value")).select(key, "field", "value", "_weft_s.*")
    plain = values.where(~F.col("value").rlike(r"[^\x20-\x7e]")).select(key, "field", "value", F.col("value").alias("form"), F.array().cast("array<string>").alias("faults"), F.lit(False).alias("whole_script"))
    return odd.unionByName(plain)


def inconsistent_values(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """key, field of the values that were not in their consistent form."""
    return consistent_forms(df, key, fields).where(F.size("faults") > 0).select(key, "field").distinct()
