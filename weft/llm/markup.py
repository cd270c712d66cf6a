"""Running text of wiki markup, without losing the numbering of its paragraphs."""

from __future__ import annotations

import re

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REF = re.compile(r"<ref\b[^<>]*?/>|<ref\b[^<>]*>.*?</ref\s*>", re.S | re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_PARAMETER = re.compile(r"\{\{\{[^{}]*\}\}\}")
_TEMPLATE = re.compile(r"\{\{[^{}]*\}\}")
_TABLE = re.compile(r"\{\|.*?(?:\n\|\}|\Z)", re.S)
_NAMESPACED = re.compile(r"\[\[[^\[\]|:]*:[^\[\]]*\]\]")
_LABELLED = re.compile(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]")
_LINK = re.compile(r"\[\[([^\[\]|]*)\]\]")
_URL_LABELLED = re.compile(r"\[https?://\S+ ?([^\]]*)\]")
_URL = re.compile(r"https?://\S+")
_ENTITY = re.compile(r"&(?:#\w+|\w+);")
_QUOTES = re.compile(r"'{2,}")
#: lines of lists, headings, tables, template remains and redirects
_ASIDE = re.compile(r"^[ \t]*(?:[*#:;=|!]|\{\||\{\{|\}\}).*$", re.M)


#: stands for a pair of line feeds, so that removing a line can't make one
_BREAK = "\x1e"


def _gap(m: re.Match) -> str:
    return " " + _BREAK * m[0].count(_BREAK) + " "


def paragraphs(text: str) -> list[str]:
    """The running text of each piece between pairs of line feeds, in their order; pieces of markup are blank."""
    return _stripped(text.replace(_BREAK, " ").replace("\n\n", f"\n{_BREAK}\n"), True).split(_BREAK)


def running_text(text: str, lines: bool = True) -> str:
    """The text without markup. ``lines=False`` keeps the lines of lists and headings."""
    return _stripped(text, lines)


def _stripped(text: str, lines: bool) -> str:
    if "<" in text:
        if "<!--" in text:
            text = _COMMENT.sub(_gap, text)
        text = _TAG.sub(" ", _REF.sub(_gap, text))
    if "{{" in text:
        if "{{{" in text:
            text = _PARAMETER.sub(" ", text)
        while True:
            text, n = _TEMPLATE.subn(_gap, text)
            if not n:
                break
    if "{|" in text:
        text = _TABLE.sub(_gap, text)
    if "[" in text:
        text = _LINK.sub(r"\1", _LABELLED.sub(r"\1", _NAMESPACED.sub(" ", text)))
        if "[http" in text:
            text = _URL_LABELLED.sub(r"\1", text)
    if "://" in text:
        text = _URL.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(" ", text)
    if "''" in text:
        text = _QUOTES.sub("", text)
    return _ASIDE.sub(" ", text) if lines else text
