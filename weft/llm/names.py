"""Names and addresses taken apart: what identifies an organisation, what identifies a place.

All functions work on single values and are called once per distinct value, inside Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

from weft.llm.lookalike import settle

# Legal forms and what is added like one.
LEGAL = frozenset(
    "inc incorporated corp corporation company co llc limited ltd private pvt plc llp sarl sas sa gmbh ag kg ltda eirl bv nv srl oy ab as pty group holding holdings and the ад оод еоод ооо оао зао пао".split()
)
# Words that name a line of business.
LINES = frozenset(
    """academy agency apparel auto bakery bank bar books bookshop burger cafe catering centre chemicals cleaners clinic clothing college construction consulting dairy
    dental development electronics energy engineering equipment express fashion finance fitness flowers foods fuel furniture garage garden gas grill gym hardware
    hospital hotel industries insurance international jewellers kitchen laboratories laundry legal logistics manufacturing marine market mart media medical metals mining mobile motors
    opticians optics packaging parcel pharmacy photo pizza plastics plumbing point port press printing properties property public repair restaurant salon school security services
    shipping shoes shop software spa solutions sports steel stop stores studio supermarket supplies systems tailors technologies textiles theatre toys traders transport travel tyre university
    works мебели аптека транспорт строи""".split()
)
# Other spellings of such words.
LINE_TWINS = {"tire": "tyre", "tires": "tyre", "tyres": "tyre", "automobile": "auto", "automotive": "auto", "center": "centre", "jewelers": "jewellers", "jewelry": "jewellers", "jewellery": "jewellers", "labs": "laboratories", "lab": "laboratories", "store": "stores", "service": "services", "system": "systems", "food": "foods", "school": "school", "chemist": "pharmacy", "coffee": "cafe", "intl": "international", "mfg": "manufacturing", "wks": "works"}
# Short forms of given names.
NICKNAMES = {
    "sue": "susannah", "suzie": "susannah", "susan": "susannah", "susanna": "susannah", "susie": "susannah", "suzy": "susannah", "kathy": "katherine", "kate": "katherine", "katie": "katherine", "kathie": "katherine", "cathy": "katherine",
    "bob": "robert", "rob": "robert", "bobby": "robert", "robbie": "robert", "bill": "william", "will": "william", "billy": "william", "willy": "william", "mike": "michael", "mick": "michael", "mickey": "michael",
    "tom": "thomas", "tommy": "thomas", "maggie": "margaret", "meg": "margaret", "peggy": "margaret", "marge": "margaret", "greta": "margaret", "alex": "alexander", "sandy": "alexander", "al": "alexander", "sasha": "alexander",
    "ed": "edward", "eddie": "edward", "ted": "edward", "ned": "edward", "charlie": "charles", "chuck": "charles", "dick": "richard", "rick": "richard", "rich": "richard", "richie": "richard",
    "jim": "james", "jimmy": "james", "jamie": "james", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "lizzie": "elizabeth", "eliza": "elizabeth", "bess": "elizabeth", "betsy": "elizabeth", "laxmi": "lakshmi",
    "raj": "rajesh", "raju": "rajesh", "kris": "krishnan", "krish": "krishnan", "krishna": "krishnan", "krishnen": "krishnan",
    "wm": "william", "thos": "thomas", "chas": "charles", "jas": "james", "robt": "robert", "edw": "edward", "geo": "george", "joe": "joseph", "jack": "john", "johnny": "john", "dave": "david", "dan": "daniel", "steve": "stephen", "tony": "anthony", "pat": "patricia", "jenny": "jennifer", "nick": "nicholas", "andy": "andrew", "matt": "matthew", "chris": "christopher", "sam": "samuel", "ben": "benjamin",
}
GIVEN = frozenset(NICKNAMES.values())

_TOKEN = re.compile(r"[^\W_]+")
_DOTTED = re.compile(r"\b(?:[^\W\d_]\.){2,}(?:[^\W\d_]\b)?")
_APOSTROPHE = re.compile(r"(?<=[^\W\d_])['’`´](?=[^\W\d_])")
_SLASHED = re.compile(r"(?<=\b[^\W\d_])/(?=[^\W\d_]\b)")  # S/A
_PRIVATE = re.compile(r"\(?\bp\b[.)]*(?=\s+(?:limited|ltd)\b)")  # (P) Ltd
_FOLDS = str.maketrans({"ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ł": "l", "ı": "i", "ð": "d", "þ": "th"})


def plain(value: str) -> str:
    """Consistent characters, lower case, no accents."""
    if value.isascii() and value.isprintable():
        return value.lower()
    text = unicodedata.normalize("NFKD", settle(value, respell_whole=True)[0].lower())
    return "".join(c for c in text if not unicodedata.combining(c)).translate(_FOLDS)


def folded(value: str) -> str:
    """What is left when case, accents, blanks, punctuation and unseen differences are disregarded."""
    return "".join(_TOKEN.findall(plain(value)))


@lru_cache(30_000)
def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours, or ``most`` + 1 where more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    if len(a) > len(b):
        a, b = b, a
    start, end = 0, len(a)
    while start < end and a[start] == b[start]:
        start += 1
    gap = len(b) - len(a)
    while end > start and a[end - 1] == b[end + gap - 1]:
        end -= 1
    a, b = a[start:end], b[start : end + gap]
    n, m = len(a), len(b)
    if not n or most == 0:
        return min(m, most + 1)
    # letters that the longer has and the other hasn't can't be explained by swaps
    if m - sum(min(a.count(c), b.count(c)) for c in set(a)) > most:
        return most + 1
    far = most + 1
    before, row = [far] * (m + 2), [*range(min(m, most) + 1), *[far] * (m + 1 - min(m, most))]
    for i in range(1, n + 1):
        x, lo, hi = a[i - 1], max(1, i - most), min(m, i + most)
        now = [far] * (m + 2)
        if i <= most:
            now[0] = i
        low = now[0]
        swapped = a[i - 2] if i > 1 else ""
        for j in range(lo, hi + 1):
            y = b[j - 1]
            if x == y:
                v = row[j - 1]
            else:
                v = row[j - 1]
                if row[j] < v:
                    v = row[j]
                if now[j - 1] < v:
                    v = now[j - 1]
                v += 1
                if swapped == y and j > 1 and x == b[j - 2] and before[j - 2] + 1 < v:
                    v = before[j - 2] + 1
            now[j] = v
            if v < low:
                low = v
        if low > most:
            return far
        before, row = row, now
    return min(row[m], far)


def _inside(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


def _mask(word: str) -> int:
    out = 0
    for c in word:
        out |= 1 << (ord(c) & 63)
    return out


_LINES_BY_FIRST: dict[str, list[str]] = {}
_LINES_BY_LENGTH: dict[int, list[tuple[str, int]]] = {}
for _w in sorted(LINES):
    _LINES_BY_FIRST.setdefault(_w[0], []).append(_w)
    if len(_w) >= 6:
        _LINES_BY_LENGTH.setdefault(len(_w), []).append((_w, _mask(_w)))


@lru_cache(30_000)
def line_word(word: str) -> frozenset[str]:
    """The line-of-business words that a word is, abbreviates or misspells; empty for none."""
    word = LINE_TWINS.get(word, word)
    if word in LINES:
        return frozenset({word})
    stem = word[:-1] if len(word) > 3 and word.endswith("s") else word
    if len(stem) < 3:
        return frozenset()
    vowels = sum(c in "aeiou" for c in stem[1:])
    near = _LINES_BY_FIRST.get(stem[0], ())
    found = {w for w in near if len(stem) < len(w) and w.startswith(stem) and (len(stem) >= 4 or not vowels or stem[-1] not in "aeiou" and vowels == 1)}
    if vowels <= 1 and len(stem) <= 7:
        found |= {w for w in near if len(stem) <= 0.75 * len(w) and _inside(stem, w)}
    if not found and len(word) >= 5:
        letters = _mask(word)
        found = {w for n in range(len(word) - 2, len(word) + 3) for w, m in _LINES_BY_LENGTH.get(n, ()) if (letters ^ m).bit_count() <= 4 and edits(word, w, 2) <= (2 if n >= 8 else 1)}
    return frozenset(found)


class Name(NamedTuple):
    core: tuple[str, ...]  # words that are the organisation's own
    given: str  # given name or initial, "" for none
    line: tuple[frozenset[str], ...]  # for each word, the line words it can stand for
    numbers: tuple[str, ...]


@lru_cache(30_000)
def parse_name(value: str) -> Name:
    text = _DOTTED.sub(lambda m: m[0].replace(".", ""), _APOSTROPHE.sub("", plain(value)))
    text = _PRIVATE.sub(" ", _SLASHED.sub("", text))
    core, line, numbers, given = [], [], [], ""
    for w in _TOKEN.findall(text):
        if w.isdigit():
            numbers.append(w.lstrip("0") or "0")
        elif w in LEGAL or w in ("no", "nr", "num"):
            continue
        elif not given and (NICKNAMES.get(w, w) in GIVEN or len(w) == 1):
            given = NICKNAMES.get(w, w)
        elif known := line_word(w):
            line.append(known)
        else:
            core.append(w)
    if not core and line:  # a name made of common words only
        core, line = [min(x) for x in line], []
    if not core and given:
        core, given = [given], ""
    return Name(tuple(core), given, tuple(line), tuple(sorted(numbers)))


_SOUNDS = (("oo", "u"), ("ee", "i"), ("ou", "u"), ("ph", "f"), ("th", "t"), ("ck", "k"), ("w", "v"), ("y", "i"), ("z", "s"), ("c", "k"), ("q", "k"))
_TWICE = re.compile(r"(.)\1+")


def sound(word: str) -> str:
    word = word if "oo" in word or "ee" in word else _TWICE.sub(r"\1", word)
    for a, b in _SOUNDS:
        word = word.replace(a, b)
    return _TWICE.sub(r"\1", word)


@lru_cache(30_000)
def _keys_of(core: tuple[str, ...]) -> tuple[str, ...]:
    heard = [sound(w) for w in core]
    return tuple(sorted({"".join(order) for words in (list(core), heard) for order in (words, words[::-1], sorted(words))} - {""}))


def name_keys(name: Name) -> tuple[str, ...]:
    """Keys a name is compared by: its own words as they stand, reversed and in order of the alphabet, as written and as sounded."""
    return _keys_of(name.core)


def heard_keys(name: Name) -> list[str]:
    """The own words as sounded, in order and sorted."""
    heard = [sound(w) for w in name.core]
    return sorted({"".join(heard), "".join(sorted(heard))} - {""})


def bone_keys(name: Name, shortest: int = 5) -> list[str]:
    """The consonants of the own words as sounded; none where they are few."""
    bones = "".join(c for w in name.core for c in sound(w) if c not in "aeiou")
    return [bones] if len(bones) >= shortest else []


def _left_out(key: str, n: int) -> set[str]:
    """The key with up to ``n`` letters left out."""
    out = {key}
    for _ in range(n):
        out |= {k[:i] + k[i + 1 :] for k in out for i in range(len(k))}
    return out


def gate_keys(name: Name) -> list[str]:
    """Keys of which any two names that ``same_name`` accepts share one.

    An edit breaks at most q + 1 of the L - q + 1 q-grams of a key (a swap does), so with k edits one is left
    where L - q + 1 > k (q + 1): 3-grams for 7, 11 and 15 letters and 1, 2 and 3 edits. Shorter keys have,
    besides, what is left of them without as many letters, which edits and swaps can't tell apart; of 10
    letters only the swaps of the 3rd and 7th with the next break every 3-gram, and the others stay.
    """
    keys = name_keys(name)
    if not keys:
        return ["="]
    most = min(3, max(1, len(keys[0]) // 5))
    if name.given:  # may be run together with the words
        keys = sorted({*keys, *name_keys(Name((name.given, *name.core), "", (), ()))})
    out = set()
    for k in keys:
        out |= {k[i : i + 3] for i in range(max(1, len(k) - 2))}
        if len(k) <= 6:
            out |= {f"1{d}" for d in _left_out(k, 1)}
        if most >= 2 and len(k) <= 9:
            out |= {f"2{d}" for d in _left_out(k, 2)}
        if most >= 2 and len(k) == 10:
            out.add(f"={k[:2]}{k[4:6]}{k[8:]}")
        if most == 3 and len(k) <= 10:
            out |= {f"3{d}" for d in _left_out(k, 3)}
        elif most == 3 and len(k) <= 14:
            out |= {k[i : i + 2] for i in range(len(k) - 1)}
    return sorted(out)


def same_name(a: Name, b: Name, radius: int = 3, share: int = 5) -> bool:
    """Spellings of one organisation's name: same numbers, same line of business, own words alike.

    Own words may differ by ``radius`` edits, and by one in ``share`` of their letters at most.
    """
    if a.numbers and b.numbers and a.numbers != b.numbers:
        return False
    if a.line and b.line:
        short, long = sorted((a.line, b.line), key=len)
        if not all(any(x & y for y in long) for x in short):
            return False
    if a.given and b.given and a.given != b.given:
        short, long = sorted((a.given, b.given), key=len)
        if not (len(short) == 1 and long[0] == short) and edits(short, long, 2) > (2 if len(short) > 4 else 0):
            return False
    ka, kb = name_keys(a), name_keys(b)
    if not ka or not kb:
        return ka == kb
    most = min(radius, max(1, min(len(ka[0]), len(kb[0])) // share))
    if any(edits(x, y, most) <= most for x in ka for y in kb):
        return True
    # the given name run together with the words, or one of them an unknown given name
    for x, y in ((a, b), (b, a)):
        if x.given and not y.given:
            whole = name_keys(Name((x.given, *x.core), "", (), ()))
            if any(edits(p, q, most) <= most for p in whole for q in name_keys(y)):
                return True
    return False


# Words of addresses, in their usual abbreviations.
UNIT_WORDS = frozenset("suite ste shop sh unit u floor fl flr apartment apt etage etg sala bureau bur office room rm flat level wohnung офис ап ет".split())
HOUSE_WORDS = frozenset("no nr number plot num".split())
ROADS = {
    "road": "road", "rd": "road", "street": "street", "str": "street", "st": "street", "avenue": "avenue", "ave": "avenue", "av": "avenue", "aven": "avenue", "avenida": "avenue",
    "boulevard": "boulevard", "blvd": "boulevard", "boul": "boulevard", "drive": "drive", "dr": "drive", "drv": "drive", "lane": "lane", "ln": "lane", "la": "lane", "parkway": "parkway", "pkwy": "parkway", "pky": "parkway",
    "highway": "highway", "hwy": "highway", "hgwy": "highway", "rue": "rue", "r": "rua", "rua": "rua", "travessa": "travessa", "tv": "travessa", "allee": "allee", "weg": "weg", "platz": "platz", "strasse": "strasse", "place": "place", "way": "way", "court": "court", "square": "square",
    "ул": "ул", "улица": "ул", "бул": "бул", "булевард": "бул", "bd": "boulevard", "chemin": "chemin", "quai": "quai",
}
SOFT_ROADS = frozenset(("st", "r", "la", "bd", "dr", "av", "place", "way"))  # these can stand for something else
GLUED_ROADS = ("strasse", "platz", "allee", "weg")  # written in one word with the street's name
SIDES = {"n": "north", "north": "north", "s": "south", "south": "south", "e": "east", "east": "east", "w": "west", "west": "west"}
LANDMARKS = frozenset("near opp opposite behind next to beside by at the of old market industrial area estate town hall bus stand station post office water tank bridge park city centre center temple church до пазара".split())

_BRAZIL = re.compile(r"\b(\d{5})-(\d{3})\b")
_UK = re.compile(r"\b([a-z]{1,2}\d{1,2}[a-z]?) (\d[a-z]{2})\b")
_CYRILLIC = re.compile("[а-я]")
_PART = re.compile(r"[#,;]|[^\W_]+")
_DIGITS_LETTERS = re.compile(r"\d+|[^\W\d_]+")


class Place(NamedTuple):
    post: str
    houses: tuple[str, ...]
    units: tuple[str, ...]
    roads: tuple[str, ...]
    sides: tuple[str, ...]
    words: tuple[str, ...]  # street, town and region in the order given
    codes: tuple[str, ...] = ()  # words of two letters: regions


@lru_cache(30_000)
def parse_address(value: str) -> Place:
    text = " ".join(plain(value).split())
    post = ""
    for rx in (_BRAZIL, _UK):
        if m := rx.search(text):
            post = m[1] + m[2]
            text = text[: m.start()] + " , " + text[m.end() :]
            break
    parts: list[str] = []
    for p in _PART.findall(text):
        if p[0] not in "#,;" and any(c.isdigit() for c in p) and not p.isdigit() and not post:
            parts.extend(_DIGITS_LETTERS.findall(p))
        else:
            parts.append(p)
    houses, weak, units, roads, sides, words, codes = [], [], [], [], [], [], []
    before = last = ""  # what a coming number would be: u unit, h house, # either
    for p in parts:
        last, previous = p, last
        if p in ",;":
            before = ""
        elif p == "#":
            before = before or "#"
        elif p.isdigit():
            if len(p) >= 5 and not post:
                post = p
            else:
                (units if before == "u" else weak if before == "#" else houses).append(p.lstrip("0") or "0")
            before = ""
        elif p in UNIT_WORDS and previous != "post":
            before = "u"
        elif p in HOUSE_WORDS:
            before = before if before == "u" else "h"
        else:
            before = ""
            if p in SIDES:
                sides.append(SIDES[p])
            elif p in ROADS:
                if p not in SOFT_ROADS:
                    roads.append(ROADS[p])
            elif (glued := next((r for r in GLUED_ROADS if len(p) >= len(r) + 3 and p.endswith(r)), "")):
                roads.append(glued)
                words.append(p[: -len(glued)])
            elif p not in LANDMARKS and len(p) > 2:
                words.append(p)
            elif p not in LANDMARKS and len(p) == 2:
                codes.append(p)
    if not post and len(houses) > 1 and _CYRILLIC.search(text) and (four := [h for h in houses if len(h) == 4]):
        post = four[-1]
        houses.remove(post)
    (units if houses else houses).extend(weak)  # without another number, each of several could be the house's
    return Place(post, tuple(sorted(houses)), tuple(sorted(units)), tuple(sorted(set(roads))), tuple(sorted(set(sides))), tuple(words), tuple(sorted(set(codes))))


def alike(a: str, b: str, slack: int = 0) -> bool:
    """Two words that are one, mistyped, cut short or differently spelled."""
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    if len(short) >= 4 and long.startswith(short):
        return True
    most = 2 + slack if len(short) >= 6 else 1 + slack if len(short) >= 4 else 0
    return bool(most) and edits(a, b, most) <= most


def _unmatched(a: tuple[str, ...], b: tuple[str, ...], slack: int = 0) -> tuple[list[str], list[str], int]:
    left, right, same = [], list(b), 0
    for w in a:
        hit = next((x for x in right if x == w), None) or next((x for x in right if alike(w, x, slack)), None)
        if hit is None:
            left.append(w)
        else:
            right.remove(hit)
            same += 1
    for one, other in ((left, right), (right, left)):  # words run together or apart
        for w in list(one):
            for i in range(len(other) - 1):
                if alike(w, other[i] + other[i + 1], slack):
                    one.remove(w)
                    del other[i : i + 2]
                    same += 1
                    break
    for one, whole in ((left, b), (right, a)):
        for w in list(one):
            if any(len(x) > len(w) >= 4 and (x.endswith(w) or x.startswith(w)) for x in whole):
                one.remove(w)
    return left, right, same


def same_place(a: Place, b: Place, slack: int = 0) -> bool:
    """No part that both give is different; what only one gives doesn't matter. ``slack``: further edits allowed in a word."""
    if a.post and b.post and a.post != b.post:
        return False
    if not a.houses or not b.houses or a.houses != b.houses:
        if not (set(a.houses) & set(b.houses)):
            return False
        extra = set(a.houses) ^ set(b.houses)  # an unlabelled second number is the other's unit
        if (set(a.houses) - set(b.houses) and set(b.houses) - set(a.houses)) or not extra <= set(a.units) | set(b.units):
            return False
    if a.units and b.units and a.units != b.units and not set(a.units) <= set(b.units + b.houses) and not set(b.units) <= set(a.units + a.houses):
        return False
    if a.sides and b.sides and not set(a.sides) & set(b.sides):
        return False
    if a.roads and b.roads and not set(a.roads) & set(b.roads):
        return False
    left, right, same = _unmatched(a.words, b.words, slack)
    if not same:
        return False
    if a.post and b.post:
        return True
    if a.codes and b.codes and not set(a.codes) & set(b.codes):
        return False
    return not (left and right)


_US, _RS = "\x1f", "\x1e"


def packed_name(value: str) -> str:
    """A parsed name with its folded spelling as one text, so that it is parsed once per form and not per pair."""
    n = parse_name(" ".join(plain(value).split()))
    return _RS.join((folded(value), _US.join(n.core), n.given, _US.join(",".join(sorted(w)) for w in n.line), _US.join(n.numbers)))


@lru_cache(30_000)
def unpacked_name(text: str) -> tuple[str, Name]:
    fold, core, given, line, numbers = text.split(_RS)
    words = lambda t: tuple(t.split(_US)) if t else ()
    return fold, Name(words(core), given, tuple(frozenset(w.split(",")) for w in words(line)), words(numbers))


def packed_place(value: str) -> str:
    p = parse_address(" ".join(plain(value).split()))
    return _RS.join((p.post, *[_US.join(x) for x in p[1:]]))


@lru_cache(30_000)
def unpacked_place(text: str) -> Place:
    post, *rest = text.split(_RS)
    return Place(post, *[tuple(x.split(_US)) if x else () for x in rest])
