"""Evaluation passages inside a training corpus.

Method: greedy string tiling. Texts and items are read as words without markup, case and punctuation.

1. Shared-token seeds: every run of five item words is a seed (of three, where a quotation of half the item
   with its changed words could leave none of five). The seeds of the documents are joined with those of
   the items. A place is a candidate if it has as many of an item's seeds as a quotation of ``share`` of it
   must leave: on neighbouring diagonals for one in order, where each of the changed words, one in
   ``one_in``, breaks no more seeds than a seed has words; or anywhere in two neighbouring blocks of the
   text as long as the item for one in passages of at least ``PASSAGE`` words in any order, which have a
   seed for every two words. Reordered passages share seeds, not diagonals, so the second count keeps them.
2. Running Karp-Rabin greedy string tiling of item and place: hashes of unmarked runs of the current
   search length find the longest common runs, which are marked and never used again, then shorter ones
   down to ``MIN_TILE`` words. The share of the item's words under tiles of ``PASSAGE`` words or more is its
   coverage; shorter tiles are as often phrases that any two texts share.
3. Coverage decides: from ``share`` on, the place holds the item's passages in whatever order. A quotation in
   order whose changed words leave shorter fragments has less coverage; where all tiles together have half
   of what a quotation needs, an alignment word by word gives the longest stretch in order in which at most
   one word in ``one_in`` is changed, added or lost, and that has to reach ``share``.

The join is a lookup in the items' sorted seeds, the smaller side by far: it goes to the workers as a
broadcast of at most ``MAX_ITEM_WORDS`` words. Larger collections of items are worked through in passes,
each of which builds, uses and drops its own index, so nothing grows with the number of items but the
passes. The corpus is read once per pass and never shuffled; the work per document is its words plus the
seeds it really shares with items.

Defined results
    * null, empty and wordless texts and items give no rows;
    * a quotation has at least three words, or all of an item that is shorter;
    * short quotations tolerate fewer changed words than one in ``one_in`` and one more: no more than still
      leave a seed;
    * ids may be null or repeated: rows are distinct pairs;
    * very long texts are processed whole; an empty table gives no rows;
    * other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.markup import running_text
from weft.session import cut, ship

#: words of a seed, of the seeds of short items, of a tile, and of a tile that counts in whatever order
SEED, SHORTEST, MIN_TILE, PASSAGE = 5, 3, 3, 8
#: diagonals counted together
BAND = 8
MAX_ITEM_WORDS = 2_000_000
_WORDS = re.compile(r"[^\W_]+")


def text_words(text: str) -> list[str]:
    return _WORDS.findall(running_text(text, lines=False).lower())


def string_tiles(item: Sequence[int], place: Sequence[int], shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (item start, place start, length), none overlapping another in either sequence. 0 matches nothing."""
    free_a, free_b = [x != 0 for x in item], [x != 0 for x in place]
    tiles: list[tuple[int, int, int]] = []

    def runs(free: list[bool], size: int) -> Iterator[int]:
        blocked = 0
        for end, ok in enumerate(free, 1):
            if not ok:
                blocked = end
            if end - blocked >= size:
                yield end - size

    base, mod = 1_000_003, (1 << 61) - 1

    def hashes(seq: Sequence[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        top, last, h = pow(base, size - 1, mod), -2, 0
        for at in runs(free, size):
            if at == last + 1:
                h = ((h - seq[at - 1] * top) * base + seq[at + size - 1]) % mod
            else:
                h = 0
                for x in seq[at : at + size]:
                    h = (h * base + x) % mod
            last = at
            yield at, h

    size = max(shortest, min(len(item), len(place)) // 2)
    while True:
        index = defaultdict(list)
        for at, h in hashes(item, free_a, size):
            index[h].append(at)
        found, longest = [], 0
        for b, h in hashes(place, free_b, size) if index else ():
            for a in index.get(h, ()):
                if a and b and free_a[a - 1] and free_b[b - 1] and item[a - 1] == place[b - 1]:
                    continue  # part of a longer match
                n = 0
                while a + n < len(item) and b + n < len(place) and free_a[a + n] and free_b[b + n] and item[a + n] == place[b + n]:
                    n += 1
                if n >= size:
                    found.append((n, a, b))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        for n, a, b in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if all(free_a[a : a + n]) and all(free_b[b : b + n]):
                tiles.append((a, b, n))
                free_a[a : a + n] = free_b[b : b + n] = [False] * n
        if size == shortest:
            return tiles
        size = max(shortest, size // 2)


def longest_stretch(item: Sequence[int], place: Sequence[int], one_in: int = 8, most: int | None = None) -> int:
    """Item words in the longest stretch in order with at most one word in ``one_in`` (and one more) edited, and at most ``most``."""
    n, m = len(item), len(place)
    score = [[0] * (m + 1) for _ in range(n + 1)]
    step = [bytearray(m + 1) for _ in range(n + 1)]
    best, at = 0, (0, 0)
    for i in range(1, n + 1):
        row, above, x, s = score[i], score[i - 1], item[i - 1], step[i]
        left = 0
        for j in range(1, m + 1):
            v, d = (above[j - 1] + 2, 1) if x and x == place[j - 1] else (above[j - 1] - 1, 2)
            if above[j] - 1 > v:
                v, d = above[j] - 1, 3
            if left - 1 > v:
                v, d = left - 1, 4
            if v <= 0:
                v = d = 0
            row[j] = left = v
            s[j] = d
            if v > best:
                best, at = v, (i, j)
    words, edits = [0], [0]  # along the path, from its end
    i, j = at
    while d := step[i][j]:
        words.append(words[-1] + (d != 4))
        edits.append(edits[-1] + (d != 1))
        i, j = i - (d != 4), j - (d != 3)
    out = 0
    for a in range(len(words)):
        for b in range(len(words) - 1, a, -1):
            if words[b] - words[a] <= out:
                break
            if (edits[b] - edits[a]) * one_in <= words[b] - words[a] + one_in and (most is None or edits[b] - edits[a] <= most):
                out = words[b] - words[a]
                break
    return out


class ItemIndex:
    """Words and seeds of some items, in arrays."""

    def __init__(self, items: Sequence[tuple[object, str]], share: float, one_in: int):
        self.ids, words, self.vocabulary = [], [], {}
        for key, text in items:
            if own := text_words(text or ""):
                self.ids.append(key)
                words.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in own])
        n = np.array([len(w) for w in words], np.int64)
        self.lengths, self.ends = n, np.cumsum(n)
        self.flat = np.concatenate([np.array(w, np.int64) for w in words]) if words else np.empty(0, np.int64)
        # words that a quotation must have, the changed words it may have, the length of its seeds and how many it leaves
        self.half = np.maximum(np.ceil(n * share - 1e-9).astype(np.int64), np.minimum(n, SHORTEST))
        self.edits, self.sizes = self.half // one_in + 1, np.minimum(n, SHORTEST)
        for size in range(SHORTEST, SEED + 1):
            self.sizes[self.half - size + 1 - size * self.edits >= 1] = size
        self.edits = np.minimum(self.edits, np.maximum(self.half - self.sizes, 0) // np.maximum(self.sizes, 1))
        self.in_order = np.maximum(1, self.half - self.sizes + 1 - self.sizes * self.edits)
        self.in_passages = np.maximum(1, -(-self.half * (PASSAGE - self.sizes + 1) // PASSAGE))
        self.reach = -(-self.edits // BAND) + 1
        self.seeds: dict[int, tuple[np.ndarray, ...]] = {}  # by length: keys, first posting, number of postings, items and places
        for size in range(1, SEED + 1):
            mine = np.flatnonzero(self.sizes == size)
            if not len(mine):
                continue
            count = n[mine] - size + 1
            item = np.repeat(mine, count)
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.ends[mine] - n[mine], count)
            keys = self.key(self.flat, at, size)
            order = np.argsort(keys, kind="stable")
            uniq, first, times = np.unique(keys[order], return_index=True, return_counts=True)
            self.seeds[size] = uniq, first, times, item[order].astype(np.int32), (at - (self.ends - n)[item])[order].astype(np.int32)

    def words(self, item: int) -> np.ndarray:
        return self.flat[self.ends[item] - self.lengths[item] : self.ends[item]]

    def cap(self, item: int, one_in: int) -> int | None:
        """Most changed words in a quotation of a short item; None where the rate alone bounds them."""
        return int(self.edits[item]) if self.edits[item] < self.half[item] // one_in + 1 else None

    def key(self, ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of runs; 64 bits wrap around, and the tiles tell apart what collides."""
        out = ids[at].astype(np.uint64)
        for k in range(1, size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[at + k].astype(np.uint64)
        return out

    def candidates(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, first word, end word) of the places with enough seeds. ids: all documents' words, 0 for words of no item."""
        for size, (keys, first, times, items, places) in self.seeds.items():
            if len(ids) < size:
                continue
            known = ids > 0
            run = known[: len(ids) - size + 1].copy()
            for k in range(1, size):
                run &= known[k : len(ids) - size + 1 + k]
            at = np.flatnonzero(run)
            doc = np.searchsorted(starts, at, side="right") - 1
            inside = at + size <= starts[doc] + lengths[doc]
            at, doc = at[inside], doc[inside]
            mine = self.key(ids, at, size)
            seed = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            hit = keys[seed] == mine
            at, doc, seed = at[hit], doc[hit], seed[hit]
            reps = times[seed]
            posting = np.repeat(first[seed] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
            item, doc, place = items[posting].astype(np.int64), np.repeat(doc, reps), np.repeat(at - starts[doc], reps)
            n = self.lengths[item]
            # on neighbouring diagonals (place in the text minus place in the item), for quotations in order
            d, i, band = self._crowded(doc, item, (place - places[posting] + n) // BAND, self.in_order, self.reach)
            near = [(d, i, band * BAND - self.lengths[i], (band + self.reach[i]) * BAND + self.edits[i])]
            # in neighbouring blocks of the text, for passages in any order
            d, i, block = self._crowded(doc, item, place // n, self.in_passages, np.full(len(self.lengths), 2))
            near.append((d, i, block * self.lengths[i], (block + 2) * self.lengths[i] + size))
            yield from self._merged(*[np.concatenate(x) for x in zip(*near)], lengths)

    @staticmethod
    def _crowded(doc: np.ndarray, item: np.ndarray, cell: np.ndarray, least: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, cell) from which ``reach`` cells of the pair on have at least ``least`` seeds. What is counted is sorted, so only what occurs costs."""
        if not len(doc):
            return doc, item, cell
        wide, many = int(cell.max()) + 1, len(least)
        key = np.sort((doc * many + item) * wide + cell) if (int(doc.max()) + 1) * many < (1 << 62) // wide else None
        if key is None:
            order = np.lexsort((cell, item, doc))
            rows = np.stack((doc[order], item[order], cell[order]))
            new = np.flatnonzero(np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(0))))
            count, (doc, item, cell) = np.diff(np.append(new, rows.shape[1])), rows[:, new]
        else:
            new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            count, key = np.diff(np.append(new, len(key))), key[new]
            pair, cell = np.divmod(key, wide)
            doc, item = np.divmod(pair, many)
        near = count.copy()
        for k in range(1, int(reach.max())):
            # the cells that follow in the list may be up to k further on; each is at most k places away
            for j in range(1, k + 1):
                if j < len(cell):
                    fits = (doc[j:] == doc[:-j]) & (item[j:] == item[:-j]) & (cell[j:] == cell[:-j] + k) & (reach[item[:-j]] > k)
                    near[:-j] += np.where(fits, count[j:], 0)
        yes = near >= least[item]
        return doc[yes], item[yes], cell[yes]

    @staticmethod
    def _merged(doc: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        order = np.lexsort((lo, item, doc))
        last: list[int] | None = None
        for d, i, a, b in zip(doc[order].tolist(), item[order].tolist(), np.maximum(lo[order], 0).tolist(), np.minimum(hi[order], lengths[doc[order]]).tolist()):
            if last and last[:2] == [d, i] and a <= last[3]:
                last[3] = max(last[3], b)
                continue
            if last:
                yield tuple(last)
            last = [d, i, a, b]
        if last:
            yield tuple(last)


def _equal(item: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.equal.outer(item, place) & (item != 0)[:, None]


def in_order(same: np.ndarray, wanted: int, edits: int) -> bool:
    """Whether ``wanted`` neighbouring item words, but for ``edits`` of them, are equal to the text on neighbouring diagonals."""
    n, m = same.shape
    at, to = np.nonzero(same)
    diagonal, span, window = to - at + n, min(edits + 1, n + m), min(wanted, n)
    total = np.cumsum(np.bincount(diagonal, minlength=n + m + 1))
    if (total[span:] - total[:-span]).max(initial=0) < wanted - edits:  # not even in the whole item
        return False
    grid = np.zeros((n, n + m + 1), np.int16)
    grid[at, diagonal] = 1
    along = np.cumsum(grid, axis=1, dtype=np.int16)
    found = along[:, span:] > along[:, :-span]
    down = np.zeros((n + 1, found.shape[1]), np.int16)
    np.cumsum(found, axis=0, dtype=np.int16, out=down[1:])
    return bool((down[window:] - down[:-window]).max(initial=0) >= wanted - edits)


def plausible(item: np.ndarray, place: np.ndarray, wanted: int, edits: int) -> bool:
    """Whether tiling can end well: equal words in order, or enough item words in runs of a passage's length."""
    same = _equal(item, place)
    if in_order(same, wanted, edits):
        return True
    size = min(PASSAGE, len(item))
    if min(same.shape) < size:
        return False
    run, have = same, 1
    while have < size:
        step = min(have, size - have)
        run, have = run[: run.shape[0] - step, : run.shape[1] - step] & run[step:, step:], have + step
    begins = np.flatnonzero(run.any(1))
    edge = np.zeros(len(item) + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + size, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum()) >= wanted


def _passes(items: DataFrame, key: str, text: str, most: int) -> tuple[int, DataFrame]:
    rows = items.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).where(F.col("t").isNotNull())
    words = rows.agg(F.sum(F.size(F.split("t", r"\s+"))).alias("n")).first().n or 0
    return max(1, math.ceil(words / most)), rows


def leaked_items(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, *, share: float = 0.5, one_in: int = 8, most_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """key, item_key, coverage, stretch, wanted of the pairs where a document holds ``share`` of an item, in order or not.

    coverage: share of the item's words in passages in the best place. stretch: its longest tile if that is
    long enough, else the longest stretch found around the tiles, in item words. wanted: the item words that make a quotation; ``stretch >= wanted`` is one in order.
    """
    ship(docs.sparkSession)
    key_type, item_type = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"`{key}` {key_type}, `{item_key}` {item_type}, coverage double, stretch int, wanted int"
    source = docs.select(F.col(key), F.col(text).cast("string").alias("_weft_text"))
    passes, rows = _passes(items, item_key, item_text, most_words)
    out = None
    for p in range(passes):
        mine = rows if passes == 1 else rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(passes)) == p)
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex([tuple(r) for r in mine.toLocalIterator()], share, one_in))
        found = source.mapInArrow(_finder(index, share, one_in, key, item_key, items.schema[item_key].dataType), schema)
        if passes > 1:  # one index at a time, on the driver and on the workers
            found = cut(found)
            index.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def _finder(broadcast, share: float, one_in: int, key: str, item_key: str, item_type):
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_item = to_arrow_type(item_type)

    def judge(place: np.ndarray, item: np.ndarray, wanted: int, edits: int, most: int | None) -> tuple[float, int] | None:
        tiles = sorted(string_tiles(item.tolist(), place.tolist(), min(MIN_TILE, len(item))), key=lambda t: -t[2])
        if not tiles or sum(t[2] for t in tiles) * 2 < wanted:
            return None
        passages, stretch = sum(t[2] for t in tiles if t[2] >= min(PASSAGE, len(item))), tiles[0][2]
        if stretch < wanted:
            stretch = max(stretch, _near(place, item, tiles, wanted, edits, most))
        return (passages / len(item), stretch) if passages >= wanted or stretch >= wanted else None

    def _near(place: np.ndarray, item: np.ndarray, tiles: list[tuple[int, int, int]], wanted: int, edits: int, most: int | None) -> int:
        """The first stretch that is long enough around the tiles, longest first, as far as the item can reach from each."""
        slack, best, seen = len(item) // one_in + 2, 0, []
        for a, b, _ in tiles:
            lo, hi = max(0, b - a - slack), min(len(place), b - a + len(item) + slack)
            if any(abs(lo - x) <= 2 and abs(hi - y) <= 2 for x, y in seen):
                continue
            seen.append((lo, hi))
            if in_order(_equal(item, place[lo:hi]), wanted, edits):
                best = max(best, longest_stretch(item.tolist(), place[lo:hi].tolist(), one_in, most))
                if best >= wanted:
                    break
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = broadcast.value
        known = index.vocabulary.get
        for whole in batches:
            for start in range(0, whole.num_rows, 4000):
                b = whole.slice(start, 4000)
                ids: list[int] = []
                at, lengths = [], []
                for value in b.column(1).to_pylist():
                    at.append(len(ids))
                    if value:
                        ids.extend([known(w, 0) for w in text_words(value)])
                    lengths.append(len(ids) - at[-1])
                flat, at = np.array(ids, np.int64), np.array(at, np.int64)
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for d, i, lo, hi in index.candidates(flat, at, np.array(lengths, np.int64)):
                    item, place = index.words(i), flat[at[d] + lo : at[d] + hi]
                    if not plausible(item, place, int(index.half[i]), int(index.edits[i])):
                        continue
                    got = judge(place, item, int(index.half[i]), int(index.edits[i]), index.cap(i, one_in))
                    if got and got > best.get((d, i), (0.0, 0)):
                        best[d, i] = got
                if best:
                    pairs = list(best)
                    yield pa.RecordBatch.from_arrays(
                        [
                            b.column(0).take(pa.array([d for d, _ in pairs])),
                            pa.array([index.ids[i] for _, i in pairs], arrow_item),
                            pa.array([round(best[p][0], 6) for p in pairs]),
                            pa.array([best[p][1] for p in pairs], pa.int32()),
                            pa.array([int(index.half[i]) for _, i in pairs], pa.int32()),
                        ],
                        [key, item_key, "coverage", "stretch", "wanted"],
                    )

    return run
