"""Records whose postal addresses denote one place.

Method: an address is a vector of character n-grams of its words, weighted by inverse document
frequency. Pairs with cosine similarity of at least ``similarity`` are found through an inverted index
with prefix filtering: grams stand in order of frequency, rarest first, and only as many are indexed
that the weight of the rest alone can't reach the similarity; two vectors that reach it share an indexed
gram. House-number compatibility is part of the index key, so posting lists are per (house number,
gram) and stay short. What meets is verified: cosine similarity, then house number, unit, postcode,
street and town, none of which may differ where both addresses give it.

Two addresses that both denote one place with a third are a pair as well, if they don't contradict each
other with up to ``SLACK`` further edits in a word. Distinct addresses are compared, not records; records
come back by an equi-join on their address.

Defined results
    * null and empty addresses, and addresses without a word or a number, take part in no pair;
    * addresses written alike are one place, whatever their parts;
    * repeated rows give one pair; an id paired with itself is left out; ids are put in order as text;
    * an empty table gives no rows; very long addresses are compared whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.names import Place, packed_place, plain, same_place, unpacked_place
from weft.llm.variants import linked_classes, two_steps
from weft.session import cut, discard, ship

GRAM, SIMILARITY = 4, 0.25
SLACK = 2


def grams(p: Place) -> list[str]:
    """n-grams of the words that tell places apart, and the postcode."""
    out = {p.post} if p.post else set()
    for w in p.words:
        s = f"^{w}$"
        out.update(s[i : i + GRAM] for i in range(max(1, len(s) - GRAM + 1)))
    return sorted(out)


def address_forms(df: DataFrame, column: str) -> DataFrame:
    """raw, norm, where (the parts as one text), houses, grams of every distinct non-null address."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norm = [" ".join(plain(v).split()) for v in b.column(0).to_pylist()]
            where = [packed_place(n) for n in norm]
            parsed = [unpacked_place(w) for w in where]
            cols = [b.column(0), pa.array(norm, pa.string()), pa.array(where, pa.string()), pa.array([sorted(set(p.houses)) for p in parsed], pa.list_(pa.string())), pa.array([grams(p) for p in parsed], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(cols, ["raw", "norm", "where", "houses", "grams"])

    distinct = df.select(F.col(column).cast("string").alias("raw")).where(F.col("raw").isNotNull()).distinct()
    return distinct.mapInArrow(run, "raw string, norm string, where string, houses array<string>, grams array<string>").where(F.col("norm") != "")


def weighted(forms: DataFrame, similarity: float) -> DataFrame:
    """Forms (aid, norm, where, houses, grams) with codes (of the grams, rarest first), w (of unit length) and prefix (grams to be indexed)."""
    long = forms.select("aid", F.explode("grams").alias("gram"))
    seen = long.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    total = forms.agg(F.count(F.lit(1)).alias("n")).first().n  # one number
    vectors = long.join(seen, "gram").groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("g"))
    whole = forms.select("aid", "norm", "where", "houses").join(vectors, "aid").select("aid", "norm", "where", "houses", F.transform("g.gram", lambda g: F.xxhash64(g)).alias("codes"), F.transform("g.df", lambda d: F.log(F.lit(1.0 + total) / d)).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights, prefix = [], []
            for w in b.column(5):
                v = np.array(w.values, np.float64)
                v = v / max(np.sqrt((v * v).sum()), 1e-12)
                rest = np.sqrt(np.maximum(0.0, 1.0 - np.concatenate(([0.0], np.cumsum(v * v)[:-1]))))
                weights.append(v.astype(np.float32))
                prefix.append(int((rest >= similarity - 1e-9).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(weights, pa.list_(pa.float32())), pa.array(prefix, pa.int32())], ["aid", "norm", "where", "houses", "codes", "w", "prefix"])

    return whole.mapInArrow(run, "aid long, norm string, where string, houses array<string>, codes array<bigint>, w array<float>, prefix int")


def candidates(sized: DataFrame) -> DataFrame:
    """i, j of the addresses that share a house number and an indexed gram and don't give different postcodes."""
    post = sized.select("aid", F.substring_index("where", "\x1e", 1).alias("post"), F.explode("houses").alias("house"), F.slice("codes", F.lit(1), F.col("prefix")).alias("g")).select("aid", "post", F.explode(F.transform("g", lambda g: F.xxhash64(F.col("house"), g))).alias("key"))
    side = lambda i, p: post.select(F.col("aid").alias(i), F.col("post").alias(p), "key")
    one_post = (F.col("p") == "") | (F.col("q") == "") | (F.col("p") == F.col("q"))
    return side("i", "p").join(side("j", "q"), "key").where((F.col("i") < F.col("j")) & one_post).select("i", "j").distinct()


def cosines(xg: pa.ListArray, xw: pa.ListArray, yg: pa.ListArray, yw: pa.ListArray) -> np.ndarray:
    """Scalar products of many pairs of sparse vectors at once."""

    def flat(codes: pa.ListArray, weights: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pair = np.repeat(np.arange(len(codes)), codes.value_lengths().to_numpy(zero_copy_only=False))
        return pair, codes.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False)

    (p, g, w), (q, h, v) = flat(xg, xw), flat(yg, yw)
    pairs, code, weight = np.concatenate((p, q)), np.concatenate((g, h)), np.concatenate((w, v)).astype(np.float64)
    order = np.lexsort((code, pairs))  # a gram occurs once in a vector, so equal neighbours are one of each
    pairs, code, weight = pairs[order], code[order], weight[order]
    met = np.flatnonzero((pairs[1:] == pairs[:-1]) & (code[1:] == code[:-1]))
    return np.bincount(pairs[met], weights=weight[met] * weight[met + 1], minlength=len(xg))


def _verified(pairs: DataFrame, sized: DataFrame, similarity: float) -> DataFrame:
    """i, j, similarity of the candidates that are similar enough and don't contradict each other."""
    side = lambda i, p: sized.select(F.col("aid").alias(i), F.col("where").alias(f"{p}p"), F.col("codes").alias(f"{p}g"), F.col("w").alias(f"{p}w"))
    full = pairs.join(side("i", "x"), "i").join(side("j", "y"), "j").select("i", "j", "xp", "yp", "xg", "xw", "yg", "yw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cosine = cosines(*b.columns[4:])
            b = pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.round(cosine, 6))], ["i", "j", "xp", "yp", "similarity"]).filter(pa.array(cosine >= similarity))
            keep = [same_place(unpacked_place(x), unpacked_place(y)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_())).select(["i", "j", "similarity"])

    return full.mapInArrow(run, "i long, j long, similarity double")


def place_links(df: DataFrame, key: str, address: str, *, similarity: float = SIMILARITY, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """Classes of records with equal addresses and the links between them: (id, norm, aid) and (i, j, similarity).

    A class is an address, ``aid`` its number (null for an address without words and numbers, which has no
    links). A link joins two different addresses of one place (similarity 0.0: through a third address). What
    many records share is linked once, not once for each pair of them.
    """
    placed = df.select(F.col(key).cast("string").alias("id"), F.col(address).cast("string").alias("raw")).where(F.col("id").isNotNull() & F.col("raw").isNotNull())
    forms = cut(address_forms(placed, "raw"))
    texts = cut(forms.select("norm", "where", "houses", "grams").dropDuplicates(["norm"]).withColumn("aid", F.monotonically_increasing_id()))
    sized = cut(weighted(texts, similarity))
    discard(texts)
    same = cut(_verified(candidates(sized), sized, similarity))

    def bridge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [same_place(unpacked_place(x), unpacked_place(y), slack) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_())).select(["i", "j"])

    if slack:
        part = lambda i, p: sized.select(F.col("aid").alias(i), F.col("where").alias(p))
        steps = two_steps(same, "i", "j").join(part("i", "xp"), "i").join(part("j", "yp"), "j").select("i", "j", "xp", "yp")
        same = same.unionByName(steps.mapInArrow(bridge, "i long, j long").withColumn("similarity", F.lit(0.0)))
    ids = placed.hint("merge").join(forms.select("raw", "norm"), "raw").select("id", "norm").distinct()
    return ids.join(sized.select("norm", "aid"), "norm", "left").select("id", "norm", "aid"), same


def place_pairs(df: DataFrame, key: str, address: str, **options) -> DataFrame:
    """id_a, id_b, similarity: every pair of records whose addresses denote one place, from ``place_links``."""
    known, same = place_links(df, key, address, **options)
    side = lambda p, *on: known.select(*on, F.col("id").alias(p))
    met = same.join(side("p", F.col("aid").alias("i")), "i").join(side("q", F.col("aid").alias("j")), "j").select("p", "q", "similarity")
    alike = side("p", "norm").join(side("q", "norm"), "norm").where("p < q").select("p", "q", F.lit(1.0).alias("similarity"))
    both = met.unionByName(alike).where(F.col("p") != F.col("q"))
    return both.groupBy(F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b")).agg(F.max("similarity").alias("similarity"))


def place_classes(df: DataFrame, key: str, address: str, **options) -> DataFrame:
    """id, class_id, n_links: a row for each record and address of it. ``class_id`` is the smallest id with that address, ``n_links`` the other records there and at the linked addresses."""
    known, same = place_links(df, key, address, **options)
    known = cut(known)
    return linked_classes(known.select("id", F.col("norm").alias("form"), F.col("aid").alias("number")), same.select(F.col("i").alias("x"), F.col("j").alias("y")))
