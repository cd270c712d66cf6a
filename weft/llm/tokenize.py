"""Encoding and decoding of a whole corpus with a public byte-level BPE vocabulary.

Method: global distinct-word shuffle. Merges never cross the borders of pre-tokens, so a pre-token has
the same ids wherever it stands and needs to be encoded once in the whole corpus:

1. texts are cut into pre-tokens; a block of neighbouring documents keeps its pre-tokens as positions
   in the block's own word list (compressed integers), so what leaves a block is each distinct word of
   the block once and not each occurrence;
2. the words of all blocks are shuffled, made distinct and encoded, each one once;
3. the ids are joined back to (word, block, slot) and gathered per block;
4. every block puts its documents together again by position.

The blocks are written to the checkpoint folder once, so neither the words nor the positions are
computed twice and a lost executor costs no more than its own tasks. Blocks are bounded by characters,
their word lists therefore too. A word that is in every block gives one row per block to one join key;
adaptive execution splits that partition if it grows beyond its threshold.

Decoding is the same the other way round: a block keeps its distinct ids once, these are joined with the
vocabulary's table of token bytes, and every block puts its texts together by position. The table has as
many rows as the vocabulary has ids; it is broadcast up to ``MAX_VOCABULARY`` of them and joined by shuffle beyond.

Defined results
    * a null and an empty text both give the empty list, never null;
    * strings that look like special tokens are ordinary text; no special tokens are added;
    * keys may be null or repeated: each row gives one row; an empty table gives none;
    * very long texts are processed whole (one text is never split between blocks);
    * other columns are ignored, whatever their names.

``vocabulary`` is the path of a file on every node: ``*.json`` (tokenizers; the normalizer and the pattern
of the pre-tokens are the file's own) or ``*.tiktoken`` (ranks; the published pattern of the family).
Vocabularies whose words have no borders of this kind are refused, as is decoding where ids don't stand for bytes.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.session import cut, ship

# Fixed value: the published pre-token pattern of this family of vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: characters after which a block is closed, and ids when decoding
BLOCK_CHARS, BLOCK_IDS = 2_000_000, 1_000_000
#: ids up to which a table of token bytes is broadcast
MAX_VOCABULARY = 1_000_000
_CODEC = "zstd"


@cache
def splitter(vocabulary: str) -> Callable[[str], list[str]]:
    """The pre-tokens of a text, as the vocabulary's file has them made."""
    if vocabulary.endswith(".tiktoken"):
        return regex.compile(PATTERN).findall
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        rules = json.load(f)
    pre = rules.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    split = next((x for x in steps if x.get("type") == "Split"), None)
    if split and split.get("invert") and split.get("behavior") == "Removed" and "Regex" in split["pattern"]:
        pattern = split["pattern"]["Regex"]
    elif not split and steps[-1].get("type") == "ByteLevel" and steps[-1].get("use_regex") and not steps[-1].get("add_prefix_space"):
        pattern = PATTERN
    else:
        raise ValueError(f"the words of {vocabulary} have no borders that this operator knows")
    find = regex.compile(pattern).findall
    if not rules.get("normalizer"):
        return find
    normal = Tokenizer.from_file(vocabulary).normalizer.normalize_str
    return lambda text: find(normal(text))


@cache
def encoder(vocabulary: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of single pre-tokens."""
    if vocabulary.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(vocabulary)
        t.encode_special_tokens = True
        return lambda words: [e.ids for e in t.encode_batch(words, add_special_tokens=False)]
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    t = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda words: t.encode_ordinary_batch(words, num_threads=1)


@cache
def token_bytes(vocabulary: str) -> pa.BinaryArray:
    """The bytes of every id, in order of the ids."""
    if vocabulary.endswith(".json"):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
            raise ValueError(f"the ids of {vocabulary} don't stand for bytes")
        model = model["vocab"]
        # the file writes bytes as printable characters: printable Latin-1 as itself, the rest from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        back = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
        by_id = {i: bytes(back[c] for c in s) if all(c in back for c in s) else s.encode() for s, i in model.items()}
    else:
        with open(vocabulary, "rb") as f:
            by_id = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    return pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.binary())


def _pack(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), codec=_CODEC, asbytes=True)


def _blocks(df: DataFrame, key: str, text: str, vocabulary: str, block_chars: int) -> DataFrame:
    """block, keys, sizes (pre-tokens per document), slots (packed positions in words), words."""
    key_type = df.schema[key].dataType.simpleString()

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find = splitter(vocabulary)
        number = count(TaskContext.get().partitionId() << 33)
        schema = None

        def closed(keys: list, sizes: list[int], slots: array, words: dict[str, int]) -> pa.RecordBatch:
            codes = np.frombuffer(slots, np.uint32) if len(slots) else np.empty(0, np.uint32)
            width = 2 if len(words) <= 0xFFFF else 4
            packed = _pack(codes.astype(f"<u{width}"))
            columns = [pa.array([next(number)], pa.int64()), pa.array([pa.concat_arrays(keys)], schema), pa.array([sizes], pa.list_(pa.int32())), pa.array([len(codes)], pa.int64()), pa.array([packed], pa.binary()), pa.array([list(words)], pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays(columns, ["block", "keys", "sizes", "n_slots", "slots", "words"])

        keys, sizes, slots, chars = [], [], array("I"), 0
        words: defaultdict[str, int] = defaultdict(count().__next__)
        for batch in batches:
            schema, start = pa.list_(batch.column(0).type), 0
            for i, value in enumerate(batch.column(1)):
                before = len(slots)
                if (s := value.as_py()) is not None:
                    slots.extend(map(words.__getitem__, find(s)))
                    chars += len(s)
                sizes.append(len(slots) - before)
                if chars >= block_chars:
                    keys.append(batch.column(0).slice(start, i + 1 - start))
                    yield closed(keys, sizes, slots, words)
                    start, keys, sizes, slots, chars, words = i + 1, [], [], array("I"), 0, defaultdict(count().__next__)
            if start < batch.num_rows:
                keys.append(batch.column(0).slice(start))
        if sizes:
            yield closed(keys, sizes, slots, words)

    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(cut_blocks, f"block long, keys array<{key_type}>, sizes array<int>, n_slots long, slots binary, words array<string>")


def encode_words(words: DataFrame, vocabulary: str) -> DataFrame:
    """ids of each row's ``word``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            ids = pa.array(encode(b.column(0).to_pylist()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str, *, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """key, ids: the token ids of every row's text."""
    key_type = df.schema[key].dataType.simpleString()
    ship(df.sparkSession)
    splitter(vocabulary)  # refuses here what it would refuse on the workers
    blocks = cut(_blocks(df, key, text, vocabulary, block_chars))
    uses = blocks.select("block", F.posexplode("words").alias("slot", "word"))
    encoded = encode_words(uses.select("word").distinct(), vocabulary)
    lists = uses.join(encoded, "word").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("slot", "ids"))).alias("s")).select("block", F.col("s.ids").alias("word_ids"))
    whole = blocks.drop("words").join(lists, "block", "left")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(n)[i] for n in ("keys", "sizes", "n_slots", "slots", "word_ids")}
                keys, sizes, n = row["keys"].values, row["sizes"].values.to_numpy(), row["n_slots"].as_py()
                if n:
                    raw = row["slots"].as_py()
                    words = row["word_ids"].values
                    dtype = np.dtype("<u2" if len(words) <= 0xFFFF else "<u4")
                    slots = np.frombuffer(pa.decompress(raw, n * dtype.itemsize, codec=_CODEC), dtype)
                    lengths = pc.list_value_length(words).to_numpy()
                    flat = words.take(pa.array(slots, pa.uint32())).flatten()
                    ends = np.concatenate(([0], np.cumsum(lengths[slots], dtype=np.int64)))[np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))]
                else:
                    flat, ends = pa.array([], pa.int32()), np.zeros(len(sizes) + 1, np.int64)
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                for at in range(0, len(keys), 500):
                    yield pa.RecordBatch.from_arrays([keys.slice(at, 500), ids.slice(at, 500)], [key, "ids"])

    small = whole.select("keys", "sizes", "n_slots", "slots", "word_ids")
    return small.mapInArrow(assemble, f"`{key}` {key_type}, ids array<int>")


def _id_blocks(df: DataFrame, key: str, ids: str, block_ids: int) -> DataFrame:
    """block, keys, sizes (ids per row, -1 for null), n_slots, slots (packed positions in distinct), distinct."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), -1).to_numpy().astype(np.int64)
            ends = np.cumsum(np.maximum(sizes, 0))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + block_ids, side="right")))
                part = batch.slice(start, stop - start)
                distinct, slots = np.unique(pc.fill_null(part.column(1).flatten(), -1).to_numpy(zero_copy_only=False), return_inverse=True)
                packed = _pack(slots.astype(f"<u{2 if len(distinct) <= 0xFFFF else 4}"))
                columns = [pa.array([next(number)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(0)])), pa.array([sizes[start:stop]], pa.list_(pa.int32())), pa.array([len(slots)], pa.int64()), pa.array([packed], pa.binary()), pa.array([distinct], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "keys", "sizes", "n_slots", "slots", "distinct"])
                start = stop

    rows = df.select(F.col(key).alias("k"), F.col(ids).cast("array<int>").alias("i"))
    return rows.mapInArrow(run, f"block long, keys array<{key_type}>, sizes array<int>, n_slots long, slots binary, distinct array<int>")


def token_table(spark, vocabulary: str) -> DataFrame:
    """id, bytes of every id of a vocabulary."""
    table = token_bytes(vocabulary)
    return spark.createDataFrame(pa.table({"id": pa.array(range(len(table)), pa.int32()), "bytes": table}))


def decode_corpus(df: DataFrame, key: str, ids: str, vocabulary: str, *, block_ids: int = BLOCK_IDS) -> DataFrame:
    """key, text: the text of every row's list of ids (null for a null list, U+FFFD for stray bytes, nothing for unknown ids)."""
    ship(df.sparkSession)
    key_type = df.schema[key].dataType.simpleString()
    table = token_table(df.sparkSession, vocabulary)
    if len(token_bytes(vocabulary)) <= MAX_VOCABULARY:
        table = F.broadcast(table)
    blocks = cut(_id_blocks(df, key, ids, block_ids))
    uses = blocks.select("block", F.posexplode("distinct").alias("slot", "id"))
    lists = uses.join(table, "id", "left").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bytes", F.lit(b"")).alias("bytes")))).alias("s"))
    whole = blocks.drop("distinct").join(lists.select("block", F.col("s.bytes").alias("bytes")), "block", "left")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {n: b.column(n)[i] for n in ("keys", "sizes", "n_slots", "slots", "bytes")}
                keys, sizes, n = row["keys"].values, row["sizes"].values.to_numpy(), row["n_slots"].as_py()
                texts = [None if size < 0 else "" for size in sizes]
                if n:
                    parts = row["bytes"].values
                    dtype = np.dtype("<u2" if len(parts) <= 0xFFFF else "<u4")
                    slots = np.frombuffer(pa.decompress(row["slots"].as_py(), n * dtype.itemsize, codec=_CODEC), dtype)
                    ends = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0), dtype=np.int64)))
                    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts.take(pa.array(slots, pa.uint32()))), b"").to_pylist()
                    texts = [None if size < 0 else (j or b"").decode("utf-8", "replace") for j, size in zip(joined, sizes)]
                for at in range(0, len(keys), 500):
                    yield pa.RecordBatch.from_arrays([keys.slice(at, 500), pa.array(texts[at : at + 500], pa.string())], [key, "text"])

    return whole.select("keys", "sizes", "n_slots", "slots", "bytes").mapInArrow(assemble, f"`{key}` {key_type}, text string")
