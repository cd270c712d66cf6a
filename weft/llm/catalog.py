"""Queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from weft.llm.language import language_segments, mislabelled
from weft.llm.leakage import leaked_items
from weft.llm.lookalike import consistent_forms, inconsistent_values
from weft.llm.matching import match_lists
from weft.llm.places import place_classes, place_pairs
from weft.llm.termfreq import marked_terms, rare_or_common
from weft.llm.tokenize import decode_corpus, encode_corpus
from weft.llm.topn import top_n_per_group
from weft.llm.variants import variant_classes, variant_pairs
from weft.session import table

#: where the public vocabularies are; nothing of them is in this repository
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = f"{TOKENIZERS}/byte_bpe_50k.json"
FIELDS = ("business_name", "business_address")


def p1_found(spark, sf_dir):
    return rare_or_common(table(spark, sf_dir, "train_source1"), FIELDS, "row_no")


def p1_terms(spark, sf_dir):
    t = marked_terms(table(spark, sf_dir, "train_source1"), FIELDS, "row_no")
    return t.select("field", "term", "occurrences", "records", "last_record", F.array_join("marks", ",").alias("marks"))


def p2_found(spark, sf_dir):
    known = table(spark, sf_dir, "train_matches").select(F.col("source1_entity_id").alias("s1_id"))
    return p2_matches(spark, sf_dir).where("confidence >= 0.5").join(known, "s1_id", "left_anti").select("s1_id", "target_id")


def p2_matches(spark, sf_dir):
    columns = ("entity_id", "business_name", "business_address", "country")
    lists = [table(spark, sf_dir, f"train_source{k}").select(*columns) for k in (1, 2, 3)]
    return match_lists(lists[0], lists[1].unionByName(lists[2]), table(spark, sf_dir, "train_matches"))


def p3_found(spark, sf_dir):
    return top_n_per_group(table(spark, sf_dir, "candidate_pairs"), "s1_id", "target_id", "rank_score", 5).select("s1_id", "target_id")


def p3_ranked(spark, sf_dir):
    return top_n_per_group(table(spark, sf_dir, "candidate_pairs"), "s1_id", "target_id", "rank_score", 5)


def p4_found(spark, sf_dir):
    return variant_pairs(table(spark, sf_dir, "train_source1"), "entity_id", "business_name").select("id_a", "id_b").distinct()


def p4_variants(spark, sf_dir):
    """A row per record and spelling: its class and the number of records linked to it."""
    return variant_classes(table(spark, sf_dir, "train_source1"), "entity_id", "business_name")


def p7_found(spark, sf_dir):
    return place_pairs(table(spark, sf_dir, "train_source1"), "entity_id", "business_address").select("id_a", "id_b")


def p7_places(spark, sf_dir):
    """A row per record and address: its class and the number of records at the same place."""
    return place_classes(table(spark, sf_dir, "train_source1"), "entity_id", "business_address")


def p6_found(spark, sf_dir):
    return inconsistent_values(table(spark, sf_dir, "train_source1"), "row_no", FIELDS)


def p6_forms(spark, sf_dir):
    return consistent_forms(table(spark, sf_dir, "train_source1"), "row_no", FIELDS).select("row_no", "field", "form", F.array_join("faults", ",").alias("faults"), "whole_script")


def p8_ids(spark, sf_dir):
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", BYTE_BPE_50K)


def p8_roundtrip(spark, sf_dir):
    """Documents whose text doesn't come back from its ids: none."""
    docs = table(spark, sf_dir, "documents")
    back = decode_corpus(encode_corpus(docs, "doc_id", "text", BYTE_BPE_50K), "doc_id", "ids", BYTE_BPE_50K)
    pair = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("a")).join(back.select("doc_id", F.xxhash64("text").alias("b")), "doc_id", "full")
    return pair.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("restored"))


def p9_found(spark, sf_dir):
    """The leaks that are quotations in order."""
    return p9_leaks(spark, sf_dir).where("stretch >= wanted").select("doc_id", "item_id").distinct()


def p9_leaks(spark, sf_dir):
    return leaked_items(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


def p10_found(spark, sf_dir):
    found = mislabelled(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", table(spark, sf_dir, "lang_samples"))
    return found.select("doc_id", "seg_no", "lang").distinct()


def p10_languages(spark, sf_dir):
    return language_segments(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "lang_samples"))


QUERIES = {
    "p1_found": p1_found, "p1_terms": p1_terms,
    "p2_found": p2_found, "p2_matches": p2_matches,
    "p3_found": p3_found, "p3_ranked": p3_ranked,
    "p4_found": p4_found, "p4_variants": p4_variants,
    "p6_found": p6_found, "p6_forms": p6_forms,
    "p7_found": p7_found, "p7_places": p7_places,
    "p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip,
    "p9_found": p9_found, "p9_leaks": p9_leaks,
    "p10_found": p10_found, "p10_languages": p10_languages,
}

_TERMS = """
v AS (SELECT 'business_name' AS field, row_no, business_name AS value FROM train_source1 WHERE business_name IS NOT NULL
      UNION ALL SELECT 'business_address', row_no, business_address FROM train_source1 WHERE business_address IS NOT NULL),
n AS (SELECT field, count(*) AS n FROM v GROUP BY field),
t AS (SELECT field, row_no, unnest(string_split(translate(value, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ')) AS term FROM v),
c AS (SELECT field, term, count(*) AS occurrences, count(DISTINCT row_no) AS records, max(row_no) AS last_record FROM t WHERE term <> '' GROUP BY field, term)"""

_BEST = """
b AS (SELECT s1_id, target_id, max(rank_score) AS rank_score FROM candidate_pairs
      WHERE rank_score IS NOT NULL AND NOT isnan(rank_score) AND s1_id IS NOT NULL AND target_id IS NOT NULL GROUP BY s1_id, target_id),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY s1_id ORDER BY rank_score DESC, try_cast(substr(split_part(target_id, '-', 1), 2) AS bigint) DESC NULLS LAST,
             try_cast(split_part(target_id, '-', 2) AS bigint) DESC NULLS LAST, target_id DESC) AS int) AS rank FROM b)"""

ORACLE = {
    "p8_roundtrip": "SELECT count(*) AS documents, count(*) AS restored FROM documents",
    "p1_found": f"""WITH {_TERMS}
        SELECT field, term, 'rare' AS mark FROM c WHERE records = 1
        UNION ALL SELECT field, term, 'common' FROM c JOIN n USING (field) WHERE records * 50 > n""",
    "p1_terms": f"""WITH {_TERMS}
        SELECT field, term, occurrences, records, last_record,
               concat_ws(',', CASE WHEN records = 1 THEN 'rare' END, CASE WHEN records * 50 > n THEN 'common' END) AS marks FROM c JOIN n USING (field)""",
    "p3_found": f"WITH {_BEST} SELECT s1_id, target_id FROM r WHERE rank <= 5",
    "p3_ranked": f"WITH {_BEST} SELECT s1_id, target_id, rank_score, rank FROM r WHERE rank <= 5",
    "p6_found": r"""
        WITH v AS (SELECT row_no, 'business_name' AS field, business_name AS value FROM train_source1 WHERE business_name IS NOT NULL
                   UNION ALL SELECT row_no, 'business_address', business_address FROM train_source1 WHERE business_address IS NOT NULL)
        SELECT DISTINCT row_no, field FROM v
        WHERE regexp_matches(value, '[\x{0}-\x{1f}\x{7f}-\x{a0}\x{ad}\x{34f}\x{1680}\x{180b}-\x{180e}\x{2000}-\x{200f}\x{2010}\x{2011}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{fe00}-\x{fe0f}\x{feff}]')
           OR regexp_matches(value, '[\x{300}-\x{36f}\x{fb00}-\x{fb06}\x{ff01}-\x{ffee}\x{1d400}-\x{1d7ff}]')
           OR regexp_matches(value, '\p{Latin}[\p{M}\p{N}]*[\p{Greek}\p{Cyrillic}]|[\p{Greek}\p{Cyrillic}][\p{M}\p{N}]*\p{Latin}|\p{Greek}[\p{M}\p{N}]*\p{Cyrillic}|\p{Cyrillic}[\p{M}\p{N}]*\p{Greek}')""",
}
