"""Feature tables of pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions import similarity as S
from weft.functions import text as T
from weft.functions import unicode as U
from weft.functions.hashing import validation_fold

# Names and order of the features of pairs and of the noise indicators.
FEATURES = (
    "source", "name_exact", "address_exact", "name_token_jaccard", "name_qgram_dice", "name_edit", "name_containment", "name_length_ratio",
    "address_token_jaccard", "address_qgram_dice", "address_edit", "address_containment", "address_length_ratio",
    "numeric_agree", "numeric_conflict", "numeric_overlap_ratio", "postal_agree", "postal_conflict", "retrieval_hits", "best_field", "worst_field",
)
INDICATORS = (
    "country_equal", "name_raw_exact", "name_norm_exact", "name_token_jaccard", "name_char_similarity", "address_norm_exact", "address_token_jaccard", "address_char_similarity",
    "numeric_any_agree", "numeric_conflict", "postal_agree", "postal_conflict", "name_token_overlap", "address_token_overlap", "name_qgram_overlap", "address_qgram_overlap",
)


def _flag(c: Column) -> Column:
    return c.cast("double")


def pair_features(pairs: DataFrame, rec: DataFrame, owners: DataFrame | None = None, neutral_hits: bool = False) -> DataFrame:
    """s1_id, target_id, fold, label and the 21 features of pairs (s1, source, num, hits).

    ``neutral_hits`` sets retrieval_hits to 0.5, as in fitting, so that a model isn't scored with what it
    never saw.
    """
    cols = ("name_norm", "addr_norm", "name_toks", "addr_toks", "name_grams", "addr_grams", "addr_nums")
    a = rec.where(F.col("source") == 1).select(F.col("num").alias("s1"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = rec.where(F.col("source") > 1).select("source", "num", *[F.col(c).alias(f"b_{c}") for c in cols])
    both = pairs.select("s1", "source", "num", "hits").join(a, "s1").join(b, ["source", "num"])
    x, y = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    if owners is None:
        both = both.withColumn("label", F.lit(0))
    else:
        both = both.join(owners, ["source", "num"], "left").withColumn("label", F.coalesce((F.col("owner") == F.col("s1")).cast("int"), F.lit(0)))
    ap, bp = T.postal_tokens(x("addr_nums")), T.postal_tokens(y("addr_nums"))
    filled = (F.size(x("addr_nums")) > 0) & (F.size(y("addr_nums")) > 0)
    common = S.overlap(x("addr_nums"), y("addr_nums"))
    name_dice, addr_dice = S.dice(x("name_grams"), y("name_grams")), S.dice(x("addr_grams"), y("addr_grams"))
    out = {
        "source": _flag(F.col("source") == 3),
        "name_exact": _flag((x("name_norm") == y("name_norm")) & (x("name_norm") != "")),
        "address_exact": _flag((x("addr_norm") == y("addr_norm")) & (x("addr_norm") != "")),
        "name_token_jaccard": S.jaccard(x("name_toks"), y("name_toks")),
        "name_qgram_dice": name_dice,
        "name_edit": S.edit_similarity(x("name_norm"), y("name_norm")),
        "name_containment": S.containment(x("name_norm"), y("name_norm")),
        "name_length_ratio": S.length_ratio(x("name_norm"), y("name_norm")),
        "address_token_jaccard": S.jaccard(x("addr_toks"), y("addr_toks")),
        "address_qgram_dice": addr_dice,
        "address_edit": S.edit_similarity(x("addr_norm"), y("addr_norm")),
        "address_containment": S.containment(x("addr_norm"), y("addr_norm")),
        "address_length_ratio": S.length_ratio(x("addr_norm"), y("addr_norm")),
        "numeric_agree": _flag(common > 0),
        "numeric_conflict": _flag(filled & (common == 0)),
        "numeric_overlap_ratio": F.when(filled, common.cast("double") / F.greatest(F.size(x("addr_nums")), F.size(y("addr_nums")))).otherwise(0.0),
        "postal_agree": _flag(S.overlap(ap, bp) > 0),
        "postal_conflict": _flag((F.size(ap) > 0) & (F.size(bp) > 0) & (S.overlap(ap, bp) == 0)),
        "retrieval_hits": F.lit(0.5) if neutral_hits else F.least("hits", F.lit(10)) / 10.0,
        "best_field": F.greatest(name_dice, addr_dice),
        "worst_field": F.least(name_dice, addr_dice),
    }
    return both.select(T.entity_id(F.lit(1), F.col("s1")).alias("s1_id"), T.entity_id(F.col("source"), F.col("num")).alias("target_id"), validation_fold(F.col("s1")).alias("fold"), "label", *[out[f].alias(f) for f in FEATURES])


def noise_indicators(pairs: DataFrame) -> DataFrame:
    """label, s1, target and 16 indicators of raw pairs (label, s1, target, a_name, a_addr, a_country, b_...)."""
    norm = pairs.select("*", U.sample_name("a_name").alias("an"), U.sample_name("b_name").alias("bn"), U.sample_address("a_addr").alias("aa"), U.sample_address("b_addr").alias("ba"), U.case_folded("a_name").alias("ac"), U.case_folded("b_name").alias("bc"))
    an, bn, aa, ba = (F.col(c) for c in ("an", "bn", "aa", "ba"))
    norm = norm.select("*", U.unicode_numbers("aa").alias("ax"), U.unicode_numbers("ba").alias("bx"), U.gestalt_ratio("an", "bn").alias("ns"), U.gestalt_ratio("aa", "ba").alias("ads"))
    ap, bp = T.bounded_postal_tokens(aa), T.bounded_postal_tokens(ba)
    nums, posts = S.overlap(F.col("ax"), F.col("bx")), S.overlap(ap, bp)
    out = {
        "country_equal": _flag(F.col("a_country") == F.col("b_country")),
        "name_raw_exact": _flag(F.col("ac") == F.col("bc")),
        "name_norm_exact": _flag(an == bn),
        "name_token_jaccard": S.jaccard(T.token_set(an), T.token_set(bn)),
        "name_char_similarity": F.col("ns"),
        "address_norm_exact": _flag((aa == ba) & (aa != "")),
        "address_token_jaccard": S.jaccard(T.token_set(aa), T.token_set(ba)),
        "address_char_similarity": F.col("ads"),
        "numeric_any_agree": _flag(nums > 0),
        "numeric_conflict": _flag((F.size("ax") > 0) & (F.size("bx") > 0) & (nums == 0)),
        "postal_agree": _flag(posts > 0),
        "postal_conflict": _flag((F.size(ap) > 0) & (F.size(bp) > 0) & (posts == 0)),
        "name_token_overlap": S.overlap(T.token_set(an), T.token_set(bn)).cast("double"),
        "address_token_overlap": S.overlap(T.token_set(aa), T.token_set(ba)).cast("double"),
        "name_qgram_overlap": S.overlap(T.character_trigrams(an), T.character_trigrams(bn)).cast("double"),
        "address_qgram_overlap": S.overlap(T.character_trigrams(aa), T.character_trigrams(ba)).cast("double"),
    }
    return norm.select("label", "s1", "target", *[out[i].alias(i) for i in INDICATORS])
