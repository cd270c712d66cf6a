"""Queries of the linkage pipeline over the tables of the three lists."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from weft.functions import similarity as S
from weft.functions import text as T
from weft.functions.hashing import splitmix64, unsigned_mod, validation_fold
from weft.operators import audit, blocking, evaluate, features, labels, model, records
from weft.operators.blocking import BlockingConfig
from weft.session import cut, packed, shared_path, table
from weft.sources import files

CONFIG = BlockingConfig.whole()
#: limits of a whole inference run; CONFIG's are those of the training stage and of the stages' SQL
FULL = BlockingConfig.full()
#: boosted trees as the reference fits them
TREES = {"iterations": 180, "learning_rate": 0.08, "min_rows": 40}


def raw(spark, sf, k):
    return table(spark, sf, f"train_source{k}")


def entities(spark, sf):
    return records.entities(*[records.latest(raw(spark, sf, k)) for k in (1, 2, 3)])


def master(spark, sf):
    return records.modulus_sample(records.entities(records.latest(raw(spark, sf, 1))), CONFIG.sample_mod, CONFIG.sample_rem)


def rec(spark, sf):
    return records.prepared(entities(spark, sf))


def truth(spark, sf):
    return files.in_file_order(table(spark, sf, "train_matches"), labels.ORDER)


def stage(name):
    """A stage of candidate generation; the records are prepared once for all its uses."""
    return lambda spark, sf: blocking.stages(cut(rec(spark, sf)), CONFIG)[name]


# ingest, samples, hashing
def ingest_entities(spark, sf):
    return entities(spark, sf)


def union_targets(spark, sf):
    return records.entities(*[records.latest(raw(spark, sf, k)) for k in (2, 3)]).groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("name") == "").alias("no_name"))


def modulus_sample(spark, sf):
    return records.modulus_sample(records.entities(records.latest(raw(spark, sf, 1))), 10, 3).select("entity_id", "num")


def splitmix_fold(spark, sf):
    h = splitmix64(F.col("num"))
    return records.entities(records.latest(raw(spark, sf, 1))).select("num", F.lpad(F.hex(h), 16, "0").alias("hash_hex"), unsigned_mod(h, 5).cast("int").alias("mod5"), validation_fold(F.col("num")).alias("fold"))


def noise_pair_ids(spark, sf):
    """Which pairs the noise sample takes: the matches of the sampled records, and one pooled non-match each."""
    return audit.noise_pairs(records.latest(raw(spark, sf, 1)), _noise_targets(spark, sf), truth(spark, sf), modulus=2).select("label", "s1", "target")


def crc_sample(spark, sf):
    return audit.crc_sample(records.latest(raw(spark, sf, 1)), 20).select("entity_id")


def entity_id_parts(spark, sf):
    e = records.latest(raw(spark, sf, 2)).select("entity_id")
    s, n = T.entity_source(F.col("entity_id")), T.entity_number(F.col("entity_id"))
    return e.select("entity_id", s.alias("source"), n.alias("num"), T.entity_id(s, n).alias("rendered"))


# normalizers and sets
def normalize_name(spark, sf):
    return entities(spark, sf).select("entity_id", T.normalize_name(F.col("name")).alias("name_norm"))


def normalize_address(spark, sf):
    return entities(spark, sf).select("entity_id", T.normalize_address(F.col("address")).alias("addr_norm"))


def token_sets(spark, sf):
    return rec(spark, sf).select("entity_id", F.array_join("name_toks", " ").alias("name_toks"), F.array_join("addr_toks", " ").alias("addr_toks"))


def trigram_sets(spark, sf):
    return rec(spark, sf).select("entity_id", F.array_join("name_grams", " ").alias("name_grams"), F.size("addr_grams").alias("n_addr_grams"))


def numeric_tokens(spark, sf):
    return rec(spark, sf).select("entity_id", F.array_join("addr_nums", " ").alias("addr_nums"))


def postal_tokens(spark, sf):
    return rec(spark, sf).select("entity_id", F.array_join(T.postal_tokens(F.col("addr_nums")), " ").alias("postal"), F.array_join(T.bounded_postal_tokens(F.col("addr_norm")), " ").alias("bounded_postal"))


def compound_gram_pairs(spark, sf):
    return stage("compound")(spark, sf).groupBy("source", "num", "tag").agg(F.count(F.lit(1)).alias("n_pairs"), F.min("val").alias("first_pair"), F.max("val").alias("last_pair"))


def minhash_bands(spark, sf):
    return rec(spark, sf).where("source = 1").select("entity_id", T.minhash_bands(F.col("name_grams")).alias("bands"))


def audit_normalizer(spark, sf):
    from weft.functions.unicode import audit_normalized

    return entities(spark, sf).select("entity_id", audit_normalized("name").alias("name_norm"))


def sample_normalizer(spark, sf):
    from weft.functions.unicode import sample_address, sample_name

    return entities(spark, sf).select("entity_id", sample_name("name").alias("name_norm"), sample_address("address").alias("addr_norm"))


# similarities, on the labelled pairs
def _labelled_records(spark, sf):
    """The records of both sides that the truth names, prepared; the rest isn't."""
    pairs = labels.truth_pairs(truth(spark, sf))
    named = pairs.select(F.lit(1).alias("source"), F.col("s1").alias("num")).unionByName(pairs.select("source", "num")).distinct()
    return cut(records.prepared(entities(spark, sf).join(named, ["source", "num"], "left_semi")))


def _truth_pairs(spark, sf):
    r = _labelled_records(spark, sf)
    cols = ("name_norm", "addr_norm", "name_toks", "addr_toks", "name_grams", "addr_grams")
    a = r.where("source = 1").select(F.col("num").alias("s1"), *[F.col(c).alias(f"a_{c}") for c in cols])
    b = r.where("source > 1").select("source", "num", *[F.col(c).alias(f"b_{c}") for c in cols])
    return labels.truth_pairs(truth(spark, sf)).join(a, "s1").join(b, ["source", "num"])


def _similarity(f, name, address):
    def query(spark, sf):
        p = _truth_pairs(spark, sf)
        return p.select("s1", "source", "num", F.round(f(F.col(f"a_{name}"), F.col(f"b_{name}")), 6).alias("name_value"), F.round(f(F.col(f"a_{address}"), F.col(f"b_{address}")), 6).alias("address_value"))

    return query


# document frequency, rare values, blocks
def _df_of(kind):
    return lambda spark, sf: stage("df")(spark, sf).where(F.col("kind") == kind).select("val", "df")


def _rare(kinds):
    def query(spark, sf):
        return stage("rare")(spark, sf).where(F.col("kind").isin(*kinds)).select("source", "num", "kind", "val", "df", "rank")

    return query


def _block(*tags):
    def query(spark, sf):
        return stage("hits")(spark, sf).where(F.col("tag").isin(*tags)).groupBy("tag", "s1", "source", "num").agg(F.count(F.lit(1)).alias("n_keys"))

    return query


def evidence_counts(spark, sf):
    return stage("evidence")(spark, sf)


def keep_candidates(spark, sf):
    return blocking.retrieval_hits(stage("kept")(spark, sf)).select("s1", "source", "num", "hits")


def candidate_rank(spark, sf):
    return stage("ranked")(spark, sf).select("s1", "source", "num", "hits", F.round("name_dice", 6).alias("name_dice"), F.round("addr_dice", 6).alias("addr_dice"), F.round(F.col("rank_score").cast("double"), 5).alias("rank_score"))


def candidate_topk(spark, sf):
    return blocking.top_candidates(stage("ranked")(spark, sf), BlockingConfig(top_k=50)).select("s1", "source", "num", "position")


def _top(spark, sf):
    r = cut(rec(spark, sf))
    return r, cut(blocking.stages(r, CONFIG)["top"])


def _lists(spark, sf, top):
    pairs = top.select(T.entity_id(F.lit(1), F.col("s1")).alias("s1_id"), T.entity_id(F.col("source"), F.col("num")).alias("target_id"))
    return model.id_lists(master(spark, sf), pairs, "candidate_entity_ids", unique=False)


def candidate_lists(spark, sf):
    return _lists(spark, sf, stage("top")(spark, sf))


def training_candidates(spark, sf):
    """The pairs that a training run mines: a sample of the master records, whose frequencies alone count, against all targets."""
    config = BlockingConfig.training()
    every = entities(spark, sf)
    sampled = records.modulus_sample(every.where("source = 1"), config.sample_mod, config.sample_rem).unionByName(every.where("source > 1"))
    return blocking.stages(cut(records.prepared(sampled)), config)["top"].select("s1", "source", "num", "hits", "position")


def full_candidate_lists(spark, sf):
    """The candidates that ``final_matches`` scores."""
    return _lists(spark, sf, blocking.top_by_passes(packed(rec(spark, sf)), FULL))


def candidate_counters(spark, sf):
    """The run's counters in one row: pairs and true pairs before and after top-k, recall, averages, widest target."""
    r = cut(rec(spark, sf))
    st = blocking.stages(r, CONFIG, materialize=True)
    ranked = cut(st["ranked"])
    own = labels.owners(truth(spark, sf))
    count = lambda df, *more: df.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("true"), *more).first()
    before = count(labels.labelled(ranked.select("s1", "source", "num"), own))
    after = count(labels.labelled(blocking.top_candidates(ranked, CONFIG).select("s1", "source", "num"), own))
    total = labels.true_counts(truth(spark, sf)).agg(F.sum("n_true").alias("n")).first().n or 0
    widest = st["evidence"].groupBy("source", "num").count().agg(F.max("count").alias("n")).first().n or 0
    masters = r.where("source = 1").count()
    row = (before.n, before.true or 0, after.n, after.true or 0, total, round((after.true or 0) / total, 6) if total else 0.0, round(after.n / masters, 6) if masters else 0.0, widest)
    return spark.createDataFrame([row], "pre_pairs bigint, pre_true bigint, final_pairs bigint, positives_found bigint, true_total bigint, candidate_recall double, avg_candidates double, max_raw_per_target bigint")


# labels and features
def owner_last_wins(spark, sf):
    return labels.owners(truth(spark, sf))


def label_pairs(spark, sf):
    own = labels.owners(truth(spark, sf))
    return labels.labelled(stage("top")(spark, sf).select("s1", "source", "num"), own)


def _features(spark, sf, neutral=False):
    r, top = _top(spark, sf)
    known = labels.truth_rows(truth(spark, sf)).select("s1").distinct()
    own = labels.owners(truth(spark, sf))
    return features.pair_features(top.join(known, "s1", "left_semi"), r, own, neutral_hits=neutral)


def _rounded(f):
    return f.select("s1_id", "target_id", "fold", "label", *[F.round(c, 6).alias(c) for c in features.FEATURES])


def pair_features(spark, sf):
    return _rounded(_features(spark, sf))


def all_positive_features(spark, sf):
    """Features of every owned pair; raises where fewer or more are written than there are owners with both records."""
    r = _labelled_records(spark, sf)
    f = cut(features.pair_features(labels.positive_pairs(truth(spark, sf), r), r))
    ids = entities(spark, sf).select("source", "num")
    owned = labels.owners(truth(spark, sf)).join(ids, ["source", "num"], "left_semi").join(ids.where("source = 1").select(F.col("num").alias("owner")), "owner", "left_semi")
    if (wrote := f.count()) != (wanted := owned.count()):
        raise RuntimeError(f"{wrote} rows written for {wanted} owners")
    return _rounded(f.withColumn("fold", F.lit(0)).withColumn("label", F.lit(1)))


def negative_downsample(spark, sf):
    return labels.fitting_sample(_features(spark, sf, neutral=True)).select("s1_id", "target_id", "label", "retrieval_hits")


def class_weights(spark, sf):
    w = labels.class_weights(cut(labels.fitting_sample(_features(spark, sf)).select("s1_id", "target_id", "label")), negative_mass=1000.0)
    return w.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("weight"), 6).alias("mass"))


def _mined(spark, sf, r, top):
    known = labels.truth_rows(truth(spark, sf)).select("s1").distinct()
    own = labels.owners(truth(spark, sf))
    return cut(features.pair_features(top.join(known, "s1", "left_semi"), r, own, neutral_hits=True))


def _final_rows(spark, sf, r, mined):
    """Features and weight of every labelled positive and all retrieved negatives of both folds."""
    masses = labels.fitting_sample(mined).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    positives = features.pair_features(labels.positive_pairs(truth(spark, sf), r), r, neutral_hits=True).withColumn("label", F.lit(1))
    both = cut(positives.unionByName(mined.where("label = 0")))
    return labels.class_weights(both, positive_mass=float(masses.pos), negative_mass=float(masses.neg))


def final_fit_rows(spark, sf):
    """Rows of the final fit: every labelled positive and all retrieved negatives of both folds, weighted to the class masses of the validation fit."""
    r, top = _top(spark, sf)
    weighted = _final_rows(spark, sf, r, _mined(spark, sf, r, top))
    return weighted.select("s1_id", "target_id", "label", "retrieval_hits", F.round("weight", 6).alias("weight"))


# evaluation on the validation fold
def _counts(spark, sf):
    return labels.held_out(labels.true_counts(truth(spark, sf)), master(spark, sf))


def _validation(spark, sf):
    f = _features(spark, sf, neutral=True).where("fold = 1")
    return cut(f.withColumn("s1", T.entity_number(F.col("s1_id")))), _counts(spark, sf)


def candidate_stats(spark, sf):
    f, t = _validation(spark, sf)
    s = evaluate.candidate_statistics(f.select("s1", "label"), t, files.line_count(raw(spark, sf, 2), raw(spark, sf, 3)))
    return s.select("entities", "max_candidates", *[F.round(c, 6).alias(c) for c in ("mean_candidates", "median_candidates", "p95_candidates", "candidate_recall", "reduction_ratio")])


_METRICS = ("candidate_recall", "precision", "recall", "macro_f05", "singleton_accuracy", "non_singleton_f05", "avg_candidates")


def rules_abc_metrics(spark, sf):
    f, t = _validation(spark, sf)
    return evaluate.experiments(f, t, evaluate.rules()).select("experiment", *[F.round(c, 6).alias(c) for c in _METRICS])


def _scored_entities(spark, sf):
    f, t = _validation(spark, sf)
    return evaluate.entity_scores(f, t, evaluate.rules()["B_manual_fuzzy"])


def fbeta_by_entity(spark, sf):
    return _scored_entities(spark, sf).select("s1", "n_cand", "n_pred", "n_tp", "n_true", F.round("f05", 6).alias("f05"))


def macro_by_country(spark, sf):
    home = master(spark, sf).select(F.col("num").alias("s1"), "country")
    return _scored_entities(spark, sf).join(home, "s1").groupBy("country").agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("f05"), 6).alias("macro_f05"))


def macro_by_multiplicity(spark, sf):
    return _scored_entities(spark, sf).groupBy("n_true").agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("f05"), 6).alias("macro_f05"))


def threshold_scan(spark, sf):
    f, t = _validation(spark, sf)
    scan = evaluate.threshold_scan(f.select("s1", "label", F.round("best_field", 3).alias("score")), t)
    return scan.select("threshold", F.round("macro_f05", 6).alias("macro_f05"))


def best_threshold(spark, sf):
    f, t = _validation(spark, sf)
    return evaluate.best_threshold(evaluate.threshold_scan(f.select("s1", "label", F.round("best_field", 3).alias("score")), t), 6)


# audit
def audit_missing(spark, sf):
    out = None
    for k in (1, 2, 3):
        one = audit.missing_counts(raw(spark, sf, k)).select(F.lit(k).alias("source"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def audit_countries(spark, sf):
    return audit.country_counts(raw(spark, sf, 1))


def audit_duplicates(spark, sf):
    return audit.duplicate_counts(raw(spark, sf, 1))


def match_histogram(spark, sf):
    return audit.match_histogram(truth(spark, sf))


def origin_classes(spark, sf):
    return audit.origin_classes(truth(spark, sf))


def reservoir_first_n(spark, sf):
    both = raw(spark, sf, 2).withColumn("source", F.lit(2)).unionByName(raw(spark, sf, 3).withColumn("source", F.lit(3)))
    return audit.first_per_country(both).select("country", "position", "source", "row_no")


def audit_duplicate_ids(spark, sf):
    return audit.duplicate_counts(raw(spark, sf, 1)).where("what = 'id'")


def _noise_targets(spark, sf):
    return records.latest(raw(spark, sf, 2)).unionByName(records.latest(raw(spark, sf, 3))).withColumn("source", T.entity_source(F.col("entity_id"))).withColumn("row_no", T.entity_number(F.col("entity_id")))


def _noise(spark, sf):
    return features.noise_indicators(audit.noise_pairs(records.latest(raw(spark, sf, 1)), _noise_targets(spark, sf), truth(spark, sf), modulus=2))


def noise_pairs(spark, sf):
    return _noise(spark, sf).select("label", "s1", "target", *[F.round(c, 6).alias(c) for c in features.INDICATORS])


def noise_sample_means(spark, sf):
    return audit.means_by_label(_noise(spark, sf), features.INDICATORS)


# models
def _fit_rows(spark, sf):
    return cut(labels.fitting_sample(_features(spark, sf, neutral=True)))


def logistic_scores(spark, sf):
    f = cut(_features(spark, sf, neutral=True))
    intercept, weights = model.fit_logistic(labels.fitting_sample(f))
    return model.logistic_scores(f, intercept, weights).select("s1_id", "target_id", "fold", "label", F.round("score", 4).alias("score"))


def gbt_scores(spark, sf):
    f = cut(_features(spark, sf, neutral=True))
    baseline, nodes = model.fit_trees(labels.fitting_sample(f), **TREES)
    return model.tree_scores(f, baseline, nodes).select("s1_id", "target_id", "fold", "label", F.round("score", 6).alias("score"))


def experiments(spark, sf):
    """The three rules and both learned matchers at their best thresholds on the validation fold."""
    f = cut(_features(spark, sf, neutral=True).withColumn("s1", T.entity_number(F.col("s1_id"))))
    fit, held, counts = labels.fitting_sample(f), f.where("fold = 1"), _counts(spark, sf)
    intercept, weights = model.fit_logistic(fit)
    baseline, nodes = model.fit_trees(fit, **TREES)
    scored = cut(model.tree_scores(model.logistic_scores(held, intercept, weights).withColumnRenamed("score", "logistic"), baseline, nodes).withColumnRenamed("score", "trees"))
    predicted = evaluate.rules()
    for name, column in (("D_logistic_optimized", "logistic"), ("E_boosted_trees", "trees")):
        best = evaluate.best_threshold(evaluate.threshold_scan(scored.select("s1", "label", F.col(column).alias("score")), counts)).first()
        predicted[name] = F.col(column) >= F.lit(best.threshold if best is not None else float("inf"))
    return evaluate.experiments(scored, counts, predicted).select("experiment", *[F.round(c, 6).alias(c) for c in _METRICS])


def _fitted(kind, rows, threshold=float("inf"), weight=None):
    """A model of this kind, fitted on ``rows``, as text."""
    fit = model.fit_logistic(rows, weight=weight) if kind == "logistic" else model.fit_trees(rows, weight=weight, **TREES)
    return model.save_model_text(kind, threshold, *fit)


def _chosen(spark, sf, mined):
    """Kind, macro F0.5 and threshold of the better model on the validation fold, and both by kind."""
    counts = _counts(spark, sf)
    held = mined.where("fold = 1").withColumn("s1", T.entity_number(F.col("s1_id")))
    found = {}
    for kind in ("logistic", "trees"):
        scored = cut(model.text_scores(held, _fitted(kind, labels.fitting_sample(mined))).select("s1", "label", F.round("score", 6).alias("score")))
        best = evaluate.best_threshold(evaluate.threshold_scan(scored, counts)).first()
        found[kind] = (best.macro_f05, best.threshold) if best is not None else (0.0, float("inf"))
    return (*evaluate.choose_model(found), found)


def final_matches(spark, sf):
    """Choose kind and threshold on the validation fold, refit that kind on the rows of the final fit, write the model as text, and score all candidates of a whole run with what is read back."""
    r, top = _top(spark, sf)
    mined = _mined(spark, sf, r, top)
    kind, threshold, _ = _chosen(spark, sf, mined)
    path = shared_path(spark, "final-model")
    files.write_document(spark, _fitted(kind, cut(_final_rows(spark, sf, r, mined)), threshold, "weight"), path)
    every = features.pair_features(blocking.stages(r, FULL)["top"], r, neutral_hits=True)
    return model.text_matches(master(spark, sf), every, files.read_document(spark, path))


# a fixed model, so that scoring, threshold and lists have SQL counterparts
FIXED_LOGISTIC = model.save_model_text("logistic", 1.5, -4.0, [0.25 * (i % 5) - 0.25 for i in range(len(features.FEATURES))])
FIXED_TREES = """type trees
threshold 0.5
baseline -0.25
trees 2
tree 5
node 19 0.625 1 2 0 0 0
node 0 0 0 0 -1.5 1 0
node 13 0.5 3 4 0 0 1
node 0 0 0 0 0.375 1 0
node 0 0 0 0 1.75 1 0
tree 3
node 8 0.3125 1 2 0 0 0
node 0 0 0 0 -0.125 1 0
node 0 0 0 0 0.5 1 0
"""


def _fixed(spark, sf, text):
    return model.text_scores(_features(spark, sf, neutral=True), text)


def fixed_logistic_scores(spark, sf):
    return _fixed(spark, sf, FIXED_LOGISTIC).select("s1_id", "target_id", F.round("score", 6).alias("score"))


def fixed_tree_scores(spark, sf):
    return _fixed(spark, sf, FIXED_TREES).select("s1_id", "target_id", F.round("score", 6).alias("score"))


def fixed_model_matches(spark, sf):
    """Match lists of the fixed trees over the labelled records' candidates, the model through its file."""
    path = shared_path(spark, "fixed-model")
    files.write_document(spark, FIXED_TREES, path)
    return model.text_matches(master(spark, sf), _features(spark, sf, neutral=True), files.read_document(spark, path))


def metrics_document(spark, sf):
    """The run's metrics as one JSON document: chosen model, its macro F0.5 by country and multiplicity, candidate statistics."""
    r, top = _top(spark, sf)
    mined = _mined(spark, sf, r, top)
    kind, threshold, found = _chosen(spark, sf, mined)
    held, counts = mined.where("fold = 1").withColumn("s1", T.entity_number(F.col("s1_id"))), _counts(spark, sf)
    scored = cut(model.text_scores(held, _fitted(kind, labels.fitting_sample(mined), threshold)).withColumn("score", F.round("score", 6)))
    per = cut(evaluate.entity_scores(scored, counts, F.col("score") >= F.lit(threshold)).join(r.where("source = 1").select(F.col("num").alias("s1"), "country"), "s1"))
    means = lambda c: {str(x[0]): x[1] for x in per.groupBy(c).agg(F.round(F.avg("f05"), 6)).collect()}  # noqa: E731  a row per country or multiplicity
    stats = evaluate.candidate_statistics(held.select("s1", "label"), counts, files.line_count(raw(spark, sf, 2), raw(spark, sf, 3))).first()
    document = {"model": kind, "threshold": threshold if threshold != float("inf") else None, "macro_f05": {k: round(v[0], 6) for k, v in found.items()}, "by_country": means("country"), "by_multiplicity": means("n_true"), "candidates": stats.asDict()}
    return spark.createDataFrame([(json.dumps(document, indent=2, ensure_ascii=False),)], "document string")


QUERIES = {
    "ingest_entities": ingest_entities, "union_targets": union_targets, "modulus_sample": modulus_sample, "splitmix_fold": splitmix_fold, "crc_sample": crc_sample, "entity_id_parts": entity_id_parts,
    "normalize_name": normalize_name, "normalize_address": normalize_address, "audit_normalizer": audit_normalizer, "sample_normalizer": sample_normalizer,
    "token_sets": token_sets, "trigram_sets": trigram_sets, "numeric_tokens": numeric_tokens, "postal_tokens": postal_tokens, "compound_gram_pairs": compound_gram_pairs, "minhash_bands": minhash_bands,
    "similarity_jaccard": _similarity(S.jaccard, "name_toks", "addr_toks"), "similarity_dice": _similarity(S.dice, "name_grams", "addr_grams"), "similarity_edit": _similarity(S.edit_similarity, "name_norm", "addr_norm"),
    "similarity_containment": _similarity(S.containment, "name_norm", "addr_norm"), "similarity_length": _similarity(S.length_ratio, "name_norm", "addr_norm"),
    "token_df_name": _df_of(1), "token_df_address": _df_of(2), "gram_df_name": _df_of(3), "gram_df_address": _df_of(4),
    "rare_tokens": _rare((1, 2)), "rare_grams": _rare((3, 4)),
    "block_exact_name": _block(1), "block_exact_address": _block(2), "block_rare_token": _block(3, 4), "block_rare_gram": _block(5, 6), "block_compound": _block(7, 8),
    "evidence_counts": evidence_counts, "keep_candidates": keep_candidates, "candidate_rank": candidate_rank, "candidate_topk": candidate_topk, "candidate_lists": candidate_lists, "full_candidate_lists": full_candidate_lists, "training_candidates": training_candidates, "candidate_counters": candidate_counters,
    "owner_last_wins": owner_last_wins, "label_pairs": label_pairs, "pair_features": pair_features, "all_positive_features": all_positive_features, "negative_downsample": negative_downsample, "class_weights": class_weights, "final_fit_rows": final_fit_rows,
    "candidate_stats": candidate_stats, "rules_abc_metrics": rules_abc_metrics, "fbeta_by_entity": fbeta_by_entity, "macro_by_country": macro_by_country, "macro_by_multiplicity": macro_by_multiplicity,
    "threshold_scan": threshold_scan, "best_threshold": best_threshold,
    "audit_missing": audit_missing, "audit_countries": audit_countries, "audit_duplicates": audit_duplicates, "match_histogram": match_histogram, "origin_classes": origin_classes,
    "reservoir_first_n": reservoir_first_n, "noise_pairs": noise_pairs, "noise_sample_means": noise_sample_means,
    "noise_pair_ids": noise_pair_ids, "audit_duplicate_ids": audit_duplicate_ids, "fixed_logistic_scores": fixed_logistic_scores, "fixed_tree_scores": fixed_tree_scores, "fixed_model_matches": fixed_model_matches, "metrics_document": metrics_document,
    "logistic_scores": logistic_scores, "gbt_scores": gbt_scores, "experiments": experiments, "final_matches": final_matches,
}
