import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from weft.operators import audit, blocking, evaluate, features, labels, model, records
from weft.operators.blocking import BlockingConfig
from weft.plans import linkage
from weft.session import packed
from weft.sources import files
from weft.streaming.targets import merge_top, score_stream

DATA = "/root/testdata/sf0.001"
RAW = "row_no bigint, entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def lists(spark):
    return {k: records.latest(spark.read.parquet(f"{DATA}/train_source{k}.parquet")) for k in (1, 2, 3)}


@pytest.fixture(scope="module")
def rec(spark, lists):
    return records.prepared(records.entities(*lists.values())).cache()


def test_latest_arrival_wins(spark):
    df = spark.createDataFrame([(1, "S1-1", "a", None, "x"), (3, "S1-1", "b", "y", None), (2, "S1-2", None, None, None), (4, None, "z", "z", "z")], RAW)
    assert rows(records.latest(df), "entity_id", "business_name", "business_address", "country") == [("S1-1", "b", "y", ""), ("S1-2", "", "", "")]


def test_config():
    assert BlockingConfig.parse(max_df="5", top_k="2").gram_df == 1 and BlockingConfig.full().gram_df == 800
    assert BlockingConfig.parse() == BlockingConfig(sample_mod=10, sample_rem=0, max_df=80, max_bucket=300, top_k=100)
    assert BlockingConfig.training() == BlockingConfig.parse(sample_mod="100", max_df="1000", max_bucket="5")
    with pytest.raises(ValueError):
        BlockingConfig.parse(nonsense="1")


def test_bucket_cap_and_country(spark):
    data = [(i, f"S1-{i}", "same name", f"{i} road", "US") for i in range(3)] + [(9, "S2-1", "same name", "", "US"), (10, "S2-2", "same name", "", "FR"), (11, "S3-1", "", "2 road", "US")]
    r = records.prepared(records.entities(records.latest(spark.createDataFrame(data, RAW))))
    hit = lambda cap: rows(blocking.stages(r, BlockingConfig(max_bucket=cap))["hits"].where("tag <= 2"), "tag", "s1", "source", "num")
    assert hit(3) == [(1, 0, 2, 1), (1, 1, 2, 1), (1, 2, 2, 1), (2, 2, 3, 1)]
    assert hit(2) == [(2, 2, 3, 1)]


def test_keys_and_ranks_write_little(spark, rec):
    """Values are ranked in one shuffle for single keys and pairs; pairs that carry their records' trigrams are not sorted, and carry numbers."""
    st, c = blocking.stages(rec, BlockingConfig.whole()), F.col
    plan = lambda name: st[name]._jdf.queryExecution().sparkPlan().toString()
    assert plan("keys").count("Window [") == 1
    assert "ShuffledHashJoin" in plan("ranked") and "conv(" in plan("ranked")
    words, grams = F.when(c("source") == 1, 3).otherwise(5), F.when(c("source") == 1, 5).otherwise(9)
    single = st["rare"].where(((c("kind") <= 2) & (c("rank") <= words)) | ((c("kind") >= 3) & (c("rank") <= grams) & (c("df") <= 10))).withColumn("tag", c("kind") + 2)
    cols = ("tag", "country", "val", "source", "num")
    assert rows(st["keys"].where("tag > 2"), *cols) == rows(single.select(*cols).unionByName(st["compound"].select(*cols)), *cols)


def test_passes_change_no_candidate(spark, rec, monkeypatch):
    """A whole run in passes has the candidates of one pass, also where a key's counts come from several."""
    config, cols = BlockingConfig(sample_mod=1, max_df=80_000, max_bucket=5, top_k=3), ("s1", "source", "num", "hits", "rank_score", "position")
    want = rows(blocking.stages(rec, config)["top"], *cols)
    monkeypatch.setattr(blocking, "PASS_RECORDS", rec.count() // 3)
    found = blocking.top_by_passes(packed(rec), config)
    assert found._jdf.queryExecution().logical().getClass().getSimpleName() == "Union"
    assert rows(found, *cols) == want and len(want) > 100


def test_top_k_order(spark):
    df = spark.createDataFrame([(1, 2, 5, 1.0), (1, 3, 1, 1.0), (1, 2, 7, 1.0), (1, 2, 1, 2.0)], "s1 bigint, source int, num bigint, rank_score float")
    assert [(r.source, r.num) for r in blocking.top_candidates(df, BlockingConfig(top_k=3)).orderBy("position").collect()] == [(2, 1), (3, 1), (2, 7)]


def test_contract(spark, lists, rec):
    """One row per master record; ids unique, of the two lists, and matches among the candidates."""
    top = blocking.stages(rec, BlockingConfig.whole())["top"].cache()
    feats = features.pair_features(top, rec)
    scored = feats.withColumn("score", F.col("best_field"))
    master = records.entities(lists[1])
    pairs = feats.select("s1_id", "target_id")
    cand = {r[0]: r[1].split(",") for r in model.id_lists(master, pairs, "c", unique=False).collect()}
    match = {r[0]: [x for x in r[1].split(",") if x] for r in model.final_matches(master, scored, 0.8).collect()}
    assert len(match) == master.count() == len(cand) and any(match.values())
    for k, ids in match.items():
        assert len(ids) == len(set(ids)) and set(ids) <= set(cand[k]) and all(x[:3] in ("S2-", "S3-") for x in ids)
        assert ids == sorted(ids, key=lambda x: (x[:2], int(x[3:])))
    assert not [r for r in model.final_matches(master, scored, float("inf")).collect() if r[1]]


def test_labels(spark):
    truth = spark.createDataFrame([("S1-1", "S2-1, S3-2"), ("S1-2", "S2-1,S2-1"), ("S1-3", ""), ("S1-4", None), ("S1-1", "S2-1, S3-2")], "source1_entity_id string, matched_entity_ids string")
    assert rows(labels.owners(truth), "source", "num", "owner") == [(2, 1, 2), (3, 2, 1)]
    placed = truth.where("matched_entity_ids <> ''").coalesce(1).withColumn(labels.ORDER, F.monotonically_increasing_id())
    assert rows(labels.owners(placed), "source", "num", "owner") == [(2, 1, 1), (3, 2, 1)]  # the last row wins, not the larger number
    assert rows(labels.true_counts(truth), "s1", "n_true") == [(1, 2), (2, 1), (3, 0), (4, 0)]
    assert rows(audit.origin_classes(truth), "origin", "n_rows") == [("both", 2), ("s2_only", 1), ("singleton", 2)]
    w = labels.class_weights(spark.createDataFrame([(1,), (0,), (0,)], "label int"), positive_mass=10.0, negative_mass=4.0)
    assert rows(w, "label", "weight") == [(0, 2.0), (0, 2.0), (1, 10.0)]


def f05(tp, pred, true):
    if true == 0:
        return float(pred == 0)
    if pred == 0 or tp == 0:
        return 0.0
    return 1.25 * (tp / pred) * (tp / true) / (0.25 * tp / pred + tp / true)


@pytest.mark.parametrize("seed", range(6))
def test_threshold_scan_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    truth = [(s, rnd.choice([0, 0, 1, 2, 3])) for s in range(8)]
    pairs = [(s, int(rnd.random() < 0.4 and n > 0), rnd.choice([0.1, 0.25, 0.5, 0.5, 0.9, -3.0, 7.5])) for s, n in truth for _ in range(rnd.randrange(0, 6))]
    want = {}
    for th in {p[2] for p in pairs} | {float("inf")}:
        fs = [f05(sum(p[1] for p in pairs if p[0] == s and p[2] >= th), sum(1 for p in pairs if p[0] == s and p[2] >= th), n) for s, n in truth]
        want[th] = sum(fs) / len(fs)
    scan = evaluate.threshold_scan(spark.createDataFrame(pairs, "s1 int, label int, score double"), spark.createDataFrame(truth, "s1 int, n_true int")).cache()
    got = {r.threshold: r.macro_f05 for r in scan.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    top = evaluate.best_threshold(scan).first()
    assert top.threshold == max(k for k in want if round(want[k], 9) == round(max(want.values()), 9))


def test_entities_without_pairs_count(spark):
    pairs = spark.createDataFrame([(1, 1, 1.0)], "s1 int, label int, x double")
    truth = spark.createDataFrame([(1, 1), (2, 0), (3, 2)], "s1 int, n_true int")
    s = evaluate.experiments(pairs, truth, {"all": F.col("x") > 0}).first()
    assert s.candidate_recall == pytest.approx(1 / 3)
    assert (s.precision, s.recall, s.macro_f05, s.singleton_accuracy, s.non_singleton_f05) == pytest.approx((1, 1 / 3, 2 / 3, 1, 0.5))
    assert evaluate.threshold_scan(pairs.withColumnRenamed("x", "score").limit(0), truth.limit(0)).count() == 0
    assert evaluate.choose_model({"logistic": (0.5, 1.0), "trees": (0.5, 2.0)}) == ("trees", 2.0)


def test_a_whole_run_keeps_what_a_large_list_makes_frequent(spark, tmp_path):
    """1003 masters hold every word and trigram of the name, 3 of them in the target's country."""
    lists = {1: [(i, f"S1-{i}", "Zuvok Nimet", f"{i} road", "FR" if i < 3 else "US") for i in range(1003)], 2: [(1, "S2-1", "Zuvok Nimett", "", "FR")], 3: []}
    for k, data in lists.items():
        spark.createDataFrame(data, RAW).write.parquet(str(tmp_path / f"train_source{k}.parquet"))
    listed = lambda q: [r for r in rows(q(spark, str(tmp_path)), "source1_entity_id", "candidate_entity_ids") if r[1]]
    assert listed(linkage.full_candidate_lists) == [("S1-0", "S2-1"), ("S1-1", "S2-1"), ("S1-2", "S2-1")]
    assert linkage.FULL == BlockingConfig.full()


@pytest.mark.parametrize("kind", ["logistic", "trees"])
def test_the_chosen_model_is_refitted_on_all_labelled(spark, monkeypatch, kind):
    fits = []
    for name in ("fit_logistic", "fit_trees"):
        real = getattr(model, name)
        monkeypatch.setattr(model, name, lambda rows, *, weight=None, real=real, name=name, **k: fits.append((name, weight, rows.groupBy("label").count().orderBy("label").collect())) or real(rows, weight=weight, **k))
    monkeypatch.setattr(linkage, "TREES", {"iterations": 2})
    monkeypatch.setattr(evaluate, "choose_model", lambda found: (kind, 0.0) if set(found) == {"logistic", "trees"} else None)
    matches = linkage.final_matches(spark, DATA).cache()
    assert matches.count() == linkage.master(spark, DATA).count() and matches.where("matched_entity_ids <> ''").count()
    assert [f[:2] for f in fits] == [("fit_logistic", None), ("fit_trees", None), (f"fit_{kind}", "weight")]
    assert fits[2][2] == linkage.final_fit_rows(spark, DATA).groupBy("label").count().orderBy("label").collect() != fits[0][2]


@pytest.mark.parametrize("query", ["gbt_scores", "experiments"])
def test_trees_have_the_parameters_of_the_reference(spark, monkeypatch, query):
    class Asked(Exception):
        pass

    def asked(rows, **parameters):
        raise Asked(parameters)

    empty = spark.createDataFrame([], "s1_id string, target_id string, fold int, label int")
    monkeypatch.setattr(linkage, "_features", lambda *a, **k: empty)
    monkeypatch.setattr(model, "fit_logistic", lambda rows: (0.0, []))
    monkeypatch.setattr(model, "fit_trees", asked)
    with pytest.raises(Asked) as said:
        getattr(linkage, query)(spark, DATA)
    assert said.value.args[0] == {"iterations": 180, "learning_rate": 0.08, "min_rows": 40}


def test_models(spark, rec):
    base = {f: 0.0 for f in features.FEATURES}
    data = [(f"S1-{i}", f"S2-{i}", i % 5 == 0, int(i % 3 == 0), *[(i % 3 == 0) * 1.0 + (i % 7) / 20 if f == "best_field" else base[f] for f in features.FEATURES]) for i in range(120)]
    df = spark.createDataFrame([(a, b, int(c), d, *e) for a, b, c, d, *e in data], "s1_id string, target_id string, fold int, label int, " + ", ".join(f"`{f}` double" for f in features.FEATURES))
    intercept, w = model.fit_logistic(df)
    s = model.logistic_scores(df, intercept, w)
    assert s.where("label = 1").agg(F.min("score")).first()[0] > s.where("label = 0").agg(F.max("score")).first()[0]
    baseline, nodes = model.fit_trees(df, iterations=4, min_rows=2)
    t = model.tree_scores(df, baseline, nodes)
    assert t.where("label = 1").agg(F.min("score")).first()[0] > 0 > t.where("label = 0").agg(F.max("score")).first()[0]
    for kind, body, start in (("logistic", w, intercept), ("hgb", nodes, baseline)):
        text = model.save_model_text(kind, 0.25, start, body)
        assert model.load_model_text(text) == (kind, 0.25, start, body)
    assert model.load_model_text("")[1] == float("inf")


def test_fits_of_few_rows_are_few_tasks(spark, monkeypatch):
    df = spark.range(120).select((F.col("id") % 2).cast("int").alias("label"), *[(F.col("id") % 7 / 10 + F.col("id") % 2).alias(f) for f in features.FEATURES]).repartition(12)
    seen, real = [], model.assembled
    monkeypatch.setattr(model, "assembled", lambda rows: seen.append((rows.rdd.getNumPartitions(), rows.count())) or real(rows))
    model.fit_logistic(df, max_iter=2)
    model.fit_trees(df, iterations=1)
    assert seen == [(1, 120), (1, 120)]
    monkeypatch.setattr(model, "ROWS_A_TASK", 50)
    assert model.dealt(df).rdd.getNumPartitions() == 3


def test_missing_values_follow_the_flag(spark):
    df = spark.createDataFrame([(float("nan"),), (0.4,), (0.6,)], "v double").select(*[F.col("v").alias(f) if f == "best_field" else F.lit(0.0).alias(f) for f in features.FEATURES])
    at = features.FEATURES.index("best_field")
    leaf = lambda n, v: (0, n, 0, 0.0, 0, 0, v, True, False)
    for flag, want in ((True, [1.0, 1.0, 2.0]), (False, [2.0, 1.0, 2.0])):
        nodes = [(0, 0, at, 0.5, 1, 2, 0.0, False, flag), leaf(1, 1.0), leaf(2, 2.0)]
        assert [r.score for r in model.tree_scores(df, 0.0, nodes).collect()] == want


def test_audit(spark):
    df = spark.createDataFrame([(1, "S1-1", "A b", "x", "US"), (2, "S1-1", "a  B", None, None), (3, "S1-x", "", "NA", "NULL"), (4, "S1-y", None, "x!", "US")], RAW)
    assert rows(audit.missing_counts(df), "column", "rows", "missing") == [("business_address", 4, 2), ("business_name", 4, 2), ("country", 4, 2), ("entity_id", 4, 0)]
    assert rows(audit.duplicate_counts(df), "what", "duplicate_rows", "duplicate_values") == [("address", 1, 1), ("id", 2, 2), ("name", 1, 1)]
    assert rows(audit.country_counts(df), "country", "n_rows") == [("<MISSING>", 2), ("US", 2)]


def test_noise_pairs(spark, lists):
    truth = spark.read.parquet(f"{DATA}/train_matches.parquet")
    targets = lists[2].unionByName(lists[3]).withColumn("source", F.lit(2)).withColumn("row_no", F.col("entity_id"))
    p = features.noise_indicators(audit.noise_pairs(lists[1], targets, truth, modulus=1)).collect()
    pos, neg = [r for r in p if r.label == "positive"], [r for r in p if r.label == "negative"]
    assert pos and neg and len({r.s1 for r in neg}) == len(neg)
    mean = lambda rs: sum(r.name_char_similarity for r in rs) / len(rs)
    assert mean(pos) > mean(neg) + 0.2


def test_files(spark, tmp_path):
    p = tmp_path / "train_source1.tsv"
    p.write_bytes('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"A\tb\tUS\tx\r\nS1-2\tonly\n'.encode())
    assert rows(files.read_entities(spark, str(p)), "entity_id", "business_name", "business_address", "country") == [("S1-1", '"A', "b", "US\tx"), ("S1-2", "only", "", "")]
    df = spark.createDataFrame([("a", 1 / 3, 2)], "k string, v double, n int")
    files.write_tsv(spark.createDataFrame([("a", 1.0, 0.5)], "k string, flag double, part double").coalesce(1), str(tmp_path / "noise"), decimals=6, whole=("flag",))
    assert spark.read.text(str(tmp_path / "noise")).collect()[-1].value == "a\t1\t0.500000"
    files.write_tsv(df.coalesce(1), str(tmp_path / "t"), significant=7)
    assert files.columns_of(spark, str(tmp_path / "t")) == ["k", "v", "n"]
    assert files.read_quoted(spark, str(tmp_path / "t")).first().v == "0.3333333"
    files.write_json(df, str(tmp_path / "m.json"))
    files.write_csv(df, str(tmp_path / "c"))
    files.write_table(df, str(tmp_path / "p"), "k")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1 and '"v": 0.3333' in (tmp_path / "m.json").read_text()


def test_stream_equals_batch(spark, lists, tmp_path):
    config = BlockingConfig.whole()
    master = records.prepared(records.entities(lists[1])).cache()
    raw = lists[2].unionByName(lists[3])
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    score_stream(master, stream, config, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = merge_top(None, spark.read.parquet(str(tmp_path / "out")).drop("batch"), config)
    want = blocking.top_candidates(blocking.stages(master.unionByName(records.prepared(records.entities(raw))), config)["ranked"], config)
    cols = ("s1", "source", "num", "position")
    assert rows(got, *cols) == rows(want, *cols)


def test_core_stands_without_the_training_data_operators():
    import ast
    from pathlib import Path

    import weft

    root = Path(weft.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), path


def test_a_model_goes_through_its_file(spark, tmp_path):
    path = str(tmp_path / "model")
    for text in (linkage.FIXED_LOGISTIC, linkage.FIXED_TREES):
        files.write_document(spark, text, path)
        kind, threshold, intercept, body = model.load_model_text(files.read_document(spark, path))
        assert model.save_model_text(kind, threshold, intercept, body) == model.save_model_text(*model.load_model_text(text)) and body
    assert model.load_model_text("")[1] == float("inf")


def test_threshold_ranges_don_t_change_the_scan(spark):
    """Many scores over few ranges and the other way round."""
    rnd = random.Random(8)
    pairs = spark.createDataFrame([(rnd.randrange(40), int(rnd.random() < 0.4), rnd.randrange(900) / 7) for _ in range(600)], "s1 int, label int, score double")
    truth = pairs.groupBy("s1").agg(F.sum("label").alias("n_true"))
    got = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "7", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got.append({round(r.threshold, 6): round(r.macro_f05, 9) for r in evaluate.threshold_scan(pairs, truth).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def test_the_last_row_of_a_file_owns_a_target(spark, tmp_path):
    truth = spark.createDataFrame([("S1-9", "S2-1"), ("S1-3", "S2-1, S2-2"), ("S1-7", "S2-2")], "source1_entity_id string, matched_entity_ids string")
    truth.coalesce(1).write.parquet(str(tmp_path / "truth"))
    ordered = files.in_file_order(spark.read.parquet(str(tmp_path / "truth")), labels.ORDER).repartition(3)
    assert rows(labels.owners(ordered), "num", "owner") == [(1, 3), (2, 7)]
