"""Models: learnable data, save and load, dispatch, search, the full run, clustering."""

import time

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from caseworks.operators import scoring, splits, themes, training
from caseworks.operators.evaluation import evaluate_vs_baseline, metrics_json
from caseworks.operators.features import FeatureRouting, route_features
from caseworks.operators.registry import latest_models
from caseworks.operators.tfidf import fit_tfidf, tfidf
from caseworks.plans.case_report import case_report
from caseworks.plans.multi_target import train_evaluate_register
from caseworks.sources.readers import table

COLUMNS = ["vendor", "line_desc", "club"]


@pytest.fixture(scope="module")
def lines(spark):
    """Department follows the vendor, account follows the vendor and the number; some targets are missing."""
    ids = spark.range(1200, numPartitions=4)
    vendor = F.concat(F.lit("vendor"), F.pmod(F.xxhash64("id"), F.lit(6)))
    return ids.select(
        "id",
        vendor.alias("vendor"),
        F.concat(F.lit("item "), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(9))).alias("line_desc"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2))).cast("int").alias("club"),
    ).select(
        "*",
        F.when(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10)) > 0, F.concat(F.lit("d"), F.pmod(F.xxhash64("vendor"), F.lit(3)))).alias("dept"),
        F.concat(F.lit("a"), F.col("club")).alias("account"),
    )


@pytest.fixture(scope="module")
def trained(lines):
    split = splits.split_support_aware(lines, "id", COLUMNS, ["dept", "account"])
    routing = route_features(lines.schema, COLUMNS, "A")
    models, report = training.train_all_targets(
        split, "id", ["dept", "account", "absent"], routing, lambda a, b: training.train_linear(a)
    )
    return models, report


def test_targets_train_side_by_side_and_failures_stay_visible(trained):
    models, report = trained
    assert set(models) == {"dept", "account"}
    assert [(t, s) for t, s, _, _ in report] == [("dept", "Completed"), ("account", "Completed"), ("absent", "Error")]
    assert all(score > 0.95 for _, s, score, _ in report if s == "Completed")


def test_model_beats_majority(lines, trained):
    pred = scoring.score(lines.drop("account"), trained[0]["dept"])
    assert "dept" not in pred.columns
    both = pred.select("id", "prediction").join(lines.select("id", F.col("dept").alias("label")), "id").withColumn("target", F.lit("dept"))
    row = evaluate_vs_baseline(both, "id", n_samples=500).first()
    assert row["rows"] == 500 and row["accuracy"] > row["baseline"] + 0.2


def test_save_and_load_score_the_same(spark, lines, trained, tmp_path):
    clf = trained[0]["dept"]
    clf.save(spark, str(tmp_path / "m"))
    again = training.Classifier.load(spark, str(tmp_path / "m"))
    assert again.labels == clf.labels and again.routing == clf.routing
    a, b = (scoring.score(lines, c).orderBy("id").collect() for c in (clf, again))
    assert a == b


def test_probabilities(lines, trained):
    scored = scoring.score_all_targets(lines, trained[0], "id").collect()
    assert len(scored) == 2400
    for r in scored[:200]:
        assert r["top"][0]["probability"] == r["confidence"]
        assert r["top"][0]["label"] == r["prediction"]
        assert [t["probability"] for t in r["top"]] == sorted((t["probability"] for t in r["top"]), reverse=True)


def test_all_targets_are_scored_in_one_scan(spark, lines, trained, tmp_path):
    lines.write.parquet(str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    plan = scoring.score_all_targets(stored, trained[0], "id")._jdf.queryExecution().executedPlan().toString()
    assert len(trained[0]) > 1 and plan.count("FileScan") == 1
    shapes = scoring.format_predictions(stored, "vendor", "id", ("json", "csv"), "line_desc")
    assert shapes._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1 and shapes.columns == ["vendor", "json", "csv"]


def test_unknown_index_shows_as_number(lines, trained):
    clf = trained[0]["account"]
    short = training.Classifier(clf.target, clf.model, clf.labels[:1], clf.routing)
    assert {r[0] for r in scoring.score(lines, short).select("prediction").distinct().collect()} == {"a0", "1"}


def test_dispatch(spark, trained):
    body = '[{"vendor": "v1", "line_desc": "item 1, big", "club": 1}, {"vendor": null, "club": 0}]'
    rows = [(1, "account", body), (2, "nope", body), (3, "account", None), (4, None, body), (5, "account", '{"a": 1}'), (6, "account", "[]")]
    requests = spark.createDataFrame(rows, "request_id int, target string, instances string")
    got = scoring.score_dispatch(requests, trained[0], "vendor string, line_desc string, club int").collect()
    ok = sorted((r["request_id"], r["position"], r["prediction"]) for r in got if r["error"] is None)
    assert ok == [(1, 0, "a1"), (1, 1, "a0")]
    bad = {r["request_id"]: r["error"] for r in got if r["error"]}
    assert set(bad) == {2, 3, 4, 5} and "account, dept" in bad[2]
    done = scoring.format_predictions(spark.createDataFrame([r for r in got if r["error"] is None], "request_id int, position int, target string, prediction string, probabilities array<double>, error string"), "request_id", "position", "object")
    assert done.first()["body"] == '{"prediction":["a1","a0"]}'


def test_dispatch_in_one_scan_equals_one_plan_per_target(spark, trained, lines, monkeypatch, tmp_path):
    """Four targets, their own models; one scan of the requests, and the answers of scoring each target by itself."""
    account, dept = (trained[0][t] for t in ("account", "dept"))
    train, val = _matrix(lines, "dept")
    boosted = training.Classifier("boosted", training.train_trees(train, rounds=3, depth=3), dept.labels, dept.routing)
    linear = training.Classifier("linear", training.train_linear(train, max_iter=5), dept.labels, dept.routing)
    models = {"account": account, "dept": dept, "boosted": boosted, "linear": linear}
    names = F.array(*[F.lit(t) for t in models])
    rows = lines.select(
        F.col("id").alias("request_id"), F.get(names, F.pmod(F.xxhash64("id"), F.lit(5)).cast("int")).alias("target"),
        F.to_json(F.array(F.struct("vendor", "line_desc", "club"))).alias("instances"),
    )
    rows.write.parquet(str(tmp_path / "requests"))
    requests = spark.read.parquet(str(tmp_path / "requests"))
    schema = "vendor string, line_desc string, club int"
    one = scoring.score_dispatch(requests, models, schema)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    monkeypatch.setattr(scoring, "batch_scorer", lambda model: None)
    apart = scoring.score_dispatch(requests, models, schema)
    order = ["request_id", "position"]
    a, b = ([r.asDict() for r in d.orderBy(*order).collect()] for d in (one, apart))
    assert len(a) == len(b) == lines.count()
    for x, y in zip(a, b, strict=True):
        p, q = x.pop("probabilities"), y.pop("probabilities")
        assert x == y and (p is None) == (q is None) and all(abs(m - n) < 1e-9 for m, n in zip(p or [], q or [], strict=True))


def _matrix(lines, target):
    split = splits.split_support_aware(lines, "id", COLUMNS, [target])
    clf = training.Classifier(target, None, [], route_features(lines.schema, COLUMNS, "A"))
    rows = clf.features(split)
    codes = training.label_map(rows)
    return [training.labelled(rows.filter(F.col("split") == s), codes, ["id"]).persist() for s in ("train", "validation")]


def test_trees(lines):
    train, val = _matrix(lines, "account")
    assert training.holdout_accuracy(training.train_trees(train, rounds=2, depth=2), val) == 1.0
    model = training.train_trees(train, val, rounds=3, depth=2, early_stop=1)
    assert training.holdout_accuracy(model, val) == 1.0
    coin = [d.withColumn("label", (F.rand(5) < 0.5).cast("double")).persist() for d in (train, val)]
    stopped = training.train_trees(*coin, rounds=15, depth=2, early_stop=1)
    assert stopped.rounds < 15
    with pytest.raises(ValueError):
        training.train_trees(train, early_stop=5)


def test_boosting_takes_any_number_of_classes(spark):
    label = (F.col("id") % 21).cast("double")
    train = spark.range(210).coalesce(2).select(label.alias("label"), array_to_vector(F.array(label)).alias("features"))
    model = training.train_trees(train, rounds=1, depth=5)
    assert len(model.priors) == 21 and model.losses[0][0] < 3.0
    got = model.transform(train).select("label", "prediction", "probability").collect()
    assert all(r["label"] == r["prediction"] and abs(sum(r["probability"]) - 1) < 1e-9 for r in got)


def test_search_keeps_the_best_within_budget(lines):
    train, val = _matrix(lines, "dept")

    def broken(data):
        raise RuntimeError("no memory")

    fits = [("weak", lambda d: training.train_linear(d, reg=100.0, one_vs_rest=False)), ("broken", broken),
            ("good", lambda d: training.train_linear(d, one_vs_rest=False)), ("never", broken)]
    model, report = training.search_best(train, val, fits, max_candidates=3)
    assert [(r[0], r[1]) for r in report] == [("weak", "Completed"), ("broken", "Failed"), ("good", "Completed"), ("never", "NotTried")]
    assert training.holdout_accuracy(model, val) > 0.95
    with pytest.raises(RuntimeError):
        training.search_best(train, val, [("broken", broken)])


def test_search_ends_what_is_over_budget(lines):
    train, val = _matrix(lines, "dept")
    naps = []

    def slow(data):
        nap = lambda rows: (time.sleep(60) or r for r in rows)
        for _ in range(3):
            naps.append(time.monotonic())
            data.rdd.mapPartitions(nap).count()

    quick = ("quick", lambda d: training.train_linear(d, one_vs_rest=False))
    began = time.monotonic()
    model, report = training.search_best(train, val, [("slow", slow), quick, ("slow again", slow), quick], max_seconds=90, max_seconds_each=12)
    assert time.monotonic() - began < 90 and len(naps) == 2
    assert [r[:2] for r in report] == [("slow", "OverBudget"), ("quick", "Completed"), ("slow again", "OverBudget"), ("quick", "Completed")]
    assert training.holdout_accuracy(model, val) > 0.95


def test_train_evaluate_register(spark, lines, tmp_path):
    noisy = lines.withColumn("noise", F.concat(F.lit("n"), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(7))))
    models, summary = train_evaluate_register(noisy, "id", COLUMNS, ["dept", "noise"], "acme", str(tmp_path))
    got = {r["target"]: (r["status"], r["registered"]) for r in summary.collect()}
    assert got == {"dept": ("Completed", True), "noise": ("Completed", False)}
    version = latest_models(spark.read.parquet(f"{tmp_path}/registry")).first()
    clf = training.Classifier.load(spark, version["path"])
    assert clf.facts["accuracy"] == version["accuracy"] == models["dept"].facts["accuracy"]


def test_encoded_variant_survives_saving(spark, lines, tmp_path):
    split = splits.split_support_aware(lines, "id", COLUMNS, ["account"])
    routing = route_features(lines.schema, COLUMNS, "B")
    models, _ = training.train_all_targets(
        split, "id", ["account"], routing, lambda a, b: training.train_trees(a, rounds=2, depth=2), variant="encoded"
    )
    clf = models["account"]
    assert clf.facts == {"accuracy": 1.0, "num_class": 2}
    clf.save(spark, str(tmp_path / "m"))
    again = training.Classifier.load(spark, str(tmp_path / "m"))
    new = lines.withColumn("vendor", F.lit("never seen"))
    a, b = (scoring.score(new, c).orderBy("id").collect() for c in (clf, again))
    assert a == b


def test_metrics_document(spark):
    df = spark.createDataFrame([("t", 0.5)], "target string, accuracy double")
    assert metrics_json(df).first()["document"] == '{"multiclass_classification_metrics":{"accuracy":{"value":0.5}}}'


def test_words_make_language_learnable(spark, sf):
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text", "lang")
    split = splits.split_support_aware(docs, "doc_id", ["text"], ["lang"])
    _, report = training.train_all_targets(
        split, "doc_id", ["lang"], FeatureRouting(text=["text"]),
        lambda a, b: training.train_linear(a, one_vs_rest=False), variant="words",
    )
    majority = docs.groupBy("lang").count().agg(F.max("count") / F.sum("count")).first()[0]
    assert report[0][2] > majority


def _cost(rows, assigned, key):
    joined = rows.join(assigned, "vec_id")
    centres = themes.centroids(joined, key, "embedding")
    near = themes.assign_nearest(joined, "vec_id", "embedding", centres)
    return near.agg(F.sum(F.col("distance") * F.col("distance"))).first()[0]


def test_kmeans_is_no_worse_than_given_clusters(spark, sf):
    rows = table(spark, sf, "embeddings")
    found = themes.kmeans_themes(rows.drop("label"), "vec_id", "embedding", k=10)
    assert found.count() == rows.count()
    given = rows.select("vec_id", F.col("label").alias("theme"))
    assert _cost(rows.drop("label"), found, "theme") <= _cost(rows.drop("label"), given, "theme")


def test_two_levels(spark, sf):
    rows = table(spark, sf, "embeddings")
    got = themes.hierarchical_themes(rows, "vec_id", "embedding", top_k=3, sub_k=3, min_sub=60)
    assert got.count() == rows.count()
    for r in themes.sub_theme_counts(got).groupBy("theme_top").agg(F.count(F.lit(1)).alias("subs"), F.sum("tickets").alias("n")).collect():
        assert r["subs"] <= min(3, max(1, r["n"] // 60))
    assert got.filter("theme_sub_id <> concat(theme_top, '.', theme_sub_local)").isEmpty()


def test_tfidf_rows_have_unit_length(spark, sf):
    docs = table(spark, sf, "documents")
    long = tfidf(docs, "doc_id", "text", max_features=300)
    norms = long.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n"))
    assert norms.filter(F.abs(F.col("n") - 1) > 1e-9).isEmpty()
    model = fit_tfidf(docs, "text", max_features=300)
    assert len(model.vocabulary) == 300 and list(model.vocabulary) == sorted(model.vocabulary)


def test_case_report(spark, sf):
    lexicon = spark.createDataFrame([("the", 1.0), ("of", -2.0)], "token string, valence double")
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("source").alias("contact"))
    events = table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("opened"), F.col("value").alias("hours"))
    report = case_report(docs.join(events, "doc_id"), "doc_id", "text", "opened", "contact", "hours", lexicon, k=3, max_features=200, z=1.0)
    n = docs.count()
    assert report["themes"].count() == n
    for part in ("sizes", "sentiment", "durations", "repeat"):
        assert report[part].agg(F.sum("tickets")).first()[0] == n
    assert report["keywords"].count() == report["sizes"].count()
    assert not report["spikes"].isEmpty()


def test_one_vs_rest_tree_probabilities(spark):
    """Scores of boosted trees agree with the members' own probabilities, scaled to one."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors

    from caseworks.operators.scoring import _probabilities

    rows = [(Vectors.dense([float(i % 3), float(i % 7)]), float(i % 3 if i % 11 else 0)) for i in range(120)]
    df = spark.createDataFrame(rows, ["features", "label"])
    model = OneVsRest(classifier=GBTClassifier(maxIter=3, maxDepth=2)).fit(df)
    found = model.transform(df).select("features", _probabilities(model).alias("p")).limit(20).collect()
    for r in found:
        own = [float(m.predictProbability(r["features"])[1]) for m in model.models]
        assert r["p"] == pytest.approx([p / sum(own) for p in own], abs=1e-9)


def test_encoded_run_fits_encoders_after_the_split(spark, sf, tmp_path):
    from caseworks.plans.multi_target import train_evaluate_register
    from caseworks.sources.readers import table

    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    models, summary = train_evaluate_register(
        parts, "p_partkey", ["p_brand", "p_size"], ["p_type"], "c", str(tmp_path), threshold=0.0, variant="encoded"
    )
    assert list(models) == ["p_type"] and models["p_type"].encoders and summary.count() == 1
