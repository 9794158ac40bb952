"""Training, evaluation, registry, scoring, capture and streaming."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from caseworks.operators import evaluation, registry, scoring, splits, training
from caseworks.operators.features import FeatureRouting, featurize_words, label_map, route_features
from caseworks.queries.common import r6, split_sql, table
from caseworks.queries.records import PART_FEATURES, SUPPORT_QUOTA
from caseworks.session import checkpoint_folder
from caseworks.streaming import jobs

ORDER_TARGETS = ["o_orderstatus", "o_orderpriority"]


# Training (the language of a document is learnable from its words)


def _language_split(spark, sf):
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text", "lang")
    return splits.split_support_aware(docs, "doc_id", ["text"], ["lang"])


@contextmanager
def _train_val(spark, sf, buckets=2_000):
    split = _language_split(spark, sf)
    rows = featurize_words(split, FeatureRouting(text=["text"]), buckets).select("doc_id", "label", "split", "features").persist()
    codes = label_map(rows.filter("split = 'train'"))
    train, val = (training.labelled(rows.filter(F.col("split") == side), codes, ["doc_id"]) for side in ("train", "validation"))
    try:
        yield train, val
    finally:
        rows.unpersist()


def _report(spark, val, rows):
    """(candidate, status, accuracy) rows against the majority share of the validation rows."""
    counts = val.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    facts = counts.agg(F.sum("n").alias("rows"), (F.max("n") / F.sum("n")).alias("majority")).first()
    lines = [(name, status, score is not None and bool(score > facts["majority"]), facts["rows"]) for name, status, score in rows]
    return spark.createDataFrame(lines, "candidate string, status string, beats_majority boolean, validation_rows long")


def train_linear(spark, sf):
    with _train_val(spark, sf) as (train, val):
        model = training.train_linear(train)
        return _report(spark, val, [("linear", "Completed", training.holdout_accuracy(model, val))])


def train_trees(spark, sf):
    with _train_val(spark, sf) as (train, val):
        model = training.train_trees(train, val, rounds=200, depth=6, early_stop=5, tolerance=0.02)
        return _report(spark, val, [("trees", "Completed", training.holdout_accuracy(model, val))])


def search_best(spark, sf):
    candidates = [
        ("multinomial", lambda data: training.train_linear(data, one_vs_rest=False)),
        ("penalised", lambda data: training.train_linear(data, reg=0.01, one_vs_rest=False)),
        ("beyond the limit", lambda data: training.train_trees(data)),
    ]
    with _train_val(spark, sf) as (train, val):
        _, report = training.search_best(train, val, candidates, max_candidates=2)
        return _report(spark, val, [(name, status, score) for name, status, score, _, _ in report])


def _part_words(spark, sf, trainer):
    """The last word of a part's name, learned from its words and type in 2,000 buckets; the predictions of all parts."""
    words = F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("size"), "p_size"))
    parts = table(spark, sf, "part").select("p_partkey", words.alias("line_text"), F.element_at(F.split("p_name", " "), -1).alias("kind"))
    split = splits.split_support_aware(parts, "p_partkey", ["line_text"], ["kind"])
    routing = FeatureRouting(text=["line_text"])
    models, report = training.train_all_targets(split, "p_partkey", ["kind"], routing, trainer, variant="words")
    if not models:
        raise RuntimeError(f"not trained: {report}")
    return scoring.score(parts, models["kind"]).select("p_partkey", "prediction", F.size("probabilities").alias("classes"))


def train_trees_parts(spark, sf):
    return _part_words(spark, sf, lambda train, val: training.train_trees(train, val, rounds=200, depth=6, early_stop=10, tolerance=0.01))


def train_linear_parts(spark, sf):
    return _part_words(spark, sf, lambda train, val: training.train_linear(train))


def train_trees_lines(spark, sf):
    """Four kinds of order lines that follow from quantity, discount and tax together; the predictions of all lines."""
    kind = F.when((F.col("l_quantity") > 30) & (F.col("l_discount") > 0.055), "bulk deal").when(
        (F.col("l_quantity") > 30) & (F.col("l_tax") > 0.045), "bulk taxed"
    )
    kind = kind.when((F.col("l_quantity") <= 12) & (F.col("l_discount") <= 0.025), "small full").otherwise("plain")
    columns = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    lines = table(spark, sf, "lineitem").select("l_orderkey", *columns, kind.alias("kind"))
    lines = lines.withColumn("line_id", F.concat_ws("-", "l_orderkey", "l_linenumber", F.xxhash64(*columns)))
    split = splits.split_support_aware(lines, "line_id", columns, ["kind"])
    trainer = lambda train, val: training.train_trees(train, rounds=12, depth=6, eta=0.4)
    models, report = training.train_all_targets(split, "line_id", ["kind"], FeatureRouting(numeric=columns), trainer)
    if not models:
        raise RuntimeError(f"not trained: {report}")
    return scoring.score(lines, models["kind"]).groupBy("l_orderkey", "l_linenumber", "prediction").agg(F.count(F.lit(1)).alias("lines"))


def train_trees_nations(spark, sf):
    """Boosted trees with a class per nation, learnable from the nation's number; the predictions of all customers."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(F.broadcast(nations), "c_nationkey")
    rows = rows.select("c_custkey", "c_nationkey", "n_name")
    split = splits.split_support_aware(rows, "c_custkey", ["c_nationkey"], ["n_name"])
    routing = FeatureRouting(numeric=["c_nationkey"])
    trainer = lambda train, val: training.train_trees(train, val, rounds=200, depth=6, early_stop=10, tolerance=0.01)
    models, report = training.train_all_targets(split, "c_custkey", ["n_name"], routing, trainer)
    if not models:
        raise RuntimeError(f"not trained: {report}")
    best = F.array_position("probabilities", F.array_max("probabilities"))
    scored = scoring.score(rows, models["n_name"])
    return scored.select(
        "c_custkey", "prediction", F.size("probabilities").alias("classes"),
        (F.element_at(scoring._label_array(models["n_name"].labels), best.cast("int")) == F.col("prediction")).alias("is_best"),
    )


CUSTOMER_FEATURES = ["c_mktsegment", "c_acctbal"]
CUSTOMER_TARGETS = ["desk", "letter"]


def _customers(spark, sf):
    """Customers with two codes that follow from the segment, so a sound model predicts them exactly."""
    segment = F.col("c_mktsegment")
    desk = F.when(segment.isin("AUTOMOBILE", "MACHINERY"), "industry").when(segment == "BUILDING", "site").otherwise("home")
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", *CUSTOMER_FEATURES, desk.alias("desk"), F.substring("c_mktsegment", 1, 1).alias("letter")
    )


def _customer_models(spark, sf):
    rows = _customers(spark, sf)
    split = splits.split_support_aware(rows, "c_custkey", CUSTOMER_FEATURES, CUSTOMER_TARGETS)
    routing = route_features(rows.schema, CUSTOMER_FEATURES, "A")
    trainer = lambda train, val: training.train_linear(train, one_vs_rest=False)
    return rows, training.train_all_targets(split, "c_custkey", CUSTOMER_TARGETS, routing, trainer, parallel=2)


def train_all_targets(spark, sf):
    _, (_, report) = _customer_models(spark, sf)
    return spark.createDataFrame(report, "target string, status string, accuracy double, error string")


def train_part_targets(spark, sf):
    """Two codes that follow from the type of a part, the size beside it; the predictions of all parts."""
    cheap = F.col("p_type").isin("ECONOMY", "PROMO", "SMALL")
    parts = table(spark, sf, "part").select(
        "p_partkey", "p_type", "p_size", F.when(cheap, "low").otherwise("high").alias("tier"), F.substring("p_type", 1, 2).alias("code")
    )
    split = splits.split_support_aware(parts, "p_partkey", ["p_type", "p_size"], ["tier", "code"])
    routing = route_features(parts.schema, ["p_type", "p_size"], "A")
    trainer = lambda train, val: training.train_linear(train, one_vs_rest=False)
    models, report = training.train_all_targets(split, "p_partkey", ["tier", "code"], routing, trainer, parallel=2)
    if len(models) < 2:
        raise RuntimeError(f"not trained: {report}")
    return scoring.score_all_targets(parts, models, "p_partkey").select("p_partkey", "target", "prediction")


# Evaluation: predictions by a fixed rule on orders


def _predictions(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", *ORDER_TARGETS)
    long = splits.melt_targets(orders, "o_orderkey", ["o_totalprice"], ORDER_TARGETS)
    guess = F.when(F.col("target") == "o_orderstatus", F.when(F.col("o_totalprice") < 100000, " F").otherwise("O ")).otherwise("1-URGENT")
    return long.withColumn("prediction", guess)


def accuracy(spark, sf):
    found = evaluation.accuracy(_predictions(spark, sf), "label", "prediction", by=["target"])
    return found.withColumn("accuracy", r6("accuracy"))


def baseline_accuracy(spark, sf):
    found = evaluation.evaluate_vs_baseline(_predictions(spark, sf), "o_orderkey", n_samples=500)
    return found.select("target", "rows", "classes", r6("accuracy").alias("accuracy"), r6("baseline").alias("baseline"))


def baseline_accuracy_all(spark, sf):
    found = evaluation.evaluate_vs_baseline(_predictions(spark, sf), "o_orderkey", n_samples=None)
    return found.select("target", "rows", "classes", r6("accuracy").alias("accuracy"), r6("baseline").alias("baseline"))


def metrics_json(spark, sf):
    scores = evaluation.accuracy(_predictions(spark, sf), "label", "prediction", by=["target"])
    fixed = scores.select("target", F.format_number("accuracy", 4).cast("double").alias("accuracy"), F.lit("rule").alias("candidate_name"))
    shapes = [
        evaluation.metrics_json(fixed, layout).withColumn("layout", F.lit(layout)) for layout in ("nested", "by_target", "candidate")
    ]
    return shapes[0].unionByName(shapes[1]).unionByName(shapes[2])


def _supplier_metrics(spark, sf):
    """Each supplier plays a candidate: return flags are metric names, mean discount the value."""
    named = F.when(F.col("l_returnflag") == "A", "Accuracy").when(F.col("l_returnflag") == "N", "F1").otherwise("LogLoss")
    lines = table(spark, sf, "lineitem").select("l_suppkey", named.alias("name"), "l_discount")
    return lines.groupBy("l_suppkey", "name").agg(r6(F.avg("l_discount")).alias("value"))


def candidate_metrics(spark, sf):
    found = evaluation.candidate_metrics(_supplier_metrics(spark, sf), "l_suppkey", "name", "value")
    return found.select("candidate", "accuracy", F.size("metrics").alias("metrics"))


def run_summary(spark, sf):
    """Every order is a run: finished orders completed, open ones failed with an error."""
    runs = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("target"),
        F.concat(F.lit("job-"), F.col("o_orderkey")).alias("job"),
        F.lit(None).cast("string").alias("status"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderstatus").alias("candidate"),
        F.when(F.col("o_orderstatus") == "O", F.lit("out of time")).alias("error"),
    )
    return evaluation.run_summary(runs)


# Registry: every order is a model version of (customer segment, priority)


def _versions(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_mktsegment").alias("client"),
        F.col("o_orderpriority").alias("target"),
        F.concat(F.lit("models/"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("path"),
        (F.pmod("o_orderkey", F.lit(101)) / 100.0).alias("accuracy"),
        F.when(F.col("o_orderstatus") == "F", "Approved").otherwise("PendingManualApproval").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def register_gate(spark, sf):
    return registry.gate(_versions(spark, sf)).select(
        registry.group_name(F.col("client"), F.col("target")).alias("group_name"), "path", "accuracy"
    )


def latest_models(spark, sf):
    return registry.latest_models(_versions(spark, sf))


def latest_models_any_status(spark, sf):
    return registry.latest_models(_versions(spark, sf), approved_only=False)


def check_bundles(spark, sf):
    kind = F.when(F.col("l_returnflag") == "A", "model").when(F.col("l_returnflag") == "N", "features").otherwise("labels")
    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("target"), kind.alias("kind"))
    return registry.check_bundles(files)


# Scoring


def score(spark, sf):
    rows, (models, _) = _customer_models(spark, sf)
    total = F.aggregate("probabilities", F.lit(0.0), lambda acc, p: acc + p)
    scored = scoring.score(rows, models["desk"])
    return scored.select("c_custkey", "prediction", F.size("probabilities").alias("classes"), r6(total).alias("total"))


def score_all_targets(spark, sf):
    rows, (models, _) = _customer_models(spark, sf)
    found = scoring.score_all_targets(rows, models, "c_custkey")
    best = F.col("top")[0]
    return found.select(
        "c_custkey", "target", "prediction", best["label"].alias("best"), F.size("top").alias("listed"),
        (best["probability"] == F.col("confidence")).alias("is_best"),
    )


def score_dispatch(spark, sf):
    """One request per customer; the nation decides whether its target is known, unknown or absent, or the body broken."""
    rows, (models, _) = _customer_models(spark, sf)
    nation = F.col("c_nationkey")
    target = F.when(nation < 5, "color").when(nation >= 10, F.when(nation < 18, "desk").otherwise("letter"))
    record = F.struct("c_mktsegment", "c_acctbal")
    requests = rows.select(
        F.col("c_custkey").alias("request_id"), target.alias("target"),
        F.when(nation != 12, F.to_json(F.array(record, record))).alias("instances"),
    )
    found = scoring.score_dispatch(requests, models, "c_mktsegment: string, c_acctbal: double")
    return found.select("request_id", "position", "target", "prediction", "error")


def format_predictions(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return scoring.format_predictions(lines, "l_orderkey", "l_linenumber", ("json", "csv", "object"), "l_returnflag")


def to_csv_line(spark, sf):
    noted = F.concat_ws(", ", "c_mktsegment", F.concat(F.lit('"'), F.col("c_name"), F.lit('"')))
    rows = table(spark, sf, "customer")
    return rows.select("c_custkey", scoring.to_csv_line(["c_name", noted, "c_nationkey"]).alias("line"))


def capture(spark, sf):
    """A tenth of all orders with their rule-based predictions."""
    predicted = _predictions(spark, sf).filter(F.col("target") == "o_orderstatus")
    return scoring.captured(predicted, "o_orderkey", 10).select("o_orderkey", "label", "prediction")


# Streaming over the event files


def _event_stream(spark, sf, base):
    """The events in three files that overlap in time by a day, one file a trigger."""
    events = table(spark, sf, "events")
    shifted = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(86_400_000_000))
    cuts = events.select(F.percentile_approx(shifted, [1 / 3, 2 / 3], 10_000).alias("c")).first()["c"]
    for number in range(3):
        low, high = (cuts[number - 1] if number else None), (cuts[number] if number < 2 else None)
        inside = (F.lit(True) if low is None else shifted > low) & (F.lit(True) if high is None else shifted <= high)
        events.filter(inside).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")


def stream_daily_volume(spark, sf):
    base = f"{checkpoint_folder(spark)}/volume-{uuid.uuid4().hex}"
    jobs.stream_daily_volume(_event_stream(spark, sf, base), "ts", "event_type", f"{base}/out", f"{base}/state").awaitTermination()
    return jobs.daily_volume_so_far(spark, f"{base}/out")


def stream_repeat(spark, sf):
    """Three triggers whose files overlap by a day; rows wait for two."""
    base = f"{checkpoint_folder(spark)}/repeat-{uuid.uuid4().hex}"
    stream = _event_stream(spark, sf, base)
    names = ("user_id", "ts", "event_id", f"{base}/out")
    jobs.stream_repeat(stream, *names, f"{base}/state", lateness_hours=48).awaitTermination()
    found = jobs.repeat_so_far(spark, stream.schema, *names)
    return found.select("event_id", r6("hours_since_prev").alias("hours_since_prev"), "is_repeat")


def stream_score(spark, sf):
    """Customers arrive as a stream, are scored with the current model, and all are captured."""
    _, (models, _) = _customer_models(spark, sf)
    stream = spark.readStream.schema(table(spark, sf, "customer").schema).parquet(f"{sf}/customer*.parquet")
    base = f"{checkpoint_folder(spark)}/score-{uuid.uuid4().hex}"
    inputs = stream.select("c_custkey", *CUSTOMER_FEATURES)
    jobs.stream_score(inputs, lambda: models["desk"], "c_custkey", f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema("c_custkey long, prediction string").json(f"{base}/out").select("c_custkey", "prediction")


_DESK = "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'industry' WHEN c_mktsegment = 'BUILDING' THEN 'site' ELSE 'home' END"
_LETTER = "left(c_mktsegment, 1)"
_UNKNOWN = "'unknown target ''color''; available: desk, letter'"
_EXPECTED = "'expected a target and a list of instances'"
PRED_SQL = """
p AS (
  SELECT o_orderkey, 'o_orderstatus' AS target, o_orderstatus AS label, CASE WHEN o_totalprice < 100000 THEN 'F' ELSE 'O' END AS pred FROM orders
  UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, '1-URGENT' FROM orders
)"""
_BASELINE = """
k AS (SELECT target, label, count(*) AS n, count(*) FILTER (label = pred) AS h FROM v GROUP BY 1, 2)
SELECT target, CAST(sum(n) AS BIGINT) AS rows, count(*) AS classes, round(sum(h) / sum(n)::DOUBLE, 6) AS accuracy,
       round(max(n) / sum(n)::DOUBLE, 6) AS baseline FROM k GROUP BY target"""
_VERSIONS = """
v AS (
  SELECT c_mktsegment AS client, o_orderpriority AS target, 'models/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS path,
         (o_orderkey % 101) / 100.0 AS accuracy, CASE WHEN o_orderstatus = 'F' THEN 'Approved' ELSE 'PendingManualApproval' END AS status,
         o_orderdate AS created_at
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def _latest_sql(condition: str) -> str:
    return f"""WITH {_VERSIONS},
r AS (SELECT *, row_number() OVER (PARTITION BY client, target ORDER BY created_at DESC, path DESC) AS rk FROM v WHERE {condition})
SELECT client, target, created_at, path, CAST(accuracy AS DOUBLE) AS accuracy, status FROM r WHERE rk = 1"""


_HOURS = """
WITH h AS (
  SELECT event_id, date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 3.6e9 AS hours FROM events
)
SELECT event_id, round(hours, 6) AS hours_since_prev, coalesce(hours <= 168, false) AS is_repeat FROM h"""

def _trained_sql(*candidates: str, untried: tuple[str, ...] = ()) -> str:
    done = [f"('{c}', 'Completed', true)" for c in candidates]
    names = ", ".join([*done, *[f"('{c}', 'NotTried', false)" for c in untried]])
    return f"""WITH {split_sql("SELECT doc_id, 'lang' AS target, lang AS label FROM documents", "doc_id", SUPPORT_QUOTA)}
SELECT candidate, status, beats_majority, count(*) AS validation_rows
FROM s CROSS JOIN (VALUES {names}) c(candidate, status, beats_majority) WHERE split = 'validation' GROUP BY ALL"""


QUERIES = {
    "train_linear": (train_linear, _trained_sql("linear")),
    "train_trees": (train_trees, _trained_sql("trees")),
    "search_best": (search_best, _trained_sql("multinomial", "penalised", untried=("beyond the limit",))),
    "train_trees_parts": (
        train_trees_parts,
        "SELECT p_partkey, split_part(p_name, ' ', -1) AS prediction, CAST((SELECT count(DISTINCT split_part(p_name, ' ', -1)) FROM part) AS INTEGER) AS classes FROM part",
    ),
    "train_linear_parts": (
        train_linear_parts,
        "SELECT p_partkey, split_part(p_name, ' ', -1) AS prediction, CAST((SELECT count(DISTINCT split_part(p_name, ' ', -1)) FROM part) AS INTEGER) AS classes FROM part",
    ),
    "train_trees_lines": (
        train_trees_lines,
        """SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity > 30 AND l_discount > 0.055 THEN 'bulk deal' WHEN l_quantity > 30 AND l_tax > 0.045 THEN 'bulk taxed'
            WHEN l_quantity <= 12 AND l_discount <= 0.025 THEN 'small full' ELSE 'plain' END AS prediction, count(*) AS lines
FROM lineitem GROUP BY ALL""",
    ),
    "train_trees_nations": (
        train_trees_nations,
        """SELECT c_custkey, n_name AS prediction, CAST((SELECT count(DISTINCT c_nationkey) FROM customer) AS INTEGER) AS classes, true AS is_best
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "train_all_targets": (
        train_all_targets,
        "SELECT target, 'Completed' AS status, 1.0::DOUBLE AS accuracy, CAST(NULL AS VARCHAR) AS error FROM (VALUES ('desk'), ('letter')) t(target)",
    ),
    "train_part_targets": (
        train_part_targets,
        """SELECT p_partkey, 'tier' AS target, CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'low' ELSE 'high' END AS prediction FROM part
UNION ALL SELECT p_partkey, 'code', left(p_type, 2) FROM part""",
    ),
    "accuracy": (
        accuracy,
        f"WITH {PRED_SQL} SELECT target, count(*) AS rows, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY 1",
    ),
    "baseline_accuracy": (
        baseline_accuracy,
        f"""WITH {PRED_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat(o_orderkey, '-42')), o_orderkey) AS rn FROM p),
v AS (SELECT * FROM r WHERE rn <= 500), {_BASELINE}""",
    ),
    "baseline_accuracy_all": (baseline_accuracy_all, f"WITH {PRED_SQL}, v AS (SELECT * FROM p), {_BASELINE}"),
    "metrics_json": (
        metrics_json,
        f"""WITH {PRED_SQL},
a AS (SELECT target, CAST(round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 4) AS VARCHAR) AS x FROM p GROUP BY 1)
SELECT target, '{{"multiclass_classification_metrics":{{"accuracy":{{"value":' || x || '}}}}}}' AS document, 'nested' AS layout FROM a
UNION ALL SELECT target, '{{"' || target || '":{{"accuracy":' || x || '}}}}', 'by_target' FROM a
UNION ALL SELECT target, '{{"metrics":{{"accuracy":{{"value":' || x || '}}}},"candidate_name":"rule"}}', 'candidate' FROM a""",
    ),
    "candidate_metrics": (
        candidate_metrics,
        """WITH m AS (SELECT l_suppkey, l_returnflag, round(avg(l_discount), 6) AS v FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey AS candidate, coalesce(max(v) FILTER (l_returnflag = 'A'), 0.0) AS accuracy, CAST(count(*) AS INTEGER) AS metrics FROM m GROUP BY 1""",
    ),
    "run_summary": (
        run_summary,
        """SELECT o_orderpriority AS target, 'job-' || o_orderkey AS job,
       CASE WHEN o_orderstatus = 'O' THEN 'Error' ELSE 'Completed' END AS status,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS best_metric,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS candidate,
       CASE WHEN o_orderstatus = 'O' THEN 'out of time' END AS error FROM orders""",
    ),
    "register_gate": (
        register_gate,
        f"WITH {_VERSIONS} SELECT client || '-' || target || '-models' AS group_name, path, CAST(accuracy AS DOUBLE) AS accuracy FROM v WHERE accuracy >= 0.7",
    ),
    "latest_models": (latest_models, _latest_sql("status = 'Approved'")),
    "latest_models_any_status": (latest_models_any_status, _latest_sql("true")),
    "check_bundles": (
        check_bundles,
        """WITH k AS (SELECT l_orderkey AS target, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n,
          count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS r FROM lineitem GROUP BY 1)
SELECT target, concat_ws(',', CASE WHEN n = 0 THEN 'features' END, CASE WHEN r = 0 THEN 'labels' END, CASE WHEN a = 0 THEN 'model' END) AS missing,
       a > 0 AND n > 0 AND r > 0 AS complete FROM k""",
    ),
    "score": (score, f"SELECT c_custkey, {_DESK} AS prediction, 3 AS classes, 1.0::DOUBLE AS total FROM customer"),
    "score_all_targets": (
        score_all_targets,
        f"""SELECT c_custkey, 'desk' AS target, {_DESK} AS prediction, {_DESK} AS best, 3 AS listed, true AS is_best FROM customer
UNION ALL SELECT c_custkey, 'letter', {_LETTER}, {_LETTER}, 3, true FROM customer""",
    ),
    "score_dispatch": (
        score_dispatch,
        f"""SELECT c_custkey AS request_id, CAST(i AS INTEGER) AS position, CASE WHEN c_nationkey < 18 THEN 'desk' ELSE 'letter' END AS target,
       CASE WHEN c_nationkey < 18 THEN {_DESK} ELSE {_LETTER} END AS prediction, CAST(NULL AS VARCHAR) AS error
FROM customer CROSS JOIN (VALUES (0), (1)) p(i) WHERE c_nationkey >= 10 AND c_nationkey <> 12
UNION ALL SELECT c_custkey, NULL, CASE WHEN c_nationkey < 5 THEN 'color' WHEN c_nationkey = 12 THEN 'desk' END, NULL,
       CASE WHEN c_nationkey < 5 THEN {_UNKNOWN} ELSE {_EXPECTED} END
FROM customer WHERE c_nationkey < 10 OR c_nationkey = 12""",
    ),
    "format_predictions": (
        format_predictions,
        """WITH l AS (SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS csv FROM lineitem GROUP BY 1)
SELECT l_orderkey, '["' || replace(csv, ',', '","') || '"]' AS json, csv, '{"prediction":["' || replace(csv, ',', '","') || '"]}' AS object FROM l""",
    ),
    "to_csv_line": (
        to_csv_line,
        '''SELECT c_custkey, c_name || ',"' || c_mktsegment || ', ""' || c_name || '""",' || c_nationkey AS line FROM customer''',
    ),
    "capture": (
        capture,
        """SELECT o_orderkey, o_orderstatus AS label, CASE WHEN o_totalprice < 100000 THEN ' F' ELSE 'O ' END AS prediction
FROM orders WHERE ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 10000 < 1000""",
    ),
    "stream_daily_volume": (
        stream_daily_volume,
        """SELECT CAST(ts AS DATE) AS day, event_type AS theme, count(*) AS count FROM events GROUP BY 1, 2""",
    ),
    "stream_repeat": (stream_repeat, _HOURS),
    "stream_score": (stream_score, f"SELECT c_custkey, {_DESK} AS prediction FROM customer"),
}
