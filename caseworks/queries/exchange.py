"""Sources, sinks, checks and the registry: tables written through a sink, read back with its source, and compared."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from caseworks.operators import cases, durations, features, registry, scoring, splits, themes, training
from caseworks.queries.common import split_sql, table
from caseworks.queries.models import _latest_sql, _versions
from caseworks.queries.records import PART_FEATURES, SUPPORT_QUOTA
from caseworks.session import checkpoint_folder
from caseworks.sources import checks, readers, writers


def _place(spark, name):
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _numbers(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")


# Sources and sinks


def csv_cases(spark, sf):
    """Customers with quotes, commas and line breaks in a field."""
    noted = F.concat(F.lit('"'), F.col("c_name"), F.lit('",\n'), F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select("c_custkey", noted.alias("note"), "c_acctbal")
    path = _place(spark, "cases-csv")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return readers.read_cases_csv(spark, path, "c_custkey long, note string, c_acctbal double")


def csv_cases_inferred(spark, sf):
    """Types found by reading: whole numbers, numbers and text."""
    path = _place(spark, "inferred-csv")
    table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.option("header", True).csv(path)
    return readers.read_cases_csv(spark, path).select(F.col("s_suppkey").cast("long"), "s_name", F.col("s_nationkey").cast("int"))


def json_record_files(spark, sf):
    """A document per thousand order numbers, which holds an array of their orders."""
    orders = table(spark, sf, "orders")
    record = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    place = F.floor(F.col("o_orderkey") / 1000).alias("thousand")
    bodies = orders.groupBy(place).agg(F.to_json(F.collect_list(record)).alias("value"))
    path = _place(spark, "records-json")
    bodies.write.partitionBy("thousand").text(path)
    return readers.read_json_records(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double").drop("thousand")


def case_table(spark, sf):
    path = _place(spark, "cases")
    writers.write_cases(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), path)
    return spark.read.parquet(path)


def split_files(spark, sf):
    """Splits of three targets as CSV folders."""
    split = splits.split_support_aware(table(spark, sf, "part"), "p_partkey", PART_FEATURES, ["p_type", "p_brand", "p_size"])
    path = _place(spark, "splits")
    writers.write_splits(split.select("p_partkey", "label", "target", "split"), path)
    return spark.read.option("header", True).schema("p_partkey long, label string, target string, split string").csv(path)


def label_first_csv(spark, sf):
    path = _place(spark, "label-first")
    writers.write_label_first_csv(_numbers(spark, sf), "p_partkey", ["p_size", "p_retailprice"], path)
    return spark.read.schema("p_partkey long, p_size double, p_retailprice double").csv(path)


def label_last_csv(spark, sf):
    """The same from a vector column, header and label at the end."""
    rows = _numbers(spark, sf)
    path = _place(spark, "label-last")
    vector = array_to_vector(F.array(F.col("p_size").cast("double"), "p_retailprice"))
    writers.write_label_last_csv(rows.select("p_partkey", vector.alias("v")), "p_partkey", "v", path, size=2)
    return spark.read.option("header", True).schema("f0 double, f1 double, target long").csv(path)


def libsvm_files(spark, sf):
    path = _place(spark, "libsvm")
    vector = array_to_vector(F.array(F.col("p_size").cast("double"), "p_retailprice"))
    writers.write_libsvm(_numbers(spark, sf).select("p_partkey", vector.alias("features")), path, label="p_partkey")
    values = vector_to_array("features")
    back = readers.read_libsvm(spark, path, 2)
    return back.select(F.col("label").cast("long").alias("p_partkey"), values[0].alias("p_size"), values[1].alias("p_retailprice"))


def manifest_file(spark, sf):
    prepared = splits.prepare_per_target(table(spark, sf, "part"), "p_partkey", ["p_name"], ["p_type", "p_brand"])
    path = _place(spark, "manifest")
    writers.write_manifest(prepared, "out", path)
    body = F.from_json("value", "total_rows long, targets map<string, struct<rows: long, unique_labels: long, output_path: string>>")
    listed = spark.read.text(path).select(F.explode(body["targets"]).alias("target", "of"))
    return listed.select("target", "of.rows", "of.unique_labels", "of.output_path")


# Checks


def _outcome(check) -> str:
    try:
        check()
    except ValueError as error:
        return str(error)
    return "passed"


def failed_checks(spark, sf):
    """What each check says of tables that pass and of tables that don't."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    lined = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    found = [
        ("columns", _outcome(lambda: checks.require_columns(orders, ["o_orderdate"], ["o_orderstatus"]))),
        ("missing column", _outcome(lambda: checks.require_columns(orders.select("o_orderkey"), ["o_orderdate"], ["o_orderkey"]))),
        ("classes", _outcome(lambda: checks.require_classes(orders, "o_orderstatus", 2))),
        ("too few classes", _outcome(lambda: checks.require_classes(orders, "o_orderstatus", 9))),
        ("same keys", _outcome(lambda: checks.require_same_keys(orders, orders, "o_orderkey"))),
        ("other keys", _outcome(lambda: checks.require_same_keys(orders, lined, "o_orderkey"))),
    ]
    return spark.createDataFrame(found, "name string, outcome string")


def classes_outside_train(spark, sf):
    """Sizes up to ten are only on the other side."""
    side = F.when(F.col("p_size") > 10, "train").otherwise("validation")
    rows = table(spark, sf, "part").select(F.lit("p_size").alias("target"), F.col("p_size").cast("string").alias("label"), side.alias("split"))
    return checks.classes_outside_train(rows)


# Registry, names, classes


def registered_models(spark, sf):
    """The versions of all orders appended in one write, one more by itself, and the newest approved ones."""
    path = _place(spark, "registry")
    registry.register_all(_versions(spark, sf), path)
    registry.register(spark, path, "extra", "color", "models/extra", 0.9)
    return registry.latest_models(spark.read.parquet(path)).select("client", "target", "group_name", "path", "accuracy")


def stripped_headers(spark, sf):
    """Names with blanks around them, features and one target kept."""
    padded = table(spark, sf, "part").toDF(" p_partkey", "p_name ", " p_brand ", "p_type", "p_size", "p_retailprice")
    return splits.select_for_target(cases.strip_headers(padded), ["p_partkey", "p_name"], "p_brand")


def theme_column(spark, sf):
    """The first theme column by name, counted."""
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("theme_cluster_a"), F.lit(0).alias("theme_cluster_b"))
    return themes.cluster_counts(rows, durations.theme_column(rows.columns))


def num_class(spark, sf):
    labels = features.label_map(table(spark, sf, "part").select(F.col("p_brand").alias("label")))
    return spark.createDataFrame([(features.num_class(labels),)], "classes int")


def score_binary(spark, sf):
    """Two classes: the pair [1 - p, p] of every part, and what it says."""
    tier = F.when(F.col("p_type").isin("ECONOMY", "PROMO", "SMALL"), "low").otherwise("high")
    parts = table(spark, sf, "part").select("p_partkey", "p_type", tier.alias("tier"))
    split = splits.split_support_aware(parts, "p_partkey", ["p_type"], ["tier"])
    routing = features.route_features(parts.schema, ["p_type"], "A")
    models, report = training.train_all_targets(split, "p_partkey", ["tier"], routing, lambda train, val: training.train_linear(train))
    if not models:
        raise RuntimeError(f"not trained: {report}")
    pair = F.col("probabilities")
    return scoring.score(parts, models["tier"]).select(
        "p_partkey", "prediction", F.round(pair[0] + pair[1], 6).alias("total"), F.when(pair[1] > pair[0], "low").otherwise("high").alias("by_pair")
    )


_TIER = "CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'low' ELSE 'high' END"
QUERIES = {
    "csv_cases": (csv_cases, """SELECT c_custkey, '"' || c_name || '",' || chr(10) || c_mktsegment AS note, c_acctbal FROM customer"""),
    "csv_cases_inferred": (csv_cases_inferred, "SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey FROM supplier"),
    "json_record_files": (json_record_files, "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"),
    "case_table": (case_table, "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders"),
    "split_files": (
        split_files,
        "WITH "
        + split_sql(
            " UNION ALL ".join(f"SELECT p_partkey, '{t}' AS target, CAST({t} AS VARCHAR) AS label FROM part" for t in ("p_type", "p_brand", "p_size")),
            "p_partkey",
            SUPPORT_QUOTA,
        )
        + " SELECT p_partkey, label, target, split FROM s",
    ),
    "label_first_csv": (label_first_csv, "SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part"),
    "label_last_csv": (label_last_csv, "SELECT p_size::DOUBLE AS f0, p_retailprice AS f1, p_partkey AS target FROM part"),
    "libsvm_files": (libsvm_files, "SELECT p_partkey, p_size::DOUBLE AS p_size, p_retailprice FROM part"),
    "manifest_file": (
        manifest_file,
        """SELECT 'p_type' AS target, count(*) AS rows, count(DISTINCT p_type) AS unique_labels, 'out/target=p_type' AS output_path FROM part WHERE p_type IS NOT NULL
UNION ALL SELECT 'p_brand', count(*), count(DISTINCT p_brand), 'out/target=p_brand' FROM part WHERE p_brand IS NOT NULL""",
    ),
    "failed_checks": (
        failed_checks,
        """WITH k AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1), l AS (SELECT l_orderkey, count(*) AS m FROM lineitem GROUP BY 1),
odd AS (SELECT count(*) AS n FROM k FULL JOIN l ON o_orderkey = l_orderkey WHERE n IS DISTINCT FROM m)
SELECT name, 'passed' AS outcome FROM (VALUES ('columns'), ('classes'), ('same keys')) t(name)
UNION ALL SELECT 'missing column', 'missing feature columns [''o_orderdate''], missing target columns []; found [''o_orderkey'']'
UNION ALL SELECT 'too few classes', 'target o_orderstatus needs at least 9 classes, found ' || count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'other keys', n || ' values of o_orderkey do not match between the two tables' FROM odd""",
    ),
    "classes_outside_train": (
        classes_outside_train, "SELECT DISTINCT 'p_size' AS target, CAST(p_size AS VARCHAR) AS label FROM part WHERE p_size <= 10"
    ),
    "registered_models": (
        registered_models,
        f"""SELECT client, target, client || '-' || target || '-models' AS group_name, path, accuracy FROM ({_latest_sql("status = 'Approved'")})
UNION ALL SELECT 'extra', 'color', 'extra-color-models', 'models/extra', 0.9""",
    ),
    "stripped_headers": (stripped_headers, "SELECT p_partkey, p_name, p_brand FROM part"),
    "theme_column": (theme_column, "SELECT label AS theme, count(*) AS tickets FROM embeddings GROUP BY 1"),
    "num_class": (num_class, "SELECT CAST(count(DISTINCT p_brand) AS INTEGER) AS classes FROM part"),
    "score_binary": (score_binary, f"SELECT p_partkey, {_TIER} AS prediction, 1.0::DOUBLE AS total, {_TIER} AS by_pair FROM part"),
}
