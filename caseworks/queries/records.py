"""Cleaning, coded records, splits and features."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from caseworks.functions import clean
from caseworks.operators import cases, features, splits
from caseworks.operators.profile import split_report as report
from caseworks.operators.tfidf import vector_entries
from caseworks.queries.common import DOCLABELS_SQL, labelled_documents, r6, split_sql, table
from caseworks.sources.readers import columns_json_to_rows, parse_json_records

PART_FEATURES = ["p_brand", "p_name", "p_size"]
PART_TARGETS = ["p_type", "p_brand"]


# Cleaning


def case_text(spark, sf):
    return cases.with_case_text(table(spark, sf, "conversations"), "role", "text", "case_text").select(
        "conv_id", "turn", "case_text"
    )


def text_length(spark, sf):
    return cases.with_text_length(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", "text_length")


def truncate_chars(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean.truncate_chars("text", 1200).alias("cut"))


def truncate_utf8(spark, sf):
    cut = clean.truncate_utf8("text", 4900)
    return table(spark, sf, "documents").select("doc_id", F.octet_length(cut).alias("bytes"), F.md5(cut).alias("digest"))


def parse_dates(spark, sf):
    text = (
        F.when(F.col("event_type") == "error", F.lit("junk"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "M/d/yyyy, h:mm a"))
    )
    return table(spark, sf, "events").select("event_id", clean.to_ts(text).alias("parsed"))


def open_hours(spark, sf):
    """Date column found by name pattern, parsed from text, then subtracted."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "M/d/yyyy, h:mm a").alias("Date opened")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("closed_at")
    )
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    source = cases.find_first_matching(joined.columns, cases.OPENED_PATTERNS)
    dated = cases.with_open_hours(cases.ensure_timestamp(joined, "opened_at", [source]))
    return dated.select("l_orderkey", "l_linenumber", "l_partkey", r6("open_hours").alias("open_hours"))


def coerce_numbers(spark, sf):
    raw = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(F.concat(F.lit(" "), F.col("p_size"), F.lit(" ")))
    staged = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return staged.select("p_partkey", clean.to_number("raw").alias("number"), clean.to_number("raw", None).alias("nullable"))


def valid_target(spark, sf):
    """Targets spelled as the exports spell them: numbers, padded words, empty text."""
    token = (
        F.when(F.col("lang") == "de", F.lit(" NULL "))
        .when(F.col("lang") == "es", F.lit("nan "))
        .when((F.col("lang") == "fr") & F.col("quality").isNull(), F.lit(""))
        .otherwise(F.col("quality").cast("string"))
    )
    staged = labelled_documents(spark, sf, "lang").select("doc_id", token.alias("t"))
    return staged.select(
        "doc_id", clean.valid_target("t").alias("usable"), clean.valid_target("t", zero_is_missing=True).alias("evaluable")
    )


def fill_features(spark, sf):
    return features.fill_features(labelled_documents(spark, sf, "lang"), ["lang", "quality", "toxic"])


def columns_json(spark, sf):
    """Column-oriented JSON per part back to rows."""
    body = F.to_json(F.struct(F.array("p_name", "p_brand").alias("name"), F.array("p_size", "p_partkey").alias("number")))
    staged = table(spark, sf, "part").select("p_partkey", body.alias("j"))
    return columns_json_to_rows(staged, "j", {"name": "string", "number": "bigint"}, keep=["p_partkey"])


def json_records(spark, sf):
    """JSON records per supplier, an array for some and a single object for others."""
    one = F.struct(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    body = F.when(F.col("s_nationkey") < 10, F.to_json(F.array(one, one))).otherwise(F.to_json(one))
    staged = table(spark, sf, "supplier").select("s_suppkey", body.alias("j"))
    return parse_json_records(staged, "j", "name: string, balance: double", keep=["s_suppkey"])


# Splits


def _parts(spark, sf):
    return table(spark, sf, "part")


def split_support_aware(spark, sf):
    found = splits.split_support_aware(_parts(spark, sf), "p_partkey", [], PART_TARGETS)
    return found.select("p_partkey", "target", "label", "split")


def split_support_aware_rare(spark, sf):
    rows = table(spark, sf, "supplier")
    found = splits.split_support_aware(rows, "s_suppkey", [], ["s_nationkey"], val_frac=0.25, rare_train_only=False)
    return found.select("s_suppkey", "target", "label", "split")


def split_at_least_one_floor(spark, sf):
    found = splits.split_at_least_one(table(spark, sf, "supplier"), "s_suppkey", [], ["s_nationkey"])
    return found.select("s_suppkey", "target", "label", "split")


def split_at_least_one_round(spark, sf):
    found = splits.split_at_least_one(_parts(spark, sf), "p_partkey", [], PART_TARGETS, rounding="half_even")
    return found.select("p_partkey", "target", "label", "split")


def split_global(spark, sf):
    found = splits.split_global(_parts(spark, sf), "p_partkey", [], PART_TARGETS)
    return found.select("p_partkey", "target", "label", "split")


def split_global_random(spark, sf):
    found = splits.split_global(table(spark, sf, "supplier"), "s_suppkey", [], ["s_name"], stratify="try")
    return found.select("s_suppkey", "target", "label", "split")


def split_report(spark, sf):
    return report(splits.split_support_aware(_parts(spark, sf), "p_partkey", [], PART_TARGETS))


def prepare_per_target(spark, sf):
    return splits.prepare_per_target(labelled_documents(spark, sf, "lang"), "doc_id", ["lang"], ["quality", "toxic"])


def prep_manifest(spark, sf):
    return splits.prep_manifest(prepare_per_target(spark, sf), "prepared")


def target_metadata(spark, sf):
    split = splits.split_support_aware(_parts(spark, sf), "p_partkey", PART_FEATURES, ["p_type"])
    return splits.target_metadata(split, len(PART_FEATURES))


def split_global_require(spark, sf):
    found = splits.split_global(_parts(spark, sf), "p_partkey", [], ["p_type"], stratify="require", spelled_out=False)
    return found.select("p_partkey", "target", "label", "split")


# Features


def featurize_encoded(spark, sf):
    """Encoded variant in the order category, text, number: non-zero entries outside the hashed words."""
    parts = _parts(spark, sf).select("p_partkey", "p_brand", F.col("p_name").alias("p_desc"), "p_size")
    routing = features.route_features(parts.schema, ["p_brand", "p_desc", "p_size"], "B")
    codes = features.fit_encoders(parts, routing)
    joint = features.featurize_encoded(parts, routing, codes, ["p_partkey"], ["p_brand", "p_desc", "p_size"], 64)
    entries = joint.select("p_partkey", F.inline(vector_entries("features"))).filter("w <> 0 and (idx < 1 or idx > 64)")
    return entries.select("p_partkey", F.col("idx").cast("int").alias("idx"), F.col("w").alias("value"))


def label_map(spark, sf):
    return features.label_map(_parts(spark, sf).select(F.col("p_brand").alias("label")))


def _vendors(spark, sf):
    """Supplier names as a high-cardinality category, codes fitted on the train side only."""
    split = splits.split_at_least_one(table(spark, sf, "supplier"), "s_suppkey", ["s_name"], ["s_nationkey"])
    return split, split.filter(F.col("split") == "train")


def encode_category_zero(spark, sf):
    rows, train = _vendors(spark, sf)
    coded = features.encode_category(rows, features.category_codes(train, "s_name"), "s_name", ["s_suppkey"])
    return coded.select("s_suppkey", F.col("s_name_code").alias("code"))


def encode_category_unknown(spark, sf):
    rows, train = _vendors(spark, sf)
    codes = features.category_codes(train, "s_name", unseen="unknown")
    coded = features.encode_category(rows, codes, "s_name", ["s_suppkey"], unseen="unknown")
    return coded.select("s_suppkey", F.col("s_name_code").alias("code"))


def numeric_block(spark, sf):
    staged = labelled_documents(spark, sf).select("doc_id", "quality", F.col("toxic").cast("string").alias("toxic"))
    return features.numeric_block(staged, ["quality", "toxic"])


def hash_text(spark, sf):
    return features.hash_text_long(table(spark, sf, "documents", spread=True), "doc_id", "text", 64)


def hash_text_vector(spark, sf):
    """Row totals of the hashed bag of words equal the number of words, whatever the bucket function."""
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text")
    counts = features.hash_text(docs, "text", 1024, "v").select("doc_id", vector_entries("v").alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x["w"])
    return counts.select("doc_id", total.cast("long").alias("words"))


def hash_value(spark, sf):
    hashed = features.hash_value(_parts(spark, sf).select("p_partkey", "p_brand"), "p_brand", 32, out="v")
    nonzero = hashed.select("p_partkey", F.inline(vector_entries("v"))).filter(F.col("w") != 0)
    return nonzero.select("p_partkey", F.col("idx").cast("int").alias("bucket"), F.col("w").alias("sign"))


def route_features(spark, sf):
    parts = _parts(spark, sf)
    columns = ["p_brand", "p_name", "p_size", "p_retailprice"]
    renamed = parts.withColumnRenamed("p_name", "p_desc")
    routed = [
        features.route_features(renamed.schema, [c if c != "p_name" else "p_desc" for c in columns], rule).table(parts)
        .withColumn("rule", F.lit(rule))
        for rule in ("A", "B")
    ]
    sizes = renamed.agg(*[F.countDistinct(c).alias(c) for c in ("p_brand", "p_desc", "p_size", "p_retailprice")])
    long = sizes.unpivot([], sizes.columns, "column", "values")
    return routed[0].unionByName(routed[1]).join(long, "column").select("rule", "column", "kind", "values")


def expand_vector(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v")
    )
    wide = features.expand_vector(rows, "v", "v", 64)
    return wide.select("vec_id", *[r6(f"v_{i}").alias(f"v_{i}") for i in range(64)])


def assemble_features(spark, sf):
    """Numeric, categorical and text blocks of rule A, as the non-zero entries of the joint vector."""
    parts = _parts(spark, sf).select("p_partkey", "p_size", "p_brand", F.col("p_name").alias("p_desc"))
    routing = features.route_features(parts.schema, ["p_size", "p_brand", "p_desc"], "A")
    joint = features.featurize(parts, routing).select("p_partkey", F.inline(vector_entries("features")))
    return joint.filter(F.col("w") != 0).select("p_partkey", F.col("idx").cast("int").alias("idx"), F.col("w").alias("value"))


PART_LONG = " UNION ALL ".join(f"SELECT p_partkey, '{t}' AS target, {t} AS label FROM part" for t in PART_TARGETS)
SUPPLIER_LONG = "SELECT s_suppkey, 's_nationkey' AS target, CAST(s_nationkey AS VARCHAR) AS label FROM supplier"
LABELS_LONG = " UNION ALL ".join(
    f"SELECT doc_id, lang, '{t}' AS target, CAST({t} AS VARCHAR) AS label FROM dl WHERE {t} IS NOT NULL" for t in ("quality", "toxic")
)
SUPPORT_QUOTA = "CASE WHEN n < 5 THEN 0 WHEN n > 1 THEN least(CAST(round_even(n * 0.2, 0) AS BIGINT), n - 1) ELSE 0 END"
RARE_QUOTA = "CASE WHEN n > 1 THEN least(CAST(round_even(n * 0.25, 0) AS BIGINT), n - 1) ELSE 0 END"
FLOOR_QUOTA = "least(greatest(CAST(floor(n * 0.2) AS BIGINT), 1), n - 1)"
ROUND_QUOTA = "least(greatest(CAST(round_even(n * 0.2, 0) AS BIGINT), 1), n - 1)"
STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
BUCKET = "CAST(('0x' || substr(md5({x}), 1, 8))::BIGINT % {n} AS INTEGER)"
SIGN = "CASE WHEN ('0x' || substr(md5({x}), 9, 1))::BIGINT % 2 = 1 THEN -1.0 ELSE 1.0 END"
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
_VENDOR = f"WITH {split_sql(SUPPLIER_LONG, 's_suppkey', FLOOR_QUOTA)}, tr AS (SELECT DISTINCT s_name FROM s JOIN supplier USING (s_suppkey) WHERE split = 'train')"
_VALID = """
WITH dl AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)),
t AS (
  SELECT doc_id, trim(CASE WHEN lang = 'de' THEN ' NULL ' WHEN lang = 'es' THEN 'nan '
                           WHEN lang = 'fr' AND quality IS NULL THEN '' ELSE CAST(quality AS VARCHAR) END) AS t
  FROM dl
)
SELECT doc_id, coalesce(t NOT IN ('', 'nan', 'NaN', 'none', 'None', 'null', 'NULL'), false) AS usable,
       coalesce(t NOT IN ('', 'nan', 'NaN', 'none', 'None', 'null', 'NULL', '0', '0.0'), false) AS evaluable
FROM t"""
_UTF8 = """
WITH k AS (
  SELECT doc_id, text,
         CASE WHEN strlen(text) <= 4900 THEN length(text)
              ELSE list_max(list_filter(range(1225, 4901), lambda i: strlen(left(text, i)) <= 4900)) END AS n
  FROM documents
)
SELECT doc_id, CAST(strlen(left(text, n)) AS INTEGER) AS bytes, md5(left(text, n)) AS digest FROM k"""
_GLOBAL = f"""
WITH m AS ({PART_LONG}),
k AS (SELECT target, label, count(*) AS n FROM m GROUP BY 1, 2),
t AS (SELECT *, sum(n) OVER (PARTITION BY target) AS total FROM k),
q AS (SELECT *, total - ceil(total * 0.2) AS tr, n * (total - ceil(total * 0.2)) / total AS share FROM t),
f AS (SELECT *, floor(share) AS fl, round(share - floor(share), 9) AS rest FROM q),
g AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY rest DESC, label) AS rk,
         tr - sum(fl) OVER (PARTITION BY target) AS missing FROM f
),
u AS (SELECT target, label, n - fl - CASE WHEN rk <= missing THEN 1 ELSE 0 END AS take FROM g),
c AS (
  SELECT m.*, row_number() OVER (PARTITION BY target, label ORDER BY md5(concat(p_partkey, '-42')), p_partkey) AS rn FROM m
)
SELECT p_partkey, target, label, CASE WHEN rn <= take THEN 'validation' ELSE 'train' END AS split
FROM c JOIN u USING (target, label)"""

QUERIES = {
    "case_text": (
        case_text,
        "SELECT conv_id, turn, t AS case_text FROM (SELECT conv_id, turn, "
        + STRIP.format(x="coalesce(role, '') || chr(10) || coalesce(text, '')")
        + " AS t FROM conversations) WHERE length(t) > 0",
    ),
    "text_length": (text_length, "SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length FROM documents"),
    "truncate_chars": (
        truncate_chars,
        "SELECT doc_id, left(" + STRIP.format(x="replace(text, chr(10), ' ')") + ", 1200) AS cut FROM documents",
    ),
    "truncate_utf8": (truncate_utf8, _UTF8),
    "parse_dates": (
        parse_dates,
        "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN date_trunc('second', ts) "
        "ELSE date_trunc('minute', ts) END AS parsed FROM events",
    ),
    "open_hours": (
        open_hours,
        "SELECT l_orderkey, l_linenumber, l_partkey, "
        "round(date_diff('microsecond', date_trunc('minute', o_orderdate), l_shipdate) / 3.6e9, 6) AS open_hours "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    ),
    "coerce_numbers": (
        coerce_numbers,
        """WITH r AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_name ELSE ' ' || p_size || ' ' END AS raw FROM part)
SELECT p_partkey, coalesce(try_cast(trim(raw) AS DOUBLE), 0.0) AS number, try_cast(trim(raw) AS DOUBLE) AS nullable FROM r""",
    ),
    "valid_target": (valid_target, _VALID),
    "fill_features": (
        fill_features,
        f"WITH {DOCLABELS_SQL} SELECT doc_id, coalesce(lang, '') AS lang, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM dl",
    ),
    "columns_json": (
        columns_json,
        "SELECT p_partkey, p_name AS name, CAST(p_size AS BIGINT) AS number FROM part "
        "UNION ALL SELECT p_partkey, p_brand AS name, p_partkey AS number FROM part",
    ),
    "json_records": (
        json_records,
        "SELECT s_suppkey, s_name AS name, s_acctbal AS balance FROM supplier "
        "UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_nationkey < 10",
    ),
    "split_support_aware": (split_support_aware, f"WITH {split_sql(PART_LONG, 'p_partkey', SUPPORT_QUOTA)} SELECT * FROM s"),
    "split_support_aware_rare": (split_support_aware_rare, f"WITH {split_sql(SUPPLIER_LONG, 's_suppkey', RARE_QUOTA)} SELECT * FROM s"),
    "split_at_least_one_floor": (split_at_least_one_floor, f"WITH {split_sql(SUPPLIER_LONG, 's_suppkey', FLOOR_QUOTA)} SELECT * FROM s"),
    "split_at_least_one_round": (split_at_least_one_round, f"WITH {split_sql(PART_LONG, 'p_partkey', ROUND_QUOTA)} SELECT * FROM s"),
    "split_global": (split_global, _GLOBAL),
    "split_global_random": (
        split_global_random,
        """WITH c AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY md5(concat(s_suppkey, '-42')), s_suppkey) AS rn FROM supplier)
SELECT s_suppkey, 's_name' AS target, s_name AS label,
       CASE WHEN rn <= (SELECT ceil(count(*) * 0.2) FROM supplier) THEN 'validation' ELSE 'train' END AS split FROM c""",
    ),
    "split_report": (
        split_report,
        f"""WITH {split_sql(PART_LONG, 'p_partkey', SUPPORT_QUOTA)},
k AS (SELECT target, label, count(*) AS n, count(*) FILTER (split = 'train') AS t, count(*) FILTER (split = 'validation') AS v FROM s GROUP BY 1, 2)
SELECT target, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(t) AS BIGINT) AS train, CAST(sum(v) AS BIGINT) AS validation,
       count(*) AS classes, count(*) FILTER (n = 1) AS singletons FROM k GROUP BY 1""",
    ),
    "prepare_per_target": (prepare_per_target, f"WITH {DOCLABELS_SQL} {LABELS_LONG}"),
    "prep_manifest": (
        prep_manifest,
        f"WITH {DOCLABELS_SQL}, p AS ({LABELS_LONG}) SELECT target, count(*) AS rows, count(DISTINCT label) AS unique_labels, "
        "'prepared/target=' || target AS output_path FROM p GROUP BY target",
    ),
    "target_metadata": (
        target_metadata,
        f"""WITH {split_sql("SELECT p_partkey, 'p_type' AS target, p_type AS label FROM part", 'p_partkey', SUPPORT_QUOTA)}
SELECT target AS target_column, count(*) AS num_rows, 3 AS num_features, count(DISTINCT label) AS unique_classes,
       count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'validation') AS val_samples FROM s GROUP BY 1""",
    ),
    "split_global_require": (split_global_require, f"SELECT * FROM ({_GLOBAL}) WHERE target = 'p_type'"),
    "featurize_encoded": (
        featurize_encoded,
        """WITH k AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, 0 AS idx, CAST(code AS DOUBLE) AS value FROM part JOIN k USING (p_brand) WHERE code <> 0
UNION ALL SELECT p_partkey, 65, CAST(p_size AS DOUBLE) FROM part WHERE p_size <> 0""",
    ),
    "label_map": (
        label_map,
        'SELECT label, row_number() OVER (ORDER BY label) - 1 AS "index" FROM (SELECT DISTINCT p_brand AS label FROM part)',
    ),
    "encode_category_zero": (
        encode_category_zero,
        f"""{_VENDOR}, k AS (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS code FROM tr)
SELECT s_suppkey, coalesce(code, 0) AS code FROM supplier LEFT JOIN k USING (s_name)""",
    ),
    "encode_category_unknown": (
        encode_category_unknown,
        f"""{_VENDOR}, k AS (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS code FROM tr)
SELECT s_suppkey, coalesce(code, (SELECT max(code) + 1 FROM k)) AS code FROM supplier LEFT JOIN k USING (s_name)""",
    ),
    "numeric_block": (
        numeric_block,
        f"WITH {DOCLABELS_SQL} SELECT doc_id, coalesce(CAST(quality AS DOUBLE), 0.0) AS quality, coalesce(CAST(toxic AS DOUBLE), 0.0) AS toxic FROM dl",
    ),
    "hash_text": (
        hash_text,
        f"WITH w AS (SELECT doc_id, unnest({WORDS}) AS word FROM documents) "
        f"SELECT doc_id, {BUCKET.format(x='word', n=64)} AS bucket, count(*) AS count FROM w GROUP BY 1, 2",
    ),
    "hash_text_vector": (hash_text_vector, f"SELECT doc_id, len({WORDS}) AS words FROM documents"),
    "hash_value": (
        hash_value,
        f"SELECT p_partkey, {BUCKET.format(x='p_brand', n=32)} AS bucket, CAST({SIGN.format(x='p_brand')} AS DOUBLE) AS sign FROM part",
    ),
    "route_features": (
        route_features,
        """WITH v AS (SELECT count(DISTINCT p_brand) AS b, count(DISTINCT p_name) AS d, count(DISTINCT p_size) AS s, count(DISTINCT p_retailprice) AS r FROM part)
SELECT rule, "column", kind, CASE "column" WHEN 'p_brand' THEN b WHEN 'p_desc' THEN d WHEN 'p_size' THEN s ELSE r END AS "values"
FROM v CROSS JOIN (VALUES ('p_brand', 'categorical'), ('p_desc', 'text'), ('p_size', 'numeric'), ('p_retailprice', 'numeric')) k("column", kind)
CROSS JOIN (VALUES ('A'), ('B')) a(rule)""",
    ),
    "expand_vector": (
        expand_vector,
        "SELECT vec_id, " + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS v_{i}" for i in range(64)) + " FROM embeddings",
    ),
    "assemble_features": (
        assemble_features,
        f"""SELECT p_partkey, 0 AS idx, CAST(p_size AS DOUBLE) AS value FROM part WHERE p_size <> 0
UNION ALL SELECT p_partkey, 1 + {BUCKET.format(x='p_brand', n=32)}, CAST({SIGN.format(x='p_brand')} AS DOUBLE) FROM part
UNION ALL SELECT p_partkey, 33 + {BUCKET.format(x='p_name', n=128)}, CAST({SIGN.format(x='p_name')} AS DOUBLE) FROM part""",
    ),
}
