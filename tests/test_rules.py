"""Hand-computed cases for single rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseworks.functions import clean
from caseworks.functions.text import ngrams, tokens, with_terms
from caseworks.functions.vectors import cosine_distance, l2_normalize
from caseworks.operators import cases, contacts, durations, features, incidents, profile, splits
from caseworks.operators.embedding import encode_with_retry, parse_embeddings
from caseworks.operators.sentiment import score_sentiment
from caseworks.sources import checks

T = dt.datetime


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# Split quotas

SUPPORT = {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1, 8: 2, 9: 2, 10: 2, 11: 2, 12: 2}
FLOOR = {1: 0, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 2, 11: 2, 12: 2}


@pytest.fixture(scope="module")
def classes(spark):
    rows = [(f"{n:02d}-{i:02d}", f"c{n}") for n in range(1, 13) for i in range(n)]
    return spark.createDataFrame(rows, "id string, y string").repartition(5)


def val_counts(split):
    got = split.groupBy("label").agg(F.count_if(F.col("split") == "validation").alias("v")).collect()
    return {int(r["label"][1:]): r["v"] for r in got}


def test_support_aware_quota(classes):
    assert val_counts(splits.split_support_aware(classes, "id", [], ["y"])) == SUPPORT


@pytest.mark.parametrize("frac", [0.2, 0.25, 0.5, 0.9])
def test_support_aware_without_rare_rule(classes, frac):
    split = splits.split_support_aware(classes, "id", [], ["y"], val_frac=frac, rare_train_only=False)
    expected = {n: (min(round(n * frac), n - 1) if n > 1 else 0) for n in range(1, 13)}
    assert val_counts(split) == expected


def test_at_least_one_floor(classes):
    assert val_counts(splits.split_at_least_one(classes, "id", [], ["y"])) == FLOOR


def test_at_least_one_half_even(classes):
    split = splits.split_at_least_one(classes, "id", [], ["y"], val_frac=0.25, rounding="half_even")
    assert val_counts(split) == {n: (min(max(round(n * 0.25), 1), n - 1) if n > 1 else 0) for n in range(1, 13)}


def test_split_is_a_partition_and_keeps_classes_in_train(classes):
    split = splits.split_support_aware(classes, "id", [], ["y"], val_frac=0.9)
    assert split.count() == classes.count() == split.select("id").distinct().count()
    assert checks.classes_outside_train(split).isEmpty()


def test_split_does_not_depend_on_partitioning(classes):
    a = splits.split_support_aware(classes.repartition(1), "id", [], ["y"])
    b = splits.split_support_aware(classes.repartition(16), "id", [], ["y"])
    assert set(a.collect()) == set(b.collect())


def test_global_split_totals_and_modes(spark, classes):
    big = classes.filter("y not in ('c1')")
    split = splits.split_global(big, "id", [], ["y"], test_size=0.2)
    assert split.filter("split = 'validation'").count() == 16  # ceil(0.2 * 77)
    assert min(val_counts(split).values()) >= 0
    with pytest.raises(ValueError):
        splits.split_global(classes, "id", [], ["y"], stratify="require")
    drawn = splits.split_global(classes, "id", [], ["y"], stratify="try")
    assert drawn.filter("split = 'validation'").count() == 16  # ceil(0.2 * 78)
    few = spark.createDataFrame([(i, f"k{i // 2}") for i in range(20)], "id long, y string")
    with pytest.raises(ValueError):
        splits.split_global(few, "id", [], ["y"], stratify="auto")
    assert splits.split_global(few, "id", [], ["y"], stratify="try").filter("split = 'validation'").count() == 4


def test_missing_targets_leave(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, " NULL "), (4, "0")], "id int, y string")
    assert splits.prepare_per_target(df, "id", [], ["y"]).count() == 3
    assert splits.prepare_per_target(df, "id", [], ["y"], spelled_out=True).count() == 2


def test_sample_exact_large_path_equals_sorted_path(classes, monkeypatch):
    small = {r["id"] for r in splits.sample_exact(classes, "id", 30).collect()}
    monkeypatch.setattr(splits, "MAX_DIRECT_SAMPLE", 0)
    assert {r["id"] for r in splits.sample_exact(classes, "id", 30).collect()} == small
    assert splits.sample_exact(classes, "id", 10_000).count() == 78


# Cleaning


def test_strip_and_compose(spark):
    df = spark.createDataFrame([("\t a \n", "b \n"), (None, None), (" ", "x")], "s string, d string")
    assert values(df.select(clean.compose_text("s", "d").alias("t")), "t") == [("a \n\nb",), ("",), ("x",)]
    assert cases.with_case_text(df, "s", "d").count() == 2


@pytest.mark.parametrize(
    "text,limit", [("a" * 4899 + "é", 4900), ("a" * 4900, 4900), ("é" * 3000, 4900), ("€" * 7, 4), ("😀😀", 7), ("", 5), ("ab", 0), ("é", 1)]
)
def test_truncate_utf8(spark, text, limit):
    expected = text.encode()[:limit].decode(errors="ignore")
    assert one(spark, clean.truncate_utf8(F.lit(text), limit)) == expected


def test_truncate_null(spark):
    assert one(spark, clean.truncate_utf8(F.lit(None).cast("string"))) == ""
    assert one(spark, clean.truncate_chars(F.lit(" a\nb "), 2)) == "a "


def test_dates(spark):
    df = spark.createDataFrame([("3/28/2025, 9:27 AM",), ("junk",), (None,), ("2025-03-28 21:05:06",)], "s string")
    assert values(df.select(clean.to_ts("s").alias("t")), "t") == [
        (T(2025, 3, 28, 9, 27),), (None,), (None,), (T(2025, 3, 28, 21, 5, 6),),
    ]


def test_wall_clock_in_a_zone_with_daylight_saving(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("3/9/2025, 2:30 AM", 1), ("3/9/2025, 4:30 AM", 2)], "s string, id int")
        parsed = df.select("id", F.lit("k").alias("k"), clean.to_ts("s").alias("ts"))
        assert values(parsed, "ts") == [(T(2025, 3, 9, 2, 30),), (T(2025, 3, 9, 4, 30),)]
        assert contacts.repeat_contacts(parsed, "k", "ts", "id").filter("id = 2").first()["hours_since_prev"] == 2.0
        window = incidents.incident_attribution(parsed, "ts", "k", "2025-03-09", "2025-03-10").first()
        assert (window["incident"], window["baseline"]) == (2, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_numbers(spark):
    df = spark.createDataFrame([(" 12 ",), ("x",), ("",), (None,), ("NaN",), ("1e3",)], "s string")
    assert values(df.select(clean.to_number("s").alias("n")), "n") == [(12.0,), (0.0,), (0.0,), (0.0,), (0.0,), (1000.0,)]
    assert values(df.select(clean.to_number("s", None).alias("n")), "n")[1] == (None,)


def test_numbers_of_numeric_columns_take_no_way_over_text(spark):
    rows = [(1, 2**53 + 1, 0.1, 0.1, "7"), (None, None, None, None, None), (-3, -5, float("nan"), float("nan"), "x"), (0, 2**62 + 1, float("inf"), 1e-40, "1e3"), (1, 1, -0.0, 16777217.0, "")]
    df = spark.createDataFrame(rows, "i int, l long, d double, f float, s string")
    block = features.numeric_block(df, df.columns, "_num")
    asked = [f"{c}_num" for c in df.columns]
    by_text = df.select(*[clean.to_number(c).alias(f"{c}_num") for c in df.columns])
    assert [str(r) for r in block.select(*asked).collect()] == [str(r) for r in by_text.collect()]
    plan = block.select("i_num", "l_num", "d_num")._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan


def test_valid_target(spark):
    df = spark.createDataFrame([(x,) for x in ("nan", "None", " NULL ", "0", "0.0", "60537", None, "")], "s string")
    plain = [r[0] for r in df.select(clean.valid_target("s")).collect()]
    strict = [r[0] for r in df.select(clean.valid_target("s", zero_is_missing=True)).collect()]
    assert plain == [False, False, False, True, True, True, False, False]
    assert strict == [False, False, False, False, False, True, False, False]


def test_date_column_search():
    cols = ["Case Open", "Date/Time opened", "Closed At"]
    assert cases.find_first_matching(cols, cases.OPENED_PATTERNS) == "Date/Time opened"
    assert cases.find_first_matching(cols, cases.CLOSED_PATTERNS) == "Closed At"
    assert cases.find_first_matching(["x"], cases.CLOSED_PATTERNS) is None


def test_load_cases(spark):
    df = spark.createDataFrame(
        [("a", "b", "3/28/2025, 9:00 AM", "3/28/2025, 10:30 AM"), ("", None, None, None), ("c", "d", "junk", "3/1/2025, 1:00 AM")],
        [" Subject", "Description ", "Date/Time opened", "Date/Time closed"],
    )
    loaded = cases.load_cases(df)
    assert values(loaded, "text", "open_hours") == [("a\nb", 1.5), ("c\nd", None)]


def test_theme_column():
    assert durations.theme_column(["x", "theme_cluster_a", "theme_top"]) == "theme_top"
    assert durations.theme_column(["theme_cluster_a"]) == "theme_cluster_a"
    with pytest.raises(ValueError):
        durations.theme_column(["x"])


# Text


def test_terms(spark):
    df = spark.createDataFrame([("The red Fox, a red fox!",), (None,)], "t string")
    got = with_terms(df, "t", "terms", (1, 2), ["the"]).collect()
    assert got[0]["terms"] == ["red", "fox", "red", "fox", "red fox", "fox red", "red fox"]
    assert got[1]["terms"] == []
    assert one(spark, ngrams(tokens(F.lit("ab cd ef gh")), 3)) == ["ab cd ef", "cd ef gh"]
    assert one(spark, ngrams(tokens(F.lit("ab")), 2)) == []


def test_vectors(spark):
    a, b, zero = (F.array(*[F.lit(float(x)) for x in v]) for v in ((3, 4), (4, -3), (0, 0)))
    assert one(spark, l2_normalize(a)) == [0.6, 0.8]
    assert one(spark, l2_normalize(zero)) == [0.0, 0.0]
    assert one(spark, cosine_distance(a, b)) == pytest.approx(1.0)
    assert one(spark, cosine_distance(a, zero)) == 1.0


# Incidents


def test_flat_and_single_day_themes_have_no_spikes(spark):
    rows = [("flat", T(2024, 1, d)) for d in range(1, 11)] + [("one", T(2024, 1, 5))] * 30 + [(None, T(2024, 1, 5)), ("flat", None)]
    df = spark.createDataFrame(rows, "theme string, ts timestamp_ntz")
    got = incidents.theme_spikes(df, "ts", "theme", z=2.0).collect()
    assert [(r["theme"], r["day"], r["count"]) for r in got] == [("one", dt.date(2024, 1, 5), 30)]
    assert got[0]["zscore"] == pytest.approx(2.85, abs=0.01)
    only = df.filter("theme = 'one'")
    assert incidents.theme_spikes(only, "ts", "theme").columns == ["theme", "day", "count", "zscore"]
    assert incidents.theme_spikes(only, "ts", "theme").isEmpty()


def test_attribution_bounds_are_midnights(spark):
    rows = [
        ("in", T(2024, 1, 10)), ("in", T(2024, 1, 12)), ("late", T(2024, 1, 12, 0, 1)),
        ("base", T(2024, 1, 9)), ("gap", T(2024, 1, 9, 0, 1)), ("base", T(2024, 1, 7)), ("old", T(2024, 1, 6, 23, 59)),
        (None, T(2024, 1, 11)),
    ]
    df = spark.createDataFrame(rows, "theme string, ts timestamp_ntz")
    got = {r["theme"]: (r["incident"], r["baseline"], r["delta"], r["incident_share"]) for r in
           incidents.incident_attribution(df, "ts", "theme", "2024-01-10", "2024-01-12").collect()}
    assert got == {"in": (2, 0, 2, 1.0), "base": (0, 2, -2, 0.0)}
    whole = incidents.incident_attribution(df, "ts", "theme", "2024-01-10", "2024-01-12", whole_days=True)
    assert {r["theme"] for r in whole.collect()} == {"in", "late", "base", "gap"}
    with pytest.raises(ValueError):
        incidents.incident_attribution(df, "ts", "theme", "2030-01-01", "2030-01-02")


# Contacts and profiles


def test_first_contacts_are_not_repeats(spark):
    rows = [(1, "a", T(2024, 1, 1)), (2, "a", T(2024, 1, 8)), (3, "a", T(2024, 1, 15, 0, 0, 1)), (4, "b", T(2024, 1, 1)),
            (5, None, T(2024, 1, 1)), (6, "b", None)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz")
    got = {r["id"]: r["is_repeat"] for r in contacts.repeat_contacts(df, "k", "ts", "id").collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_histogram_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (10.0,), (None,)], "x double")
    got = profile.histogram(df, "x", 5).collect()
    assert [r["count"] for r in got] == [2, 1, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    got = profile.histogram(flat, "x", 2).collect()
    assert [(r["low"], r["count"]) for r in got] == [(2.5, 0), (3.0, 2)]
    assert [r["count"] for r in profile.histogram(df.filter("x > 99"), "x", 2).collect()] == [0, 0]


def test_share_and_counts(spark):
    df = spark.createDataFrame([(0.0, "a"), (None, None), (2.0, "a"), (3.0, "b")], "x double, t string")
    assert profile.share_equal(df, "x", 0.0, null_as=0.0).first()[0] == 0.5
    assert values(profile.value_counts(df, "t"), "value", "count") == [("a", 2), ("(blank)", 1), ("b", 1)]
    assert values(profile.missingness(df), "column", "missing") == [("t", 0.25), ("x", 0.25)]


# Features


def test_routing(spark):
    df = spark.createDataFrame([(1, "v", "l", True)], "ClubNumber int, VendorName string, LineDescription string, Flag boolean")
    a = features.route_features(df.schema, df.columns, "A")
    assert (a.numeric, a.categorical, a.text) == (["ClubNumber", "Flag"], ["VendorName"], ["LineDescription"])
    b = features.route_features(df.schema, df.columns, "B")
    assert (b.numeric, b.categorical, b.text) == (["ClubNumber", "Flag"], ["VendorName"], ["LineDescription"])
    assert features.FeatureRouting.from_json(a.to_json()) == a


def test_category_codes_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    new = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None), (4, "b")], "id int, c string")
    zero = features.encode_category(new, features.category_codes(train, "c"), "c", ["id"])
    assert sorted(values(zero, "id", "c_code")) == [(1, 1), (2, 0), (3, 0), (4, 2)]
    codes = features.category_codes(train, "c", "unknown")
    known = features.encode_category(new, codes, "c", ["id"], "unknown")
    assert sorted(values(known, "id", "c_code")) == [(1, 1), (2, 0), (3, 0), (4, 2)]  # "Unknown" < "a" in string order
    full = train.filter("c is not null")
    known = features.encode_category(new, features.category_codes(full, "c", "unknown"), "c", ["id"], "unknown")
    assert sorted(values(known, "id", "c_code")) == [(1, 0), (2, 2), (3, 2), (4, 1)]


def test_fill_features(spark):
    df = spark.createDataFrame([(None, None, 1)], "a int, b string, c int")
    assert features.fill_features(df, ["a", "b"]).first() == (0, "", 1)


# External calls


def test_encode_with_retry():
    calls = []

    def flaky(texts):
        calls.append(len(texts))
        if len(calls) < 3:
            raise OSError("later")
        return [[1.0]] * len(texts)

    assert encode_with_retry(flaky, ["a", "b"], retries=5, backoff=0.0) == [[1.0], [1.0]]
    with pytest.raises(RuntimeError):
        encode_with_retry(lambda t: [], ["a"], retries=2, backoff=0.0)


def test_only_failed_items_are_neutral(spark):
    df = spark.range(60, numPartitions=1).select("id", F.concat(F.lit("t"), "id").alias("t"))

    def scorer(texts):
        return [None if t.endswith("7") else ("NEGATIVE", 0.9) for t in texts]

    got = score_sentiment(df, "id", "t", scorer).groupBy("sentiment_label").count().collect()
    assert {r[0]: r[1] for r in got} == {"NEUTRAL": 6, "NEGATIVE": 54}

    def down(texts):
        raise OSError("down")

    for broken in (down, lambda texts: [("NEGATIVE", 0.9)]):
        with pytest.raises(Exception, match="down|60|25"):
            score_sentiment(df, "id", "t", broken).collect()


@pytest.mark.parametrize(
    "payload,expected",
    [
        ('{"embeddings": [[1, 2.5], [3, 4]]}', [[1.0, 2.5], [3.0, 4.0]]),
        ('{"embeddings": {"int8": [[1, 2]], "float": [[1.5, 2]]}}', [[1.5, 2.0]]),
        ('{"embeddings": [{"embedding": [1, 2]}, {"embedding": [3, 4]}]}', [[1.0, 2.0], [3.0, 4.0]]),
        ('{"embeddings": ["a", "b"]}', None),
        ('{"embeddings": [["1", "2"]]}', None),
        ('{"other": 1}', None),
        ("junk", None),
        (None, None),
    ],
)
def test_payload_shapes(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "p string")
    assert df.select(parse_embeddings("p")).first()[0] == expected


# Checks


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, y string")
    checks.require_columns(df, ["id"], ["y"])
    with pytest.raises(ValueError, match="nope"):
        checks.require_columns(df, ["nope"], ["y"])
    with pytest.raises(ValueError):
        checks.require_classes(df, "y")
    checks.require_same_keys(df, df.select("id"), "id")
    with pytest.raises(ValueError):
        checks.require_same_keys(df, df.filter("id = 1"), "id")


def test_sentiment_rules(spark):
    """Negation, boosters, capitals, contrast and signs, each against the sum worked out by hand."""
    from caseworks.operators.sentiment import lexicon_sentiment

    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    texts = {
        "a good day": 2.0,
        "not so good": (2.0 + 0.293) * -0.74,
        "very good": 2.293,
        "very plain bad": -(2.0 + 0.95 * 0.293),
        "slightly (bad)": -(2.0 - 0.293),
        "a GOOD day": 2.733,
        "GOOD": 2.0,
        "good but bad": 0.5 * 2.0 - 1.5 * 2.0,
        "good!!!!!!": 2.0 + 4 * 0.292,
        "bad?? ": -(2.0 + 2 * 0.18),
        "good????": 2.0 + 0.96,
        "plain!": 0.0,
        "": 0.0,
    }
    rows = [(n, t) for n, t in enumerate(texts)] + [(0, None), (0, "good")]
    found = lexicon_sentiment(spark.createDataFrame(rows, "id int, text string"), "id", "text", lexicon).collect()
    sums = [*texts.values(), 0.0, 2.0]
    assert sorted((r["id"], round(r["compound"], 9)) for r in found) == sorted(
        (n, round(s / (s * s + 15.0) ** 0.5, 9)) for (n, _), s in zip(rows, sums, strict=True)
    )


def test_dense_days_of_many_themes(spark):
    """Every observed day for every theme, present or not, against the grid itself."""
    from caseworks.operators.incidents import daily_theme_dense

    rows = spark.range(4000).select(
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(40)) * 2 * 86_400 + F.col("id") % 5000).alias("ts"),
        F.when(F.col("id") % 97 > 0, F.concat(F.lit("t"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1500)))).alias("theme"),
    )
    found = {(r["day"], r["theme"]): r["count"] for r in daily_theme_dense(rows, "ts", "theme").collect()}
    counts = {}
    for r in rows.filter("theme is not null").select(F.to_date("ts").alias("day"), "theme").collect():
        counts[r["day"], r["theme"]] = counts.get((r["day"], r["theme"]), 0) + 1
    days, names = {d for d, _ in counts}, {t for _, t in counts}
    assert found == {(d, t): counts.get((d, t), 0) for d in days for t in names}
    some = {(r["day"], r["theme"]): r["count"] for r in daily_theme_dense(rows, "ts", "theme", ["t1", "never"]).collect()}
    own = {d for d, t in counts if t == "t1"} if not any(t == "never" for _, t in counts) else set()
    assert {t for _, t in some} == {"t1", "never"} and all(some[d, "never"] == 0 for d in days) and sum(v for (_, t), v in some.items() if t == "t1") == sum(v for (_, t), v in counts.items() if t == "t1") and own
    assert daily_theme_dense(rows.limit(0), "ts", "theme").count() == 0


def test_tfidf_by_table_equals_the_vector_form(spark, sf):
    from caseworks.operators.tfidf import tfidf, tfidf_by_table, tfidf_vocabulary

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    for size in (50, 777, 20_000):
        expected = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf(docs, "doc_id", "text", max_features=size).collect()}
        found = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf_by_table(docs, "doc_id", "text", tfidf_vocabulary(docs, "text", max_features=size)).collect()}
        assert found.keys() == expected.keys() and all(abs(found[k] - expected[k]) < 1e-9 for k in found)
