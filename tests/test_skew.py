"""The paths taken for large or skewed data give what the small paths give."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseworks.operators.contacts import repeat_contacts
from caseworks.operators.features import category_codes, encode_category
from caseworks.operators.themes import attach_labels, representatives
from caseworks.plans import bounded
from caseworks.plans.bounded import bounded_rows, hot_keys, local_table, lookup_join
from caseworks.plans.quantiles import exact_quantiles
from caseworks.plans.ranks import sorted_codes
from caseworks.plans.selection import hash_key, mark_smallest
from caseworks.plans.topk import contenders


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, some of them at the same moment."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 else f"k{rng.randrange(40)}"
        second = rng.choice([0, 5, 5, 5, rng.randrange(400_000)])
        rows.append((i, key, second, rng.random() * 10))
    df = spark.createDataFrame(rows, "id long, k string, s long, v double").repartition(6)
    return df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000).cast("timestamp_ntz"))


def test_hot_contacts_equal_plain_contacts(skewed):
    order = ["id"]
    plain = repeat_contacts(skewed, "k", "ts", "id", 1).orderBy(*order).collect()
    sliced = repeat_contacts(skewed, "k", "ts", "id", 1, hot_rows=1000).orderBy(*order).collect()
    assert plain == sliced
    rows = sorted(((r["k"], r["ts"], r["id"]) for r in plain))
    previous = {c[2]: (p[1] if p[0] == c[0] else None) for p, c in zip([(None, None, None), *rows], rows)}
    assert {r["id"]: r["prev_ts"] for r in sliced} == previous


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, "k", 1000) == ["hot"]
    assert hot_keys(skewed, "k", 10_000) == []


@pytest.mark.parametrize("groups", [[], ["k"]])
def test_bracketed_quantiles_are_exact(skewed, groups):
    wanted = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.95, "e": 1.0}
    odd = skewed.union(skewed.limit(3).withColumn("k", F.lit(None).cast("string")))
    for value in ("v", "s"):
        shares = F.array(*[F.lit(p) for p in wanted.values()])
        packed = odd.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.percentile(value, shares).alias("q"))
        direct = packed.select(*groups, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(wanted)])
        for accuracy in (50, 10_000):
            bracket = exact_quantiles(odd, groups, value, wanted, extra=[F.count(F.lit(1)).alias("n")], accuracy=accuracy)
            left = sorted(direct.collect(), key=str)
            right = sorted(bracket.select(*direct.columns).collect(), key=str)
            assert len(left) == len(right)
            for a, b in zip(left, right):
                assert a["n"] == b["n"] and all(a[q] == pytest.approx(b[q], rel=1e-12, abs=1e-12) for q in wanted)


def test_quantiles_skip_nulls_and_match_numpy(spark):
    data = [None, 1.0, 2.0, None, 10.0, 11.0]
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = exact_quantiles(df, [], "x", {"p": 0.9}, accuracy=100).first()["p"]
    assert got == pytest.approx(np.quantile([x for x in data if x is not None], 0.9))
    none = df.filter("x is null")
    assert [tuple(r) for r in exact_quantiles(none, [], "x", {"p": 0.5}, extra=[F.count(F.lit(1)).alias("n")]).collect()] == [(2, None)]


def test_mark_smallest_equals_sorting(skewed):
    marked = mark_smallest(skewed, ["k"], "id", 3, lambda n: F.floor(n * 0.3)).select("k", "id", "picked", hash_key("id", 3).alias("h")).collect()
    by_key = {}
    for r in marked:
        by_key.setdefault(r["k"], []).append(r)
    for rows in by_key.values():
        ordered = sorted(rows, key=lambda r: (r["h"], r["id"]))
        assert [r["picked"] for r in ordered] == [i < int(len(rows) * 0.3) for i in range(len(rows))]


def test_mark_smallest_extremes(skewed):
    for take, expected in ((0, 0), (10**9, 3000)):
        marked = mark_smallest(skewed, [], "id", 1, lambda n: F.least(n, F.lit(take)))
        assert marked.filter("picked").count() == expected


def test_large_lookup_equals_broadcast(skewed):
    table = skewed.groupBy("k").agg(F.max("v").alias("m"))
    small = lookup_join(skewed, table, ["k"], ["id"])
    salted = lookup_join(skewed, table, ["k"], ["id"], max_rows=3)
    assert sorted(small.collect()) == sorted(salted.select(*small.columns).collect())
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


@pytest.mark.parametrize("how", ["left", "inner"])
def test_only_hot_keys_are_salted(skewed, how):
    """A key above the limit is spread whatever its share; null keys and missing ones join as ever."""
    rows = skewed.select(F.when(F.col("id") % 10 > 0, F.col("k")).alias("k"), "id", "v")
    table = skewed.filter("k <> 'k1'").groupBy("k").agg(F.max("v").alias("m"))
    small = lookup_join(rows, table, ["k"], ["id"], how)
    salted = lookup_join(rows, table, ["k"], ["id"], how, max_rows=3, key_rows=300)
    assert small.columns == salted.columns
    key = lambda r: r["id"]
    assert sorted(small.collect(), key=key) == sorted(salted.collect(), key=key)


def test_wide_tables_are_not_broadcast(spark):
    wide = spark.range(50).select("id", F.array_repeat(F.lit(1.0), 100).alias("a"), F.array(F.lit("xy"), F.lit(None)).alias("b"))
    assert local_table(wide, max_bytes=10_000) is None
    assert local_table(wide).count() == 50
    assert local_table(spark.range(50).select(F.repeat(F.lit("x"), 100).alias("t")), max_bytes=1_000) is None


def test_bounds_are_checked(skewed):
    assert local_table(skewed, 10) is None
    assert local_table(skewed, 3000).count() == 3000
    with pytest.raises(ValueError):
        bounded_rows(skewed, 10)


def test_large_dictionary_codes(skewed):
    values = skewed.select(F.col("id").cast("string").alias("c"))
    expected = {v: i for i, v in enumerate(sorted(str(i) for i in range(3000)))}
    ranged = sorted_codes(values, "c", max_rows=10, parts=7)
    assert {r["c"]: r["code"] for r in ranged.collect()} == expected
    assert {r["c"]: r["code"] for r in sorted_codes(values, "c").collect()} == expected


def test_encoding_without_broadcast(skewed, monkeypatch):
    codes = category_codes(skewed.filter("k <> 'k1'"), "k")
    small = encode_category(skewed, codes, "k", ["id"]).collect()
    monkeypatch.setattr(bounded.lookup_join, "__defaults__", ("left", 3, 1000))
    salted = encode_category(skewed, codes, "k", ["id"]).collect()
    assert sorted(small) == sorted(salted)


def test_representatives_prune_before_the_shuffle(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    plan = representatives(rows, "vec_id", "label", "embedding", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_two_level_labels(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 1)], "id int, theme_top int, theme_sub_local int")
    labels = spark.createDataFrame([(0, 0, "billing")], "theme_top int, theme_sub_local int, label string")
    got = attach_labels(df, labels, ["theme_top", "theme_sub_local"], ["id"], out="sub_label").orderBy("id").collect()
    assert [r["sub_label"] for r in got] == ["billing", "Theme 0.1"]


@pytest.mark.parametrize("k", [1, 5, 50, 10_000])
def test_contenders_hold_the_top(skewed, k):
    fine = skewed.select((F.col("id") % 700).alias("g"), "k")
    coarse = skewed.select(F.lit(-1).cast("long").alias("g"), "k")
    counts = fine.unionByName(coarse).groupBy("g", "k").agg(F.count(F.lit(1)).alias("n"))
    left = contenders(counts, "n", k)
    order = [F.desc("n"), "k", "g"]
    assert left.orderBy(*order).limit(k).collect() == counts.orderBy(*order).limit(k).collect()
    assert k > 1 or left.count() == 1


def test_table_tfidf_shuffles_texts_once_and_not_their_terms(spark, monkeypatch):
    from caseworks.operators import tfidf

    docs = [(k % 40 if k % 7 else None, " ".join(f"w{(k * j) % 23}" for j in range(1, 30))) for k in range(120)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(docs, "id long, text string").repartition(5)
    vocabulary = tfidf.tfidf_vocabulary(docs, "text", max_features=50)
    rows = lambda df: sorted((str(r["id"]), r["term"], round(r["weight"], 9)) for r in df.collect())
    held = tfidf.tfidf_by_table(docs, "id", "text", vocabulary)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and "Exchange hashpartitioning(term" not in plan, plan
    monkeypatch.setattr(tfidf, "HELD_TERMS", 10)
    met = tfidf.tfidf_by_table(docs, "id", "text", vocabulary)
    assert rows(held) == rows(met) and len(rows(met)) > 100


def test_terms_are_counted_before_they_leave_a_batch(spark, monkeypatch):
    from collections import Counter

    from caseworks.operators import tfidf

    texts = [" ".join(f"w{(k * j) % 11}" for j in range(k % 9)) for k in range(60)] + [None, "", "one two one", "über Straße über"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    plan = tfidf.term_statistics(docs, "text")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan, plan
    expected = {}
    for (t,) in tfidf.with_terms(docs, "text", "t", (1, 2), tfidf.STOP_WORDS).select("t").collect():
        for term, n in Counter(t).items():
            tf, df = expected.get(term, (0, 0))
            expected[term] = (tf + n, df + 1)
    for size in (1 << 21, 7):
        monkeypatch.setattr(tfidf, "SLICE_TERMS", size)
        assert {r["term"]: (r["tf"], r["df"]) for r in tfidf.term_statistics(docs, "text").collect()} == expected
    import pyarrow as pa

    parts = list(tfidf.term_counts(pa.array([["z"], ["a", "b", "a"], [], ["b"], ["c"] * 9, ["a"]]).slice(1)))
    assert [(d.to_pylist(), tf.tolist(), n.tolist()) for d, tf, n in parts] == [(["a", "b"], [2, 2], [1, 2]), (["c"], [9], [1]), (["a"], [1], [1])]


def test_distances_of_text_themes_read_vectors_and_not_texts(spark, sf):
    from caseworks.queries.texts import kmeans_tfidf

    plan = kmeans_tfidf(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan, plan
