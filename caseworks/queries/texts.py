"""TF-IDF, themes, labels, sentiment, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseworks.functions.text import STOP_WORDS
from caseworks.functions.vectors import cosine_distance, l2_norm, l2_normalize
from caseworks.operators import embedding, sentiment, themes
from caseworks.operators.tfidf import fit_tfidf, tfidf, tfidf_by_table, tfidf_vocabulary, vector_entries
from caseworks.plans.bounded import lookup_join
from caseworks.plans.stages import write_stage
from caseworks.queries.common import document_vectors, r6, table
from caseworks.queries.records import STRIP, WORDS

VOCABULARY = 20_000
# A small valence list over frequent words of the test texts.
LEXICON = [("the", 1.0), ("of", -1.5), ("and", 0.5), ("is", -2.0), ("de", -0.7), ("der", 0.9), ("que", -0.4), ("les", 1.2)]


def _docs(spark, sf, *columns):
    return table(spark, sf, "documents", spread=True).select("doc_id", "text", *columns)


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")
# Frequent words in the parts of negations, boosters and the contrast word.
NEGATIONS, BOOSTERS, CONTRAST = ["not", "en", "nicht", "ne"], {"to": 0.293, "in": 0.293, "die": -0.293, "el": -0.293, "la": 0.293}, "with"


# TF-IDF


def tfidf_table(spark, sf):
    """Every term of three documents or more, up to two million, as a table."""
    docs = _docs(spark, sf)
    found = tfidf_by_table(docs, "doc_id", "text", tfidf_vocabulary(docs, "text", max_features=2_000_000))
    return found.select("doc_id", "term", r6("weight").alias("weight"))


def tfidf_weights(spark, sf):
    return tfidf(_docs(spark, sf), "doc_id", "text", max_features=VOCABULARY).select("doc_id", "term", r6("weight").alias("weight"))


def theme_keywords(spark, sf):
    docs = _docs(spark, sf, "lang")
    model = fit_tfidf(docs, "text", max_features=VOCABULARY)
    return themes.theme_keywords(model.transform(docs, "text"), "lang", model)


# Themes


def l2_norms(spark, sf):
    unit = l2_normalize("embedding")
    return _vectors(spark, sf).select("vec_id", r6(l2_norm("embedding")).alias("norm"), r6(unit[0]).alias("first"))


def centroids(spark, sf):
    found = themes.centroids(_vectors(spark, sf), "label", "embedding")
    return found.select("theme", F.posexplode("centre").alias("pos", "value")).withColumn("value", r6("value"))


def assign_nearest(spark, sf):
    rows = _vectors(spark, sf)
    found = themes.assign_nearest(rows, "vec_id", "embedding", themes.centroids(rows, "label", "embedding"))
    return found.withColumn("distance", r6("distance"))


def assign_nearest_cosine(spark, sf):
    rows = _vectors(spark, sf)
    centres = themes.centroids(rows, "label", "embedding")
    found = themes.assign_nearest(rows, "vec_id", "embedding", centres, metric="cosine")
    return found.withColumn("distance", r6("distance"))


def representatives(spark, sf):
    found = themes.representatives(_vectors(spark, sf), "vec_id", "label", "embedding", 3)
    return found.select("theme", "vec_id", r6("distance").alias("distance"), "rank")


def cluster_counts(spark, sf):
    return themes.cluster_counts(_vectors(spark, sf), "label")


def theme_labels(spark, sf):
    return themes.theme_labels(document_vectors(spark, sf), "doc_id", "theme", "embedding", "text")


def label_requests(spark, sf):
    return themes.label_requests(document_vectors(spark, sf), "doc_id", "theme", "embedding", "text", "source", n=6)


def label_requests_nested(spark, sf):
    """Second level: the source inside a theme; the parent line names the theme."""
    rows = document_vectors(spark, sf).withColumn("sub", F.concat_ws(".", F.col("theme").cast("string"), "source"))
    parents = rows.select(F.col("sub").alias("theme"), F.concat(F.lit("Theme "), F.col("theme")).alias("parent_label")).distinct()
    return themes.label_requests(rows, "doc_id", "sub", "embedding", "text", "source", n=3, max_chars=200, parents=parents)


def attach_labels(spark, sf):
    """Themes 0 to 6 have a label, one of which failed; the others show their number."""
    rows = _vectors(spark, sf).select("vec_id", F.col("label").alias("theme"))
    named = themes.cluster_counts(_vectors(spark, sf), "label").filter("theme < 7").select(
        "theme",
        themes.label_outcome(
            F.concat(F.lit("Topic "), F.col("tickets")), F.when(F.col("theme") == 3, F.lit("timeout"))
        ).alias("label"),
    )
    return themes.attach_labels(rows, named, "theme", ["vec_id"])


def _sizes(assigned, key):
    """Every row with the number of different themes, counted once."""
    return assigned.withColumn("themes", F.lit(assigned.select("theme").distinct().count())).select(key, "theme", "themes")


def kmeans_themes(spark, sf):
    """Is every vector in the theme whose centre is nearest, found anew from the centres?"""
    rows = _vectors(spark, sf)
    assigned, centres = themes.kmeans_with_centres(rows, "vec_id", "embedding", k=12)
    nearest = themes.assign_nearest(rows, "vec_id", "embedding", centres, out="nearest")
    both = _sizes(assigned, "vec_id").join(nearest, "vec_id")
    return both.select("vec_id", (F.col("theme") == F.col("nearest")).alias("at_nearest"), "themes")


def kmeans_tfidf(spark, sf):
    """The same for themes of texts, the distances added up term by term."""
    docs = _docs(spark, sf)
    # Read by the fit and by the distances below, so the texts are not turned into vectors twice.
    vectors, _ = write_stage(fit_tfidf(docs, "text", max_features=VOCABULARY).transform(docs, "text").drop("text"), "vectors")
    assigned, centres = themes.kmeans_with_centres(vectors, "doc_id", "features", k=4)
    square = F.aggregate("centre", F.lit(0.0), lambda a, x: a + x * x)
    entries = vectors.select("doc_id", F.explode_outer(vector_entries("features")).alias("e")).select("doc_id", "e.idx", "e.w")
    weights = centres.select("theme", F.posexplode("centre").alias("idx", "c"))
    by_term = weights.groupBy("idx").agg(F.map_from_entries(F.collect_list(F.struct("theme", "c"))).alias("m"))
    norms = {r["theme"]: r["n"] for r in centres.select("theme", square.alias("n")).collect()}
    dots = [F.coalesce(F.sum(F.col("w") * F.element_at("m", F.lit(t))), F.lit(0.0)).alias(f"d{t}") for t in sorted(norms)]
    summed = entries.join(by_term, "idx", "left").groupBy("doc_id").agg(*dots)
    distances = {t: F.lit(norms[t]) - 2 * F.col(f"d{t}") for t in norms}
    own = F.element_at(F.map_from_arrays(F.array(*map(F.lit, norms)), F.array(*distances.values())), F.col("theme"))
    both = _sizes(assigned, "doc_id").join(summed, "doc_id")
    return both.select("doc_id", (own <= F.least(*distances.values()) + 1e-9).alias("at_nearest"), "themes")


def hierarchical_themes(spark, sf):
    """Tickets and parts of every given theme."""
    found = themes.hierarchical_themes(_vectors(spark, sf), "vec_id", "embedding", min_sub=12, top="label")
    return found.groupBy("theme_top").agg(
        F.count(F.lit(1)).alias("tickets"), F.countDistinct("theme_sub_id").alias("parts"), F.max("theme_sub_local").cast("long").alias("last_part")
    )


# Sentiment


def _lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, valence double")


def _scored(spark, sf):
    return sentiment.lexicon_sentiment(
        _docs(spark, sf, "lang"), "doc_id", "text", _lexicon(spark), ["lang"], NEGATIONS, BOOSTERS, CONTRAST
    )


def lexicon_sentiment(spark, sf):
    scored = _scored(spark, sf)
    return scored.select("doc_id", r6("compound").alias("compound"), sentiment.is_upset(r6("compound")).alias("upset"))


def sentiment_by_theme(spark, sf):
    labels = spark.createDataFrame([("en", "English"), ("fr", "French")], "theme string, label string")
    found = sentiment.sentiment_by_theme(_scored(spark, sf), "lang", "compound", sentiment.is_upset(r6("compound")), labels=labels)
    return found.select("theme", "tickets", r6("avg_score").alias("avg_score"), r6("upset_rate").alias("upset_rate"), "label")


def most_negative(spark, sf):
    rounded = _scored(spark, sf).withColumn("compound", r6("compound"))
    return sentiment.most_negative(rounded, "doc_id", "compound", 10).select("doc_id", "lang", "compound")


def _share_of_e(texts):
    """Stand-in scorer: the share of the letter e, no answer for texts that start with one."""
    return [None if t[:1] in ("E", "e") else ("NEGATIVE", round(t.count("e") / max(len(t), 1), 6)) for t in texts]


def score_sentiment(spark, sf):
    found = sentiment.score_sentiment(_docs(spark, sf), "doc_id", "text", _share_of_e)
    return found.withColumn("upset", sentiment.is_upset("negative_score", 0.1, mode="ge"))


# Embeddings


def _length_and_spaces(texts):
    return [[float(len(t)), float(t.count(" "))] for t in texts]


def embed_docs(spark, sf):
    found = embedding.embed(_docs(spark, sf), "doc_id", "text", _length_and_spaces)
    return found.select("doc_id", F.col("embedding")[0].cast("double").alias("chars"), F.col("embedding")[1].cast("double").alias("spaces"))


def embed_hashed(spark, sf):
    """Unit length and dimension of the offline embedding."""
    found = embedding.embed_hashed(_docs(spark, sf), "doc_id", "text", 64)
    return found.select("doc_id", F.size("embedding").alias("dim"), F.round(l2_norm("embedding"), 4).alias("norm"))


def parse_embeddings(spark, sf):
    """Embeddings wrapped in each payload shape; cluster 9 comes as text and must be refused."""
    vec = F.col("embedding").cast("array<double>")
    listed, typed, keyed = (
        F.to_json(F.struct(F.array(vec).alias("embeddings"))),
        F.to_json(F.struct(F.struct(F.array(vec).alias("float")).alias("embeddings"))),
        F.to_json(F.struct(F.array(F.struct(vec.alias("embedding"))).alias("embeddings"))),
    )
    texts = F.to_json(F.struct(F.array(vec.cast("array<string>")).alias("embeddings")))
    label = F.col("label")
    payload = F.when(label < 3, listed).when(label < 6, typed).when(label < 9, keyed).otherwise(texts)
    good, refused = embedding.split_payloads(_vectors(spark, sf).select("vec_id", payload.alias("payload")), "payload")
    flat = good.select("vec_id", F.posexplode(F.col("vectors")[0]).alias("pos", "value"))
    nothing = refused.select("vec_id", F.lit(-1).alias("pos"), F.lit(None).cast("double").alias("value"))
    return flat.withColumn("value", r6("value")).unionByName(nothing)


def cosine_pairs(spark, sf):
    """Distance of every vector to the centre of its own cluster."""
    rows = _vectors(spark, sf)
    centres = themes.centroids(rows, "label", "embedding").withColumnRenamed("theme", "label")
    joined = lookup_join(rows, centres, ["label"], ["vec_id"], "inner")
    return joined.select("vec_id", r6(cosine_distance("embedding", "centre")).alias("distance"))


_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def tfidf_sql(source: str, key: str, min_df: int, cap: int) -> str:
    """CTEs up to ``x``(key…, doc_id, term, weight); ``key`` is '' for the corpus or a grouping column."""
    g = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    join = f"USING ({g}term)"
    docs = f"(SELECT {key}, count(*) AS docs FROM d GROUP BY 1)" if key else "(SELECT count(*) AS docs FROM d)"
    with_docs = f"JOIN {docs} USING ({key})" if key else f"CROSS JOIN {docs}"
    return f"""
d AS ({source}),
w0 AS (SELECT {g}doc_id, list_filter({WORDS}, lambda t: NOT list_contains({_STOP}, t)) AS toks FROM d),
w AS (SELECT {g}doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM w0),
t AS (
  SELECT {g}doc_id, tok AS term FROM w
  UNION ALL
  SELECT {g}doc_id, term FROM (
    SELECT {g}doc_id, tok || ' ' || lead(tok) OVER (PARTITION BY {g}doc_id ORDER BY i) AS term FROM w
  ) WHERE term IS NOT NULL
),
n AS (SELECT {g}doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
v0 AS (SELECT {g}term, sum(tf) AS tf, count(*) AS df FROM n GROUP BY ALL HAVING count(*) >= {min_df}),
v1 AS (SELECT *, row_number() OVER ({part}ORDER BY tf DESC, term) AS rk FROM v0),
v AS (SELECT {g}term, ln((1.0 + docs) / (1.0 + df)) + 1.0 AS idf FROM v1 {with_docs} WHERE rk <= {cap}),
x0 AS (SELECT {g}n.doc_id, term, n.tf * v.idf AS u FROM n JOIN v {join}),
x AS (SELECT *, u / sqrt(sum(u * u) OVER (PARTITION BY {g}doc_id)) AS weight FROM x0)"""


_CENTRES = """
e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c0 AS (SELECT label AS theme, pos, avg(v) AS v FROM e GROUP BY 1, 2),
c AS (SELECT theme, list(v ORDER BY pos) AS centre FROM c0 GROUP BY 1)"""
_VEC = "list_transform(embedding, lambda a: a::DOUBLE)"
_REPS = f"""
{_CENTRES},
p AS (
  SELECT vec_id, label AS theme, 1 - list_cosine_similarity({_VEC}, centre) AS distance FROM embeddings JOIN c ON c.theme = label
),
r AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY distance, vec_id) AS rank FROM p)"""
_DOCREPS = f"""
{_CENTRES},
p AS (
  SELECT doc_id, source, text, label AS theme, 1 - list_cosine_similarity({_VEC}, centre) AS distance
  FROM embeddings JOIN c ON c.theme = label JOIN documents ON doc_id = vec_id
),
"""
# The centre of a theme is the mean of the vectors that have a document.
_DOCCENTRES = _DOCREPS.replace("FROM embeddings),", "FROM embeddings JOIN documents ON doc_id = vec_id),")


def _assign_sql(distance: str) -> str:
    return f"""WITH {_CENTRES},
a AS (SELECT vec_id, theme, {distance} AS distance FROM embeddings CROSS JOIN c),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, theme) AS rk FROM a)
SELECT vec_id, theme, round(distance, 6) AS distance FROM k WHERE rk = 1"""


def _requests_sql(theme: str, n: int, chars: int, parent: str = "") -> str:
    example = STRIP.format(x="replace('Subject: ' || source || chr(10) || 'Ticket: ' || text, chr(10), ' ')")
    head = f"'{themes.LABEL_TASK}' || chr(10) || {parent}'Ticket examples:' || chr(10)"
    centres = "" if theme == "theme" else None
    if centres == "":
        scored = f"{_DOCCENTRES} s AS (SELECT *, theme AS grp FROM p)"
    else:
        scored = f"""
j AS (SELECT doc_id, source, text, label, {theme} AS grp, embedding FROM embeddings JOIN documents ON doc_id = vec_id),
e AS (SELECT grp, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos FROM j),
c0 AS (SELECT grp, pos, avg(v) AS v FROM e GROUP BY 1, 2),
c AS (SELECT grp, list(v ORDER BY pos) AS centre FROM c0 GROUP BY 1),
s AS (SELECT j.*, label AS theme, 1 - list_cosine_similarity({_VEC}, centre) AS distance FROM j JOIN c USING (grp))"""
    return f"""WITH {scored},
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY distance, doc_id) AS rank, count(*) OVER (PARTITION BY grp) AS tickets FROM s)
SELECT grp AS theme, any_value(tickets) AS tickets,
       any_value({head}) || string_agg(left({example}, {chars}), chr(10) ORDER BY rank) AS request
FROM r WHERE rank <= {n} GROUP BY grp"""


def _case(word: str, entries: dict[str, float]) -> str:
    return f"CASE {word} " + " ".join(f"WHEN '{t}' THEN {v}::DOUBLE" for t, v in entries.items()) + " END"


_BARE = (
    r"list_transform(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> ''), "
    r"lambda w: regexp_replace(w, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+\z', '', 'g'))"
)
_LEX = f"""
b0 AS (SELECT doc_id, lang, text, {_BARE} AS bare FROM documents),
b1 AS (
  SELECT doc_id, lang, list_transform(bare, lambda w: lower(w)) AS low, list_transform(bare, lambda w: w = upper(w) AND w <> lower(w)) AS loud,
         length(text) - length(replace(text, '!', '')) AS bangs, length(text) - length(replace(text, '?', '')) AS asked FROM b0
),
b2 AS (
  SELECT *, list_transform(low, lambda w: {_case("w", dict(LEXICON))}) AS val, list_transform(low, lambda w: {_case("w", BOOSTERS)}) AS boost,
         list_transform(low, lambda w: w IN ({", ".join(f"'{w}'" for w in NEGATIONS)})) AS neg,
         coalesce(list_position(low, '{CONTRAST}'), 0) AS turn, list_contains(loud, true) AND list_contains(loud, false) AS mixed FROM b1
),
w AS (
  SELECT doc_id, unnest(val) AS v, unnest(loud) AND mixed AS loud, generate_subscripts(val, 1) AS i, turn,
         unnest(list_transform(boost, lambda x, k: CASE WHEN val[k] IS NULL THEN x END)) AS boost, unnest(neg) AS neg FROM b2
),
g AS (
  SELECT *, coalesce(lag(boost, 1) OVER o, 0) + 0.95 * coalesce(lag(boost, 2) OVER o, 0) + 0.9 * coalesce(lag(boost, 3) OVER o, 0) AS up,
         (CASE WHEN lag(neg, 1) OVER o THEN -0.74 ELSE 1.0 END)::DOUBLE * (CASE WHEN lag(neg, 2) OVER o THEN -0.74 ELSE 1.0 END)::DOUBLE
         * (CASE WHEN lag(neg, 3) OVER o THEN -0.74 ELSE 1.0 END)::DOUBLE AS turned
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
h AS (
  SELECT doc_id, sum((v + sign(v) * ((CASE WHEN loud THEN 0.733 ELSE 0 END)::DOUBLE + up)) * turned
                     * (CASE WHEN turn = 0 OR i = turn THEN 1.0 WHEN i < turn THEN 0.5 ELSE 1.5 END)::DOUBLE) AS s
  FROM g WHERE v IS NOT NULL GROUP BY 1
),
u AS (
  SELECT doc_id, lang, coalesce(s, 0)::DOUBLE AS s, least(bangs, 4) * 0.292::DOUBLE
         + (CASE WHEN asked <= 1 THEN 0 WHEN asked <= 3 THEN asked * 0.18 ELSE 0.96 END)::DOUBLE AS strength
  FROM b1 LEFT JOIN h USING (doc_id)
),
t AS (SELECT doc_id, lang, s + sign(s) * strength AS s FROM u),
q AS (SELECT doc_id, lang, s / sqrt(s * s + 15.0) AS compound FROM t)"""
_CUT = """
k AS (SELECT doc_id, text AS t FROM documents)"""

QUERIES = {
    "tfidf_table": (
        tfidf_table,
        f"WITH {tfidf_sql('SELECT doc_id, text FROM documents', '', 3, 2_000_000)} SELECT doc_id, term, round(weight, 6) AS weight FROM x",
    ),
    "tfidf_weights": (
        tfidf_weights,
        f"WITH {tfidf_sql('SELECT doc_id, text FROM documents', '', 3, VOCABULARY)} SELECT doc_id, term, round(weight, 6) AS weight FROM x",
    ),
    "theme_keywords": (
        theme_keywords,
        f"""WITH {tfidf_sql('SELECT doc_id, text FROM documents', '', 3, VOCABULARY)},
z AS (SELECT lang, count(*) AS docs FROM documents GROUP BY 1),
m AS (SELECT lang, term, sum(weight) / any_value(docs) AS weight FROM x JOIN documents USING (doc_id) JOIN z USING (lang) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY round(weight, 9) DESC, term) AS rk FROM m)
SELECT lang AS theme, string_agg(term, ', ' ORDER BY rk) AS keywords FROM r WHERE rk <= 10 GROUP BY 1""",
    ),
    "l2_norms": (
        l2_norms,
        f"""WITH n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda a: a::DOUBLE * a::DOUBLE))) AS norm FROM embeddings)
SELECT vec_id, round(norm, 6) AS norm, round(embedding[1]::DOUBLE / norm, 6) AS first FROM n""",
    ),
    "centroids": (
        centroids,
        f"WITH {_CENTRES} SELECT theme, CAST(pos - 1 AS INTEGER) AS pos, round(v, 6) AS value FROM c0",
    ),
    "assign_nearest": (
        assign_nearest,
        _assign_sql(
            "sqrt(greatest(list_dot_product("
            f"{_VEC}, {_VEC}) - 2 * list_dot_product({_VEC}, centre) + list_dot_product(centre, centre), 0))"
        ),
    ),
    "assign_nearest_cosine": (assign_nearest_cosine, _assign_sql(f"1 - list_cosine_similarity({_VEC}, centre)")),
    "representatives": (
        representatives,
        f"WITH {_REPS} SELECT theme, vec_id, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3",
    ),
    "cosine_pairs": (cosine_pairs, f"WITH {_REPS} SELECT vec_id, round(distance, 6) AS distance FROM p"),
    "cluster_counts": (cluster_counts, "SELECT label AS theme, count(*) AS tickets FROM embeddings GROUP BY 1"),
    "theme_labels": (
        theme_labels,
        "WITH "
        + _DOCCENTRES
        + """
r AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY distance, doc_id) AS rk FROM p),
"""
        + tfidf_sql("SELECT theme, doc_id, text FROM r WHERE rk <= 25", "theme", 2, 2000)
        + """,
z AS (SELECT theme, count(*) AS docs FROM d GROUP BY 1),
m AS (SELECT theme, term, sum(weight) / any_value(docs) AS weight FROM x JOIN z USING (theme) GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY round(weight, 9) DESC, term) AS rk FROM m),
l AS (SELECT theme, string_agg(term, ', ' ORDER BY rk) AS label FROM b WHERE rk <= 5 GROUP BY 1)
SELECT theme, coalesce(label, '') AS label, count(*) AS tickets FROM p LEFT JOIN l USING (theme) GROUP BY ALL""",
    ),
    "label_requests": (label_requests, _requests_sql("theme", 6, 1200)),
    "label_requests_nested": (
        label_requests_nested,
        _requests_sql("CAST(label AS VARCHAR) || '.' || source", 3, 200, "'Parent theme: Theme ' || theme || chr(10) || "),
    ),
    "attach_labels": (
        attach_labels,
        """WITH k AS (SELECT label AS theme, count(*) AS n FROM embeddings GROUP BY 1)
SELECT vec_id, theme, CASE WHEN theme >= 7 THEN 'Theme ' || theme WHEN theme = 3 THEN '(error: timeout)' ELSE 'Topic ' || n END AS label
FROM (SELECT vec_id, label AS theme FROM embeddings) JOIN k USING (theme)""",
    ),
    "kmeans_themes": (kmeans_themes, "SELECT vec_id, true AS at_nearest, 12 AS themes FROM embeddings"),
    "kmeans_tfidf": (kmeans_tfidf, "SELECT doc_id, true AS at_nearest, 4 AS themes FROM documents"),
    "hierarchical_themes": (
        hierarchical_themes,
        """SELECT label AS theme_top, count(*) AS tickets, least(4, greatest(1, count(*) // 12)) AS parts,
       least(4, greatest(1, count(*) // 12)) - 1 AS last_part FROM embeddings GROUP BY 1""",
    ),
    "lexicon_sentiment": (
        lexicon_sentiment,
        f"WITH {_LEX} SELECT doc_id, round(compound, 6) AS compound, round(compound, 6) < -0.5 AS upset FROM q",
    ),
    "sentiment_by_theme": (
        sentiment_by_theme,
        f"""WITH {_LEX}
SELECT lang AS theme, count(*) AS tickets, round(avg(compound), 6) AS avg_score,
       round(avg(CASE WHEN round(compound, 6) < -0.5 THEN 1.0 ELSE 0.0 END), 6) AS upset_rate,
       CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE 'Theme ' || lang END AS label
FROM q GROUP BY lang""",
    ),
    "most_negative": (
        most_negative,
        f"WITH {_LEX} SELECT doc_id, lang, round(compound, 6) AS compound FROM q ORDER BY round(compound, 6), doc_id LIMIT 10",
    ),
    "score_sentiment": (
        score_sentiment,
        f"""WITH {_CUT},
n AS (SELECT doc_id, left(t, 1) IN ('E', 'e') AS none,
             round((length(t) - length(replace(t, 'e', '')))::DOUBLE / greatest(length(t), 1), 6) AS share FROM k)
SELECT doc_id, CASE WHEN none THEN 'NEUTRAL' ELSE 'NEGATIVE' END AS sentiment_label,
       CASE WHEN none THEN 0.0 ELSE share END AS negative_score, CASE WHEN none THEN false ELSE share >= 0.1 END AS upset FROM n""",
    ),
    "embed_docs": (
        embed_docs,
        "WITH t AS (SELECT doc_id, " + STRIP.format(x="replace(text, chr(10), ' ')") + " AS t FROM documents) "
        "SELECT doc_id, length(t)::DOUBLE AS chars, (length(t) - length(replace(t, ' ', '')))::DOUBLE AS spaces FROM t",
    ),
    "embed_hashed": (
        embed_hashed,
        f"SELECT doc_id, 64 AS dim, CASE WHEN len({WORDS}) > 0 THEN 1.0 ELSE 0.0 END AS norm FROM documents",
    ),
    "parse_embeddings": (
        parse_embeddings,
        "SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, round(unnest(embedding)::DOUBLE, 6) AS value "
        "FROM embeddings WHERE label <> 9 UNION ALL SELECT vec_id, -1, NULL FROM embeddings WHERE label = 9",
    ),
}
