"""Registered queries of the training-data operators: name -> (Spark query, equivalent SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.llm import (
    byte_bpe,
    decontamination,
    fill_middle,
    language,
    line_dedup,
    orchard,
    quality_gam,
    quality_rules,
    secrets,
    simhash,
    token_files,
    toxicity,
    warc,
)
from caseworks.llm.common import shared_path, stored
from caseworks.llm.sampling import fold_of
from caseworks.sources.readers import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    lexicon = toxicity.learn(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs, lexicon)
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    pairs = decontamination.overlaps(documents(spark, sf), table(spark, sf, "benchmark"))
    return pairs.select("doc_id", "item_id", F.col("equal").cast("long").alias("n_equal"), F.col("length").cast("long").alias("n_compared"))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf, "pages"), path)
    return warc.read(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h"""


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write(documents(spark, sf), path, WORD_BPE, END_ID)
    return token_files.checksums(token_files.read(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf))


def op6_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = secrets.in_order(F.concat("base", "entropy"))
    return found.select(
        "doc_id",
        *map(count, secrets.KINDS),
        F.sha2(secrets.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(every).alias("spans"),
    )


def op7_quality_gam(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    model = quality_gam.train(docs, table(spark, sf, "labels"))
    return quality_gam.score(docs, model).select(
        "doc_id",
        (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= quality_gam.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    counts = stored(quality_rules.measure(documents(spark, sf)), "counts")
    cutoffs = quality_rules.calibrate(counts, table(spark, sf, "labels")).collect()
    return quality_rules.verdict(counts, cutoffs)


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.remove_repeats(documents(spark, sf), removed="n_removed")
    return cleaned.select("doc_id", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, n, line, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
),
c AS (SELECT doc_id, n, bare, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k, count(*) OVER (PARTITION BY doc_id) AS total FROM l WHERE bare <> ''),
w AS (
  SELECT doc_id, k, CASE WHEN total >= 3 THEN concat_ws(chr(10), bare, lead(bare) OVER g, lead(bare, 2) OVER g)
                         ELSE concat_ws(chr(10), bare, lead(bare) OVER g) END AS win
  FROM c WINDOW g AS (PARTITION BY doc_id ORDER BY k)
  QUALIFY k <= greatest(total - 2, 1)
),
r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY win ORDER BY doc_id, k) AS seen FROM w),
gone AS (SELECT DISTINCT doc_id, k + o AS k FROM r, unnest([0, 1, 2]) AS u(o) WHERE seen > 1),
kept AS (
  SELECT l.doc_id, l.n, l.line, g.k IS NOT NULL AS removed
  FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.n = c.n LEFT JOIN gone g ON c.doc_id = g.doc_id AND c.k = g.k
)
SELECT doc_id, count(*) FILTER (removed) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT removed), '')) AS text_md5
FROM kept GROUP BY doc_id"""


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    encoded = byte_bpe.encode(documents(spark, sf), RANKS, public_tokenizers.PATTERN, packed=True).select("doc_id", "ids")
    decoded = byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_fill_middle(spark: SparkSession, sf: str) -> DataFrame:
    made = fill_middle.transform(documents(spark, sf))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS mark
  FROM documents
),
c AS (
  SELECT *, CAST(len(parts) - 1 AS BIGINT) AS breaks, CAST(len(parts) - (parts[-1] = '')::INT AS BIGINT) AS n,
         ('0x' || mark[1:8])::BIGINT AS h1, ('0x' || mark[9:16])::BIGINT AS h2, ('0x' || mark[25:32])::BIGINT AS h4
  FROM t
),
p AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM c),
u AS (SELECT *, list_transform(parts, lambda x, i : CASE WHEN i <= breaks THEN x || chr(10) ELSE x END) AS units FROM p),
s AS (
  SELECT doc_id, n, text, h4, array_to_string(units[1:a], '') AS prefix,
         array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM u
)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars, CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN h4 % 100 < 50 THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s"""


def op12_orchard(spark: SparkSession, sf: str) -> DataFrame:
    return orchard.clusters(table(spark, sf, "embeddings"))


def _op12_sql(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """The rounds written out one after the other, every vector measured against every centroid."""
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda v : CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda v : v IS NULL OR NOT isfinite(v))) = 0
),
v AS MATERIALIZED (SELECT row, unnest(range({dims})) AS place, unnest(x) AS value FROM kept),
m0 AS MATERIALIZED (
  SELECT c, unnest(range({dims})) AS place, unnest(x) AS value
  FROM (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS c, x FROM kept
        QUALIFY c < {k})
)"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row, min_by(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT row, c, sum((v.value - m{n}.value) * (v.value - m{n}.value)) AS d FROM v JOIN m{n} USING (place) GROUP BY row, c)
  GROUP BY row
)""")
        if n < rounds:
            steps.append(f"""
m{n + 1} AS MATERIALIZED (
  SELECT m.c, m.place, coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, m.value) AS value
  FROM m{n} m LEFT JOIN (SELECT c, place, sum(value) AS total, count(*) AS n FROM v JOIN a{n} USING (row) GROUP BY c, place) s
    ON m.c = s.c AND m.place = s.place
)""")
    final = f"m{rounds}", f"a{rounds}"
    return f"""
WITH {",".join(steps)},
marks AS (SELECT c, sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY place)) AS mark FROM {final[0]} GROUP BY c)
SELECT kept.vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, mark AS centroid_sha256
FROM {final[1]} JOIN kept USING (row) JOIN marks USING (c)"""


def op13_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs.select("doc_id", "text"), language.train(docs))
    held_out = F.coalesce(fold_of(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "runner_up", "ambiguous")


QUERIES = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_decontamination": (op2_decontamination, None),
    "op3_warc": (op3_warc, OP3_SQL),
    "op4_token_files": (op4_token_files, None),
    "op5_simhash": (op5_simhash, None),
    "op6_secrets": (op6_secrets, None),
    "op7_quality_gam": (op7_quality_gam, None),
    "op8_quality_rules": (op8_quality_rules, None),
    "op9_line_dedup": (op9_line_dedup, OP9_SQL),
    "op10_byte_bpe": (op10_byte_bpe, None),
    "op11_fill_middle": (op11_fill_middle, OP11_SQL),
    "op12_orchard": (op12_orchard, _op12_sql()),
    "op13_language": (op13_language, None),
}
