"""The registered queries at the smallest size, and the pipeline against a brute-force version of its stages."""

import itertools
import re

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest

from caseworks.llm import byte_bpe
from caseworks.llm.queries import QUERIES, RANKS
from caseworks.sources.readers import table

from .test_operators import brute_components, brute_lines


@pytest.fixture(scope="module")
def labels(sf):
    return dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())


def kept_of_similar(texts):
    """Smallest id of each component of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more."""
    sets = {}
    for d, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        sets[d] = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    pairs = [
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    return sorted(set(brute_components(pairs, sorted(sets)).values()))


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf, labels):
    docs = table(spark, sf, "documents")
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf), "test")
        assert docs.columns == before.columns
        kept[name] = [(r["doc_id"], r["text"], r["n_chars"]) for r in before.collect()], [(r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()]
    before, after = kept["quality_classifier"]
    good, there = {d for d, q in labels.items() if q == 1}, {d for d, *_ in before}
    assert len(good & {d for d, *_ in after}) >= 0.95 * len(good & there)
    before, after = kept["line_dedup"]
    assert {d: t for d, t, _ in after} == brute_lines([(d, t) for d, t, _ in before])
    assert all(n == len(t) for _, t, n in after)
    before, after = kept["simhash_near_dedup"]
    assert sorted(d for d, *_ in after) == kept_of_similar({d: t for d, t, _ in before})
    own, whole = byte_bpe._encodings(RANKS, public_tokenizers.PATTERN)
    rows = corpus_pipeline.token_ids(spark, docs, sf).collect()
    texts = {d: t for d, t, _ in kept["benchmark_decontamination"][1]}
    assert {r["doc_id"]: r["ids"] for r in rows} == {d: byte_bpe.text_ids(t, own, whole) for d, t in texts.items()}
    assert all(r["round_trip"] for r in rows)
