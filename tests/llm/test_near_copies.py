"""The near-duplicate stage on families of copies: links found, and pairs that grow with the rows."""

import random

import pytest
from pyspark.sql import functions as F

from caseworks.llm import common, decontamination, line_dedup, links, near_copies, simhash
from .test_pipeline import kept_of_similar


def family(rng, size, words=200, edits=5):
    """Copies of one text with ``edits`` words replaced in each."""
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for at in rng.sample(range(words), edits):
            copy[at] = f"v{rng.randrange(10**6)}"
        yield " ".join(copy)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


@pytest.fixture
def pairs(monkeypatch):
    """Number of pairs of each verification, before repeats go."""
    found = []
    verify = near_copies._similar

    def counted(pairs, nodes, sets):
        found.append(pairs.count())
        return verify(pairs, nodes, sets)

    monkeypatch.setattr(near_copies, "_similar", counted)
    return found


def test_pairs_grow_with_the_rows(spark, pairs):
    totals = []
    for size in (200, 800):
        pairs.clear()
        near_copies.keep_one(frame(spark, family(random.Random(1), size))).count()
        totals.append(sum(pairs))
    assert totals[1] <= 5 * totals[0], totals
    assert totals[1] <= 800 * 2 * near_copies.BANDS


def test_links_equal_brute_force_nearly(spark):
    rng = random.Random(2)
    texts = [t for size, edits in ((120, 2), (60, 3), (9, 1), (2, 2), (2, 4)) for t in family(rng, size, edits=edits)]
    texts += [f"only {k} here " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for k in range(40)]
    expected = kept_of_similar(dict(enumerate(texts)))
    removed = len(texts) - len(expected)
    docs = frame(spark, texts)
    found = sorted(r[0] for r in near_copies.keep_one(docs).collect())
    assert len(expected) <= len(found) <= len(expected) + 0.1 * removed
    thorough = sorted(r[0] for r in near_copies.keep_one(docs, thorough=True).collect())
    assert thorough == expected


@pytest.mark.parametrize("held", (near_copies.HELD, 500))
def test_full_buckets_lose_no_link(spark, monkeypatch, held):
    monkeypatch.setattr(near_copies, "HELD", held)
    sketches = near_copies.sketches
    same = F.array_repeat(F.lit(7).cast("long"), near_copies.BANDS)
    monkeypatch.setattr(near_copies, "sketches", lambda keyed, text="text": sketches(keyed, text).withColumn("bands", same))
    rng = random.Random(7)
    texts = [t for _ in range(20) for t in family(rng, 2, edits=1)]
    expected = kept_of_similar(dict(enumerate(texts)))
    assert len(expected) < 30
    assert sorted(r[0] for r in near_copies.keep_one(frame(spark, texts)).collect()) == expected


def test_a_block_gives_one_link_for_each_component():
    import pyarrow as pa

    rows = [(1, 1, range(100)), (2, 1, range(1, 101)), (3, 3, range(200, 300)), (4, 4, range(5, 105)), (5, 5, range(60, 160))]
    group = [dict(fp=f, root=r, shingles=list(s), apart=a) for a in (False, True) for f, r, s in rows if not a or r != 1]
    found = near_copies._block_links(pa.Table.from_pylist(group)).to_pylist()
    assert [(r["a"], r["b"]) for r in found] == [(4, 1)]


def test_sketches_estimate_the_similarity():
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(2))
    constants = near_copies.mixers()
    for same in (0.5, 0.8, 0.95):
        shared = rng.integers(0, 1 << 63, int(1000 * same), "uint64")
        sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 63, (1000 - len(shared)) // 2, "uint64")])) for _ in range(2)]
        one, two = (near_copies.least_hashes(s, *constants) for s in sets)
        exact = len(shared) / (len(sets[0]) + len(sets[1]) - len(shared))
        assert abs((one == two).mean() - exact) < 0.14
        assert (one == two).sum() <= ((one >> np.uint64(40)).astype("uint8") == (two >> np.uint64(40)).astype("uint8")).sum()
    assert near_copies.least_hashes(np.empty(0, "uint64"), *constants) is None and near_copies.band_keys(None) == []


def test_sets_and_sketches_leave_a_task_in_bounded_batches(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    runs = []
    monkeypatch.setattr(near_copies, "map_batches", lambda df, run, schema: runs.append(run) or df)
    monkeypatch.setattr(near_copies, "HELD", 1_000)
    monkeypatch.setattr(near_copies, "TEXTS", 50)
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(k % 90)) for k in range(120)] + [None]
    empty = spark.createDataFrame([], "fp long, text string")
    near_copies.shingle_sets(empty)
    near_copies.sketches(empty.select("fp", "text"))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["fp", "text"])
    sets = list(runs[0](iter([batch, batch.slice(0, 0)])))
    assert len(sets) > 3 and max(len(b.column(1).flatten()) for b in sets) < 1_000 + 90
    rows = [r for b in sets for r in b.to_pylist()]
    assert [r["fp"] for r in rows] == list(range(len(texts)))
    for r, text in zip(rows, texts, strict=True):
        assert r["shingles"] == np.unique(near_copies.simhash.shingle_hashes(text or "", near_copies.SHINGLE)).view("int64").tolist()
    assert [b.num_rows for b in runs[1](iter([batch]))] == [50, 50, 21]


def test_few_texts_need_the_encoding_of_whole_texts():
    import public_tokenizers

    from caseworks.llm import byte_bpe

    byte_bpe._encodings.cache_clear()
    own, whole = byte_bpe._encodings(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert byte_bpe.text_ids("a plain text " * 9_000, own, whole) and whole.made is None
    wide = "a" + " " * byte_bpe.GAP_LIMIT + " b"
    assert own.decode_bytes(byte_bpe.text_ids(wide, own, whole)) == wide.encode() and whole.made is not None


@pytest.fixture
def planned(monkeypatch):
    """Function that notes a table's plan, and the plans noted so far, those of stored tables included."""

    def planned(df):
        planned.plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    planned.plans = []
    for module in (common, links, line_dedup, near_copies, simhash):
        monkeypatch.setattr(module, "stored", lambda df, label, write=common.stored: write(planned(df), label))
    return planned


def test_fingerprint_joins_do_not_rely_on_the_size_spark_expects(spark, planned):
    docs = frame(spark, [*family(random.Random(4), 50), *family(random.Random(5), 5, edits=2)])
    planned(simhash.near_duplicates(docs))
    planned(simhash.keep_one(docs, max_bits=1, bucket=1))
    assert not [plan for plan in planned.plans if "Broadcast" in plan]
    assert sum("SortMergeJoin" in plan for plan in planned.plans) >= 8


def test_joins_of_the_stages_do_not_rely_on_the_size_spark_expects(spark, planned, monkeypatch):
    docs = frame(spark, [*family(random.Random(4), 50), *family(random.Random(5), 5, edits=2)])
    planned(line_dedup.remove_repeats(docs))
    planned(near_copies.keep_one(docs))
    found = spark.createDataFrame([(3, 1)], "doc_id long, text_hash long")
    monkeypatch.setattr(decontamination, "overlaps", lambda *args, **how: found)
    planned(decontamination.remove_contaminated(docs, docs))
    assert not [plan for plan in planned.plans if "Broadcast" in plan]
    assert sum("SortMergeJoin" in plan for plan in planned.plans) >= 10
