"""The layout of token files: encodings, row groups, page indexes, and reads that touch few pages."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from caseworks.llm import token_files
from caseworks.llm.queries import END_ID, WORD_BPE


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "store")
    words = F.transform(F.sequence(F.lit(0), F.pmod(F.xxhash64("id"), F.lit(40))), lambda i: F.concat(F.lit("word"), F.pmod(F.xxhash64("id", i), F.lit(3000))))
    docs = spark.range(12_000).select((F.col("id") * 7).alias("doc_id"), F.array_join(words, " ").alias("text")).coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        token_files.write(docs, f"file://{path}", WORD_BPE, END_ID)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    return path


def test_encodings_and_indexes(store):
    files = sorted(glob.glob(f"{store}/tokens/*.parquet"))
    assert files
    for file in files:
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
            ids = next(c for name, c in columns.items() if name.startswith("ids"))
            assert any("DICTIONARY" in e or e.startswith("DELTA") for e in ids.encodings)
            for name in ("place", "offset"):
                assert any(e.startswith("DELTA") for e in columns[name].encodings), columns[name].encodings
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
            assert all(c.statistics is not None for name, c in columns.items() if name in ("doc_id", "place"))


def scanned(df):
    """Rows that the scan of the token files handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()) if leaves.apply(k).metrics().contains("numOutputRows"))


def test_ten_documents_touch_their_pages_only(spark, store):
    tokens = spark.read.parquet(f"file://{store}/tokens")
    wanted = [7 * k for k in range(5000, 5010)]
    few = tokens.filter(F.col("doc_id").between(wanted[0], wanted[-1])).select("doc_id", "ids")
    assert sorted(r["doc_id"] for r in few.collect()) == wanted
    assert scanned(few) <= 2 * 2_000 < scanned(tokens.select("doc_id", "ids"))
    whole = {r["doc_id"]: r["ids"] for r in token_files.read(spark, f"file://{store}").collect()}
    assert len(whole) == 12_000 and all(r["ids"] == whole[r["doc_id"]] for r in few.collect())


def test_metadata_is_read_without_ids(spark, store):
    plan = token_files.read(spark, f"file://{store}", ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids:" not in plan.split("ReadSchema", 1)[1]


def test_word_memory_equals_the_tokenizer_on_odd_signs():
    import random

    memory = token_files._memory(WORD_BPE)
    rng = random.Random(12)
    bits = ["ab", "É", "ß", "İ", "'s", "'", "’", "..", "#$", "1", "23", "_", "²", "½", " ", "\n", "\t", "e\u0301", "<|", "<|endoftext|>", "\xa0", "\x1c", "don't", "“x”", "—", "ø", "İx", "ª", "µ", "Ω", "\x85", "-"]
    for k in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        (found,) = memory.packed([text])
        expected = b"".join(i.to_bytes(4, "little") for i in memory.tokenizer.encode(text, add_special_tokens=False).ids)
        assert found == expected, repr(text)


def test_plain_words_are_split_without_python(monkeypatch):
    memory = token_files._memory(WORD_BPE)
    seen = []
    split = token_files.WordMemory.split
    monkeypatch.setattr(token_files.WordMemory, "split", lambda self, part: seen.append(part) or split(self, part))
    texts = ["Plain words, Größe!! ABC&&& don't", "", "İx plain\nWords"]
    found = memory.packed(texts)
    assert set(seen) == {"", "don't", "İx"}
    for text, ids in zip(texts, found, strict=True):
        assert ids == b"".join(i.to_bytes(4, "little") for i in memory.tokenizer.encode(text, add_special_tokens=False).ids)
    assert memory.packed([]) == [] and memory.packed(["", "\n"]) == [b"", b""]
