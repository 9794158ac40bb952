"""Fill-in-the-middle against plain string work, and the chunk memory against counting anew."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseworks.llm import fill_middle
from caseworks.llm.fill_middle import Layout, Memory, chunk_ends, rolling, restored, transform

TEXTS = [
    (1, "one\ntwo\nthree"), (2, "one\ntwo\nthree\n"), (2, "one\ntwo\nthree\n"), (3, None), (4, ""), (5, "\n"), (6, "\n\n\n"), (7, "x"),
    (8, "has <S> in it\nand more"), (9, "é\nü\n𝄞𝄞\nend <P"), (None, "no id\nbut lines\n"), (10, "lorem ipsum\n" * 40_000), (11, "a" * 300_000),
    (12, "𝄞" * 30_000 + "\nlast"), (13, "<P\n>S>\n<M"), (-5, "below\nzero"),
]


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    mark = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(mark[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "rate", "spm"), [(7, 100, 50), (1, 50, 0), (2, 100, 100), (3, 0, 50)])
def test_equals_plain_strings(spark, seed, rate, spm):
    rows = [(i, t, "x", k) for k, (i, t) in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, `a.b` int").repartition(3)
    found = transform(docs, seed, rate, spm)
    assert found.columns == ["doc_id", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = {r["a.b"]: r for r in found.withColumn("back", restored(F.col("output"), F.col("form"))).collect()}
    assert len(got) == len(TEXTS)
    for k, (i, t) in enumerate(TEXTS):
        r = got[k]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(i, t, seed, rate, spm)
        assert r["back"] == (t or "")
    assert transform(docs.limit(0)).count() == 0


def test_rolling_hash_sees_its_window_only():
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.randrange(256) for _ in range(500)), "uint8")
    h = rolling(data)
    for at in (0, 5, 31, 32, 77, 499):
        reach = min(at + 1, fill_middle.WINDOW)
        assert int(h[at]) == sum(int(fill_middle.WEIGHTS[data[at - j]]) << j for j in range(reach)) % (1 << 32)


def test_chunks_cover_the_text_and_meet_again(monkeypatch):
    rng = random.Random(2)
    passage = "".join(rng.choice("abc déf\n") for _ in range(20_000)).encode()
    one = passage
    other = b"something else in front, " + passage + b" and behind"
    cut = lambda raw: [raw[a:b] for a, b in zip([0, *chunk_ends(raw)], chunk_ends(raw))]
    assert b"".join(cut(one)) == one and b"".join(cut(other)) == other
    for part in (*cut(one), *cut(other)):
        part.decode()
        assert len(part) <= fill_middle.MOST
    shared = set(cut(one)) & set(cut(other))
    assert sum(map(len, shared)) > 0.8 * len(one)
    whole = chunk_ends(other)
    monkeypatch.setattr(fill_middle, "BLOCK", 1000)
    assert chunk_ends(other) == whole
    assert chunk_ends(b"") == []


def test_memory_is_bounded_and_checks_content(monkeypatch):
    memory = Memory(limit=4_000)
    rng = random.Random(3)
    contents = [bytes(rng.choice(b"ab\n") for _ in range(300)) for _ in range(60)]
    for c in [*contents, *contents[::-1]]:
        assert memory.summary(c).content == c
        assert sum(len(s.content) for s in {**memory.young, **memory.old}.values()) <= 4_000 + 2 * 5_000
    assert memory.hits and memory.misses > 60
    import xxhash

    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda c: 1)
    memory = Memory()
    for c in contents:
        found = memory.summary(c)
        assert found.content == c and len(found.breaks) == c.count(b"\n")


def test_places_of_lines_in_any_chunking(monkeypatch):
    monkeypatch.setattr(fill_middle, "LEAST", 4)
    monkeypatch.setattr(fill_middle, "CUT_BITS", 2)
    monkeypatch.setattr(fill_middle, "MOST", 16)
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["a", "é", "\n", "𝄞", "<", "P", ">", "<M>"[: rng.randint(1, 3)]]) for _ in range(rng.randint(0, 120)))
        layout = Layout(text.encode(), Memory())
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert layout.lines == len(lines)
        assert layout.marked == any(m in text for m in ("<P>", "<S>", "<M>"))
        for c in range(len(lines) + 1):
            lead = "".join(lines[:c])
            assert layout.after(c) == (len(lead.encode()), len(lead))
