"""Language identification: codes, scores against a plain version, held-out accuracy, awkward rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from caseworks.llm import language
from caseworks.sources.readers import table


@pytest.fixture(scope="module")
def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def model(docs):
    return language.train(docs)


def test_codewords_lie_apart():
    for n in (2, 3, 4, 7):
        code = language.codewords(n)
        assert code.shape == (n, 2 ** (n - 1) - 1)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= 2 ** (n - 2)
    for n in (8, 30, 100):
        code = language.codewords(n)
        assert (np.abs(code.sum(0, dtype=int)) < n).all()
        assert min((code[a] != code[b]).sum() for a in range(n) for b in range(a)) >= code.shape[1] // 5
        assert (code == language.codewords(n)).all()
    assert language.codewords(1).shape == (1, 0)


def brute_grams(text):
    """Bucket counts from single stretches, hashed one by one."""
    words = regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())
    line = f" {' '.join(words)} " if words else ""
    mix, full = int(language.MIX), (1 << 64) - 1
    found = Counter()
    for start in range(len(line)):
        h = 0
        for n in range(1, min(language.LONGEST, len(line) - start) + 1):
            h = ((h ^ (ord(line[start + n - 1]) + 1)) * mix) & full
            h ^= h >> 29
            if n > 1 or line[start] != " ":
                found[(h * mix & full) >> (64 - 15)] += 1
    return found


def test_grams_equal_single_stretches(monkeypatch):
    for text in ("Der Himmel", "a", "été, où? 12 ½", "नमस्ते दुनिया", "x" * 500, "ab cd " * 100):
        line = language.letters_of(text)
        expected = brute_grams(text)
        for part in (7, 64, 1 << 18):
            monkeypatch.setattr(language, "PART", part)
            counts = language.grams(line)
            assert {int(b): int(counts[b]) for b in np.flatnonzero(counts)} == expected


def test_counts_are_those_of_the_sample(spark, docs):
    sample = language._sample(docs, 4, 2, 40, "doc_id", "text", "lang")
    rows = sample.collect()
    known = [(r["doc_id"], r["lang"]) for r in docs.collect() if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    assert Counter(r["lang"] for r in rows) == {lang: min(40, n) for lang, n in Counter(lang for _, lang in known).items()}
    languages = sorted({r["lang"] for r in rows})
    counts = language._counted(sample, languages)
    for k, lang in enumerate(languages):
        expected = sum((brute_grams(r["text"] or "") for r in rows if r["lang"] == lang and not r["checked"]), Counter())
        assert {int(b): int(counts[k, b]) for b in np.flatnonzero(counts[k])} == expected


def test_scores_equal_a_plain_version(docs, model):
    rows = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    for r in docs.limit(40).collect():
        counts = brute_grams(r["text"] or "")
        if not counts:
            assert (rows[r["doc_id"]]["lang_pred"], rows[r["doc_id"]]["score"]) == ("und", 0.0)
            continue
        total = sum(counts.values()) + language.DOUBT
        margins = [
            sum(n * model.odds[b, place] for b, n in counts.items()) / total * model.scale[place] + model.offset[place]
            for place in range(model.code.shape[1])
        ]
        losses = [sum(w * math.log1p(math.exp(-c * m)) for w, c, m in zip(model.weight, word, margins, strict=True)) for word in model.code]
        best = min(range(len(losses)), key=lambda k: (losses[k], k))
        assert rows[r["doc_id"]]["lang_pred"] == model.languages[best]
        share = math.exp(-losses[best]) / sum(math.exp(-x) for x in losses)
        assert rows[r["doc_id"]]["score"] == pytest.approx(share, abs=1e-9)
        assert rows[r["doc_id"]]["ambiguous"] == (share < language.SURE)


def test_held_out_accuracy(docs, model):
    rows = [r for r in language.predict(docs, model).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["lang"] is not None]
    assert rows and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)


def test_many_languages(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    alphabets = [[chr(c) for c in rng.choice(np.arange(0x61, 0x7B), 9, replace=False)] for _ in range(12)]
    rows = []
    for k, letters in enumerate(alphabets):
        for i in range(60):
            rows.append((k * 100 + i, " ".join("".join(rng.choice(letters, 5)) for _ in range(30)), f"l{k:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.train(docs)
    assert model.code.shape[0] == 12 and model.code.shape[1] > 40
    found = language.predict(docs, model).collect()
    right = [r["lang_pred"] == r["lang"] for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert sum(right) >= 0.95 * len(right)
    mixed = model.predict(rows[0][1] + " " + rows[70][1])
    assert mixed[1] < model.predict(rows[0][1])[1]


def test_awkward_rows(spark, model):
    texts = [(1, None), (2, ""), (3, "123 !? ²½ \n"), (4, "é"), (None, "der die das und nicht"), (5, "the cat " * 60_000), (5, "the cat " * 60_000)]
    df = spark.createDataFrame([(i, t, 9, "x") for i, t in texts], "doc_id long, text string, score int, `a.b` string").repartition(2)
    found = language.predict(df, model)
    assert found.columns == ["doc_id", "text", "a.b", "lang_pred", "score", "runner_up", "ambiguous"]
    rows = sorted(map(tuple, found.drop("text").collect()), key=repr)
    assert len(rows) == len(texts)
    by_id = {r[0]: r for r in rows}
    assert all(by_id[i][2:] == ("und", 0.0, None, False) for i in (1, 2, 3))
    assert by_id[4][2] in model.languages and by_id[None][2] == "de" and by_id[5][2] == "en"
    assert sum(r[0] == 5 for r in rows) == 2
    assert language.predict(df.limit(0), model).count() == 0
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    none = language.train(nothing)
    assert {r["lang_pred"] for r in language.predict(df, none).collect()} == {"und"}
    one = language.train(spark.createDataFrame([(1, "abc", "zz"), (2, "abd", "zz"), (3, None, "zz"), (None, "q", "yy"), (6, "q", None)], "doc_id long, text string, lang string"))
    assert {(r["lang_pred"], r["score"]) for r in language.predict(df, one).filter("doc_id > 3").collect()} == {("zz", 1.0)}
    lone = language.train(spark.createDataFrame([(1, "abc", "zz"), (4, "xyw", "yy")], "doc_id long, text string, lang string"))
    assert lone.languages == ["yy", "zz"] and lone.predict("abc abc")[0] == "zz"
