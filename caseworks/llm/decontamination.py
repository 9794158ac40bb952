"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

Texts become lower-case tokens of letters and digits. A seed is a hash of five
tokens at fixed places of a short span; the places between may differ. Both masks
together find every aligned stretch of ``WINDOW`` = 15 tokens in which at most 3
differ, wherever they lie (shown by enumeration in the tests); 12 of 15 is a
similarity of 0.8.

**Short items.** An item of 7 to 14 tokens may differ in one token, from 10 on in two. It is cut into one part more than that, and
the first three tokens of each part are a seed: one part is whole. An item of fewer tokens is one seed, the whole run, if it has at least
``LEAST_CHARS`` letters and digits; shorter ones can't be told from ordinary phrases and are not looked for.
Documents get these seeds only if there are such items.

**Join.** Documents are cut into chunks of ``CHUNK`` tokens, with as many tokens on either side as a stretch that a seed of the chunk lies in
can reach, so a text of any length takes time in proportion to it. Seeds of the items are joined with the seeds at all places of all
chunks. Items are taken in blocks of bounded size: each block is broadcast,
and all rows are held against it, so any number of items works and no document is
shuffled. A seed carries its item's number and the tokens around it that a stretch can reach, not the whole item. A seed that several items share is one row with the list of its places.

**Verification.** A hit fixes the alignment of item and document. The hashes of
the item's tokens around the seed are compared place by place with the document's tokens they are
aligned with, and the best stretch of ``WINDOW`` tokens (the whole item if it is
shorter) counts. A stretch with ``similarity`` or more equal tokens is an overlap.
Only (document, item, equal, length) goes on to the aggregate.

Null and empty texts have no overlap. Documents are told apart by id and text: rows equal in both
are one document, whose overlaps come once. Null ids are kept. No items or no
documents give no overlaps; other columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.common import by_shuffle, let, named, private, row_key, same_key

WINDOW = 15
SIMILARITY = 0.8
#: Places of a seed's five tokens; the first is the place of the seed.
MASKS = ((0, 1, 2, 3, 5), (0, 1, 4, 5, 6))
#: Fewest tokens of items with room for differences, tokens of a seed of those below ``WINDOW``, and fewest letters and digits of shorter ones.
SHORTEST, PART, LEAST_CHARS = 7, 3, 16
#: Tokens of a document's chunk, and seeds of one block of items, which bounds what is broadcast (some 350 bytes a seed).
CHUNK, BLOCK_SEEDS = 256, 100_000


def token_hashes(text: Column) -> Column:
    """Hashes of a text's lower-case tokens."""
    return F.transform(_tokens(text), lambda t: F.xxhash64(t))


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seed(tokens: Column, place: Column, number: int, mask: tuple[int, ...]) -> Column:
    """Seed of a mask at a place; null where it reaches beyond the tokens."""
    seed = F.xxhash64(F.lit(number), *[F.get(tokens, place + F.lit(o)) for o in mask])
    return F.when(place + F.lit(mask[-1]) < F.size(tokens), seed)


def _masks(lengths: set[int]) -> dict[int, tuple[int, ...]]:
    """Masks by number that documents need for items of these lengths."""
    found = dict(enumerate(MASKS)) if any(n >= WINDOW for n in lengths) else {}
    if any(SHORTEST <= n < WINDOW for n in lengths):
        found[100] = tuple(range(PART))
    return found | {100 + PART + n: tuple(range(n)) for n in sorted(lengths) if n < SHORTEST}


def hashed_items(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """(item, tokens, n) of the items that are looked for."""
    tokens = _tokens(named(text))
    rows = items.select(named(id_col).alias("item"), tokens.alias("words"))
    known = (F.size("words") >= SHORTEST) | (F.char_length(F.array_join("words", "")) >= LEAST_CHARS)
    return rows.filter(known).select("item", F.transform("words", lambda t: F.xxhash64(t)).alias("tokens")).distinct().withColumn("n", F.size("tokens"))


def item_seeds(hashed: DataFrame, masks: dict[int, tuple[int, ...]], window: int, similarity: float) -> DataFrame:
    """(seed, item, n, from_, at, around): each seed of each item, its place, and the item's tokens around it from place ``from_`` on."""
    tokens, n = F.col("tokens"), F.col("n")

    def entry(place: Column, number: int) -> Column:
        first = F.greatest(place - (window - 1), F.lit(0))
        until = F.least(n, place + masks[number][-1] + window)
        around = F.slice(tokens, first + 1, until - first)
        return F.struct(_seed(tokens, place, number, masks[number]).alias("seed"), first.alias("from_"), place.alias("at"), around.alias("around"))

    def at_places(places: Column, numbers: list[int]) -> Column:
        if not numbers:
            return F.array().cast(NO_ENTRY)
        return F.flatten(F.transform(places, lambda p: F.array(*[entry(p, k) for k in numbers])))

    room = (n - F.ceil(n * F.lit(similarity)) + 1).cast("int")
    starts = F.transform(F.sequence(F.lit(0), room - 1), lambda k: F.floor(k * n / room).cast("int"))
    found = F.when(n >= WINDOW, at_places(F.sequence(F.lit(0), n - 1), [k for k in masks if k < 100]))
    if 100 in masks:
        found = found.when(n >= SHORTEST, at_places(starts, [100]))
    for length in range(1, SHORTEST):
        if 100 + PART + length in masks:
            found = found.when(n == length, at_places(F.array(F.lit(0)), [100 + PART + length]))
    return hashed.select("item", "n", F.inline(found)).filter(F.col("seed").isNotNull())


NO_ENTRY = "array<struct<seed:bigint,from_:int,at:int,around:array<bigint>>>"


def chunks(docs: DataFrame, names: list[str], window: int) -> DataFrame:
    """(names, tokens, lead, core): chunks of the documents' tokens; ``lead`` tokens stand before the ``core`` ones."""
    n = F.size("tokens")
    margin = window - 1

    def chunk(start: Column) -> Column:
        lead = F.least(start, F.lit(margin))
        core = F.least(n - start, F.lit(CHUNK))
        return F.struct(F.slice("tokens", start - lead + 1, lead + core + 6 + margin).alias("tokens"), lead.alias("lead"), core.alias("core"))

    cut = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(CHUNK)), chunk))
    return docs.select(*names, F.inline(cut))


def best_stretch(equal: Column, length: Column) -> Column:
    """(equal, length) of the stretch of ``length`` flags (0/1) with most ones."""

    def count(flags: Column) -> Column:
        start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("i"))

        def step(state: Column, flag: Column) -> Column:
            leaving = F.coalesce(F.when(state["i"] >= length, F.get(flags, state["i"] - length)), F.lit(0))
            now = state["now"] + flag - leaving
            return F.struct(now.alias("now"), F.greatest(state["best"], now).alias("best"), (state["i"] + 1).alias("i"))

        return F.aggregate(flags, start, step)["best"]

    return F.struct(let(equal, count).alias("equal"), length.alias("length"))


def _block_hits(parts: DataFrame, seeds: DataFrame, masks: dict[int, tuple[int, ...]], window: int, names: list[str]) -> DataFrame:
    """Verified alignments of one block of items: the best stretch of each hit."""
    held = seeds.groupBy("seed").agg(F.collect_list(F.struct("item", "n", "from_", "at", "around")).alias("places"))
    at = F.sequence(F.col("lead"), F.col("lead") + F.col("core") - 1)
    marks = F.transform(at, lambda p: F.array(*[_seed(F.col("tokens"), p, k, mask) for k, mask in masks.items()]))
    marked = parts.select(*names, "tokens", "lead", F.posexplode(marks).alias("step", "seeds"))
    seeded = marked.select(*names, "tokens", (F.col("lead") + F.col("step")).alias("place"), F.explode("seeds").alias("seed"))
    hit = seeded.join(F.broadcast(held), "seed").select(*names, F.col("tokens").alias("own"), "place", F.explode("places").alias("hit"))
    first = F.col("place") - F.col("hit.at") + F.col("hit.from_")  # where the first of the tokens around the seed would stand
    flags = F.transform("hit.around", lambda t, i: F.when(first + i >= 0, (F.get("own", first + i) == t).cast("int")).otherwise(0))
    flags = F.transform(flags, lambda f: F.coalesce(f, F.lit(0)))
    scored = hit.select(*names, F.col("hit.item").alias("item"), best_stretch(flags, F.least("hit.n", F.lit(window))).alias("best"))
    return scored.select(*names, "item", "best.equal", "best.length")


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    block: int = BLOCK_SEEDS,
) -> DataFrame:
    """(doc_id, text_hash, item_id, equal, length): documents with a stretch of an item, and the best such stretch.

    ``window`` above 15 with the default masks keeps the guarantee for stretches
    whose differences leave 12 of some 15 tokens equal.
    """
    names = ["doc_id", "text_hash"]
    hashed = docs.select(*row_key(id_col, text, names), token_hashes(named(text)).alias("tokens"))
    looked_for = hashed_items(items, item_id, item_text)
    lengths = {r["n"] for r in looked_for.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()}
    masks = _masks(lengths) or dict(enumerate(MASKS))
    seeds = item_seeds(looked_for, masks, window, similarity)
    blocks = max(1, -(-seeds.count() // block))
    pieces = chunks(hashed, names, window)
    of_block = F.pmod(F.xxhash64("item", "at"), F.lit(blocks))
    parts = [_block_hits(pieces, seeds.filter(of_block == b), masks, window, names) for b in range(blocks)]
    found = reduce(DataFrame.union, parts).filter(F.col("equal") >= F.ceil(F.col("length") * F.lit(similarity)))
    best = found.groupBy(*names, "item").agg(F.max(F.struct("equal", "length")).alias("best"))
    return best.select(*names, F.col("item").alias("item_id"), "best.equal", "best.length")


def contaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(doc_id, text_hash, items): documents with an overlap and the ids of its items in ascending order."""
    pairs = overlaps(docs, items, **how)
    return pairs.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def remove_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that overlap with an item."""
    names = private(docs, "id", "hash")
    found = overlaps(docs, items, id_col=id_col, text=text, **how)
    found = found.select(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).distinct()
    full = docs.withColumns(dict(zip(names, row_key(id_col, text, names), strict=True)))
    return full.join(by_shuffle(found), same_key(full, found, names), "left_anti").drop(*names)
