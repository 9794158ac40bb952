"""Near-duplicates by the Jaccard similarity of their shingle sets, found twice and checked exactly.

Two texts link if their sets of ``SHINGLE``-word shingles (compared by XXH64) have a
Jaccard similarity of at least ``SIMILAR``. Texts with equal sets are one node.

**Candidates.** SimHash fingerprints within two bits (see ``simhash``; the first text of each
fingerprint) give those with next to no change. Edited copies lie further apart than segments of a fingerprint can
reach at scale, so MinHash gives the others: of ``BANDS`` bands of ``ROWS`` least hashes
two texts share one or more, but for (1 - s ** ROWS) ** BANDS of the pairs of similarity
s, which is 7 in a million at 0.8 and less above.

**Stars.** A text weighs what its bands' buckets hold together, so the text nearest to the middle of a family of copies weighs most. In
each bucket every text is checked with the heaviest one. That is one pair for each text and band, whatever the size of the group.

**What stars leave apart.** In a bucket that still holds several components, every text outside the largest one is checked with every text of
another component, so no similar pair that shares a bucket stays apart. Buckets of at most ``SMALL`` texts give pairs. Fuller ones are cut into
blocks of about ``HELD`` hashes; a task counts what a block of texts shares with a block of those outside, exactly and on the sets themselves, and
hands on at most one link of a text for each component. Memory is that of two blocks whatever the size of the bucket, and no row is made for a pair; the counting
itself takes the square of what a bucket holds outside its largest component.

**Verification.** Each pair of a star or a small bucket is checked once: first by comparing ``BANDS`` x ``ROWS`` least hashes, one byte each, where a similarity of
four standard deviations below ``SIMILAR`` drops it, then exactly on the sets. Only links whose exact similarity suffices count.

Null and empty texts have the empty set and are one node; null ids and repeated rows
are treated as in ``simhash.keep_one``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm import simhash
from caseworks.llm.common import by_shuffle, map_batches, named, private, row_key, spread_lookup, stored
from caseworks.llm.links import components

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 30, 5
#: Hashes mixed at a time; a longer set is mixed in several parts.
PART = 512
#: Hashes of sets in one batch that a task hands on and in a block of a full bucket, and texts sketched together.
HELD, TEXTS = 1 << 18, 1024
#: Texts of a bucket whose components are compared as pairs.
SMALL = 8
#: Least share of equal bytes of two sketches.
LIKELY = SIMILAR - 4 * (SIMILAR * (1 - SIMILAR) / (BANDS * ROWS)) ** 0.5


def mixers():
    """Two columns of constants, one row for each of the ``BANDS`` x ``ROWS`` orders of the hashes."""
    import numpy as np

    rng = np.random.Generator(np.random.PCG64(simhash.SEED))
    flips, factors = rng.integers(0, 1 << 64, (2, BANDS * ROWS, 1), "uint64")
    return flips, factors | np.uint64(1)


def least_hashes(hashes, flips, factors):
    """The least hash of a set in each of the ``BANDS`` x ``ROWS`` orders; None for the empty set."""
    import numpy as np

    if not len(hashes):
        return None
    least = np.full(BANDS * ROWS, np.iinfo("uint64").max, "uint64")
    for at in range(0, len(hashes), PART):
        np.minimum(least, ((hashes[None, at : at + PART] ^ flips) * factors).min(axis=1), out=least)
    return least


def band_keys(least) -> list[int]:
    """Key of each band of least hashes."""
    import numpy as np
    import xxhash

    if least is None:
        return []
    keys = [xxhash.xxh64_intdigest(rows.tobytes(), band) for band, rows in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, "uint64").view("int64").tolist()


def sketches(keyed: DataFrame, text: str = "text") -> DataFrame:
    """``keyed`` without its text, with its set's hash ``fp`` and size ``n``, its fingerprint ``bits``, band keys ``bands`` and a byte of each least hash ``sketch``."""
    kept = [f for f in keyed.schema.fields if f.name != text]
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType([*kept, *[T.StructField(c, t) for c, t in (("fp", long), ("n", long), ("bits", long), ("bands", longs), ("sketch", T.BinaryType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import xxhash

        constants = mixers()
        for batch in _parts(batches):
            names = batch.schema.names
            fp, n, bits, bands, least = [], [], [], [], []
            for value in batch.column(names.index(text)):
                hashes = simhash.shingle_hashes(value.as_py() or "", SHINGLE)
                different = np.unique(hashes)
                fp.append(xxhash.xxh64_intdigest(different.tobytes()))
                n.append(len(different))
                bits.append(simhash.fingerprint_of(hashes))
                least.append(least_hashes(different, *constants))
                bands.append(band_keys(least[-1]))
            columns = [batch.column(names.index(f.name)) for f in kept]
            signed = [pa.array(np.array(v, "uint64").view("int64")) for v in (fp, n, bits)]
            # The middle of a product is mixed best; its lowest bits are those of the hash itself.
            brief = pa.array([None if v is None else (v >> np.uint64(40)).astype("uint8").tobytes() for v in least], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, *signed, pa.array(bands, pa.list_(pa.int64())), brief], names=schema.names)

    return map_batches(keyed, run, schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``TEXTS`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            yield batch.slice(start, TEXTS)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(fp, shingles): the hashes of the different shingles of each ``text``."""
    schema = T.StructType([T.StructField("fp", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            start, held, sets = 0, 0, []
            for row in range(batch.num_rows):
                sets.append(np.unique(simhash.shingle_hashes(batch.column(1)[row].as_py() or "", SHINGLE)).view("int64"))
                held += len(sets[-1])
                if held >= HELD or row + 1 == batch.num_rows:
                    offsets = np.cumsum([0, *map(len, sets)]).astype("int32")
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(sets)), pa.ListArray.from_arrays(offsets, np.concatenate(sets))], names=schema.names)
                    start, held, sets = row + 1, 0, []

    return map_batches(texts.select("fp", "text"), run, schema)


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the different ``pairs`` (a, b) whose sketches don't rule out that they are similar."""
    brief = nodes.select("fp", "sketch")
    both = spread_lookup(spread_lookup(pairs, brief.toDF("a", "s"), "a", "b"), brief.toDF("b", "t"), "b", "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "uint8").reshape(-1, BANDS * ROWS) for k in (2, 3))
            share = ((s == t).mean(1) - 1 / 256) / (1 - 1 / 256)
            yield batch.select(["a", "b"]).filter(pa.array(share >= LIKELY))

    # Empty sets have no sketch and are one node, so they are in no pair.
    held = both.filter(F.col("s").isNotNull() & F.col("t").isNotNull()).select("a", "b", "s", "t")
    return held.mapInArrow(run, "a long, b long")


def _similar(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose ``sets`` are similar enough, counted exactly."""
    different = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    likely = stored(_likely(different, nodes), "likely")
    both = spread_lookup(spread_lookup(likely, sets.toDF("a", "s"), "a", "b"), sets.toDF("b", "t"), "b", "a")
    shared = F.size(F.array_intersect("s", "t"))
    return both.filter(shared >= F.lit(SIMILAR) * (F.size("s") + F.size("t") - shared)).select("a", "b")


def _may_be(n: str, m: str):
    """Whether sets of these sizes can be similar enough."""
    return F.least(n, m) >= F.lit(SIMILAR) * F.greatest(n, m)


def _led(members: DataFrame, *facts: str) -> DataFrame:
    """``members`` (key, fp, weight, ...) with the ``facts`` of their bucket's heaviest text as lead_fp, ... (ties to the smaller fp)."""
    best = members.groupBy("key").agg(F.max_by(F.struct(*facts), F.struct("weight", -F.col("fp").cast("decimal(20,0)"))).alias("lead"))
    leads = best.select("key", *[F.col(f"lead.{c}").alias(f"lead_{c}") for c in facts])
    return spread_lookup(members, leads, "key", "fp")


def _mixed(members: DataFrame) -> DataFrame:
    """Those of ``members`` (key, fp, root, ...) in buckets of several components, with the largest one's root ``main`` and the number ``held``."""
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("size").alias("held"))
    mixed = mixed.filter(F.col("parts") > 1).select("key", F.col("main.root").alias("main"), "held")
    return spread_lookup(members, mixed, "key", "fp").filter(F.col("main").isNotNull())


def _across(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of ``rows`` (key, fp, n, root, main): each outside its bucket's largest component with one similar text of every other component that has any."""
    apart = F.col("root") != F.col("main")
    cells = F.sum("n").alias("x_parts"), F.sum(F.when(apart, F.col("n")).otherwise(0)).alias("y_parts")
    parts = rows.groupBy("key").agg(*cells).select("key", *[F.ceil(F.col(c) / HELD).alias(c) for c in ("x_parts", "y_parts")])
    dealt = spread_lookup(rows, parts, "key", "fp").join(by_shuffle(sets), "fp")

    def side(rows: DataFrame, own: str, other: str) -> DataFrame:
        """``rows`` in their own block of one side, once for each block of the other one."""
        block = F.pmod(F.xxhash64("fp"), F.col(f"{own}_parts")).alias(own)
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_parts") - 1)).alias(other)
        return rows.select("key", block, each, F.lit(own == "y").alias("apart"), "fp", "root", "shingles").select("key", "x", "y", "apart", "fp", "root", "shingles")

    blocks = side(dealt, "x", "y").union(side(dealt.filter(apart), "y", "x"))
    return blocks.groupBy("key", "x", "y").applyInArrow(_block_links, "a long, b long")


def _block_links(group: pa.Table) -> pa.Table:
    """Similar texts (a, b) of different components in one block of a bucket: each of those ``apart`` with one text of each component."""
    import numpy as np

    apart, fp, root = (group.column(c).to_numpy() for c in ("apart", "fp", "root"))
    lists = group.column("shingles").combine_chunks()
    lengths = lists.value_lengths().to_numpy()
    different, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    ends = np.cumsum(lengths)
    to, sizes = np.flatnonzero(~apart), lengths[~apart]
    flat, starts = place[np.repeat(~apart, lengths)], np.cumsum(sizes) - sizes
    held = np.zeros(len(different), "uint8")
    a, b = [np.empty(0, "int64")], [np.empty(0, "int64")]
    for row in np.flatnonzero(apart) if len(to) else ():
        own = place[ends[row] - lengths[row] : ends[row]]
        held[own] = 1
        shared = np.add.reduceat(held[flat], starts, dtype="int64")
        held[own] = 0
        near = to[(shared >= SIMILAR * (sizes + lengths[row] - shared)) & (root[to] != root[row])]
        _, first = np.unique(root[near], return_index=True)
        a.append(np.full(len(first), fp[row]))
        b.append(fp[near[first]])
    return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})


def _within_small(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``rows`` (key, fp, n, root, main) in buckets of at most ``SMALL``: each outside the largest component with all of other components."""
    member = F.struct("fp", "n", "root")
    gathered = rows.groupBy("key").agg(F.collect_list(member).alias("all"), F.first("main").alias("main"))
    one = gathered.select("all", F.inline(F.filter("all", lambda m: m["root"] != F.col("main"))))
    other = one.select("fp", "n", "root", F.explode("all").alias("m")).filter(F.col("m.root") != F.col("root"))
    return other.filter(F.least("n", "m.n") >= F.lit(SIMILAR) * F.greatest("n", "m.n")).select(F.col("fp").alias("a"), F.col("m.fp").alias("b"))


def links(nodes: DataFrame, texts: DataFrame, thorough: bool = False) -> DataFrame:
    """Links (a, b), enough to connect the similar ones of ``nodes`` (fp, first, n, bits, bands, sketch); ``texts`` (id, hash, text) has the first of each.

    ``thorough``: small buckets, too, are compared on the sets alone, without sketches.
    """
    prints = stored(nodes.groupBy("bits").agg(F.min("fp").alias("least")), "fingerprints")
    lead = prints.toDF("a_bits", "a"), prints.toDF("b_bits", "b")
    near = simhash.fingerprint_links(prints.select(F.col("bits").alias("fp"))).toDF("a_bits", "b_bits")
    by_bits = near.join(by_shuffle(lead[0]), "a_bits").join(by_shuffle(lead[1]), "b_bits").select("a", "b")
    by_bits = stored(by_bits.filter(F.col("a") != F.col("b")), "bits")
    filed = nodes.select("fp", "n", F.posexplode("bands").alias("band", "key"))
    sizes = filed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    met = stored(spread_lookup(filed, sizes, "key", "fp").filter(F.col("size").isNotNull()), "filed")
    weights = met.groupBy("fp").agg(F.sum("size").alias("weight"))
    met = stored(met.drop("size").join(by_shuffle(weights), "fp"), "buckets")
    stars = _led(met, "fp", "n").filter((F.col("fp") != F.col("lead_fp")) & _may_be("n", "lead_n"))
    stars = stars.select(F.col("lead_fp").alias("a"), F.col("fp").alias("b"))
    members = weights.select("fp").union(by_bits.select("a")).union(by_bits.select("b")).distinct()
    owners = nodes.join(by_shuffle(members), "fp", "left_semi").select("fp", F.col("first.id").alias("own_id"), F.col("first.hash").alias("own_hash"))
    owned = texts.join(by_shuffle(owners), texts["id"].eqNullSafe(owners["own_id"]) & (texts["hash"] == owners["own_hash"])).dropDuplicates(["fp"])
    sets = stored(shingle_sets(owned), "sets")
    found = stored(_similar(stars.union(by_bits), nodes, sets), "similar")
    roots = components(found)
    marked = met.join(by_shuffle(roots), met["fp"] == roots["node"], "left").select("key", "fp", "n", "band", "weight", F.coalesce("root", "fp").alias("root"))
    open_rows = stored(_mixed(marked), "open")
    open_rows = open_rows.select("key", "fp", "n", "root", "main", "held")
    if thorough:
        return found.union(_across(open_rows, sets))
    few = _similar(_within_small(open_rows.filter(F.col("held") <= SMALL)), nodes, sets)
    return found.union(few).union(_across(open_rows.filter(F.col("held") > SMALL), sets))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", thorough: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null last; then a hash of the text)."""
    key_id, key_text = private(docs, "id", "hash")
    keyed = docs.select(*row_key(id_col, text, [key_id, key_text]), named(text).alias("text"))
    rows = stored(sketches(keyed), "sketches")
    key = F.struct(F.col(key_id).isNull().alias("none"), F.col(key_id).alias("id"), F.col(key_text).alias("hash"))
    sketch = F.struct("n", "bits", "bands", F.col("sketch"))
    nodes = rows.groupBy("fp").agg(F.min(key).alias("first"), F.min(sketch).alias("sketch"))
    nodes = stored(nodes.select("fp", "first", "sketch.*"), "different")
    return simhash.keep_first(docs, nodes.select("fp", "first"), links(nodes, keyed.toDF("id", "hash", "text"), thorough), id_col, text)
