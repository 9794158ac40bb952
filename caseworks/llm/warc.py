"""WARC archives compressed with Zstandard: one frame per record, a dictionary in front.

**Writing.** Each task writes one archive. It begins with a skippable frame that
holds the dictionary (itself compressed), followed by one frame per record.
Spark's text writer puts the frames into files of the shared store through its
committer; its line separator is an empty skippable frame, which readers of the
format pass over. Frames are bytes, not text; the writer copies them as they are.

**Deduplication.** Of rows with equal payloads of at least ``SMALL`` bytes those
with the largest page_id hold the payload; the others are revisit records with the
length and digest of the payload and the page they refer to. Payloads are compared
by length and SHA-1. Counting goes by digest and salt first, so a payload that a
third of the pages share is spread over many tasks.

**Reading.** The dictionary is loaded from the leading skippable frame, each
record from its own frame: an archive is taken apart by the sizes in its block
headers, and only one record is held decompressed at a time. Version line,
required fields, block length, HTTP length and digest are validated. ``strict`` raises
at the first fault; otherwise a row's ``fault`` names it.

Null payloads count as empty, null addresses leave the field out, characters that
would break a header line are percent-encoded. Rows with the same page_id and
payload are all responses. A null page_id is kept as such, and refers to nothing if
all pages of its payload have none. An empty table gives an archive without
records. Other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseworks.llm.common import named, spread_lookup

SMALL = 1000
DICTIONARY_BYTES = 64 << 10
SAMPLE_PAGES, SAMPLE_CHARS = 256, 16 << 10
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"
FRAME = b"\x28\xb5\x2f\xfd"
#: An empty skippable frame, which happens to be ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")


def train_dictionary(pages: DataFrame, payload: str = "html", size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from a bounded sample: ``SAMPLE_PAGES`` pages by a hash of the payload, ``SAMPLE_CHARS`` of each.

    Too few samples to train on are used as raw content instead.
    """
    import zstandard

    content = F.coalesce(named(payload), F.lit(""))
    ranked = pages.select(F.xxhash64(content).alias("h")).distinct().orderBy("h").limit(SAMPLE_PAGES)
    chosen = pages.select(content.alias("c"), F.xxhash64(content).alias("h")).join(F.broadcast(ranked), "h", "left_semi")
    heads = chosen.groupBy("h").agg(F.min(F.left("c", F.lit(SAMPLE_CHARS))).alias("c")).orderBy("h").collect()
    samples = [r["c"].encode() for r in heads if r["c"]]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _header(lines: list[tuple[str, str]], first: str) -> bytes:
    return "".join([f"{first}\r\n", *(f"{k}: {v}\r\n" for k, v in lines), "\r\n"]).encode()


def _safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f<>]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record, without compression."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    block = _header(http, "HTTP/1.1 200 OK") + (b"" if revisit else payload)
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", _safe(url))] if url is not None else []),
        ("WARC-Payload-Digest", digest),
    ]
    if revisit:
        lines += [("WARC-Profile", PROFILE)]
        lines += [("WARC-Refers-To", f"<urn:page:{refers_to}>")] if refers_to is not None else []
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(lines, "WARC/1.1") + block + b"\r\n\r\n"


def _roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, payload) with the page that holds the same payload in ``holder``; null if it isn't shared."""
    large = F.octet_length("payload") >= SMALL
    keyed = pages.withColumn("digest", F.when(large, F.concat_ws(":", F.octet_length("payload"), F.sha1("payload"))))
    groups = (
        keyed.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .drop("n")
    )
    # small pages have no digest; the key only spreads them
    own = F.coalesce("digest", F.concat_ws(":", F.lit("page"), "page_id"))
    return spread_lookup(keyed.withColumn("digest", own), groups, "digest", "page_id", salts=32)


def write(
    pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "1970-01-01T00:00:00Z", level: int = 3,
) -> None:
    """Write a record per row of ``pages`` to archives under ``path``."""
    dictionary = train_dictionary(pages, payload)
    rows = pages.select(
        named(id_col).cast("long").alias("page_id"), named(url).alias("url"),
        F.coalesce(named(payload), F.lit("")).cast("binary").alias("payload"),
    )
    placed = _roles(rows).select("page_id", "url", "payload", "holder").sortWithinPartitions("page_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
        frames = [DICTIONARY_FRAME + len(packed).to_bytes(4, "little") + packed]
        for batch in batches:
            for at in range(batch.num_rows):
                page, address, content, holder = (batch.column(c)[at].as_py() for c in range(4))
                revisit = holder is not None and page != holder
                frames.append(writer.compress(record(page, address, content, holder, revisit, date)))
                if at % 256 == 255:
                    yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
                    frames = []
            if frames:
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
            frames = []

    frames = placed.mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def frames(archive: bytes) -> Iterator[tuple[int, int]]:
    """Start and end of each frame of an archive, skippable ones included."""
    import zstandard

    at, view = 0, memoryview(archive)
    while at < len(archive):
        start, magic = at, bytes(view[at : at + 4])
        if magic[1:] == DICTIONARY_FRAME[1:] and magic[0] >> 4 == 5:
            at += 8 + int.from_bytes(view[at + 4 : at + 8], "little")
        elif magic == FRAME:
            head = view[at : at + 18]
            checked = zstandard.get_frame_parameters(head).has_checksum
            at += zstandard.frame_header_size(head)
            last = False
            while not last and at < len(archive):
                block = int.from_bytes(view[at : at + 3], "little")
                last = bool(block & 1)
                at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            at += 4 * checked
        else:
            raise ValueError(f"no frame at byte {at}")
        if at > len(archive):
            raise ValueError(f"the frame at byte {start} is cut short")
        yield start, at


def parse(data: bytes) -> dict:
    """Fields of one record, validated; ``fault`` is None or names the first thing wrong."""
    out: dict = dict.fromkeys(("page_id", "record_type", "url", "payload", "payload_bytes", "payload_digest", "refers_to"))
    out["fault"] = None
    head, blank, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines if ": " in x)

    def page(value: str | None) -> int | None:
        number = re.fullmatch(r"<urn:page:(-?[0-9]+)>", value or "")
        return int(number[1]) if number else None

    if first != "WARC/1.1" or not blank:
        return out | {"fault": "version line"}
    if missing := [k for k in REQUIRED if k not in fields]:
        return out | {"fault": f"no {missing[0]}"}
    kind = fields["WARC-Type"]
    out |= {"page_id": page(fields["WARC-Record-ID"]), "record_type": kind, "url": fields.get("WARC-Target-URI")}
    out["refers_to"] = page(fields.get("WARC-Refers-To"))
    if not fields["Content-Length"].isdigit() or len(rest) != int(fields["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"fault": "block length"}
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: ([0-9]+)(?=\r\n|$)", http)
    if not blank or not length:
        return out | {"fault": "HTTP header"}
    digest = fields.get("WARC-Payload-Digest", "")
    try:
        out["payload_digest"] = base64.b32decode(digest.removeprefix("sha1:")).hex()
    except ValueError:
        return out | {"fault": "digest"}
    out["payload_bytes"] = int(length[1])
    if kind == "revisit":
        return out | ({"fault": "payload in a revisit"} if payload else {})
    if len(payload) != out["payload_bytes"]:
        return out | {"fault": "payload length"}
    if hashlib.sha1(payload).hexdigest() != out["payload_digest"]:
        return out | {"fault": "digest"}
    return out | {"payload": payload}


def records(archive: bytes) -> Iterator[dict]:
    """Records of one archive."""
    import zstandard

    known = None
    for number, (start, end) in enumerate(frames(archive)):
        if archive[start : start + 4] == DICTIONARY_FRAME:
            if number:
                raise ValueError("a dictionary that does not lead the archive")
            content = archive[start + 8 : end]
            if content[:4] == FRAME:
                content = zstandard.ZstdDecompressor().decompress(content)
            known = zstandard.ZstdCompressionDict(content) if content else None
        elif archive[start : start + 4] == FRAME:
            reader = zstandard.ZstdDecompressor(dict_data=known)
            yield parse(reader.decompress(archive[start:end]))


def read(spark: SparkSession, path: str, payloads: bool = True, strict: bool = True) -> DataFrame:
    """Records of the archives under ``path``."""
    schema = T.StructType(
        [
            T.StructField("page_id", T.LongType()),
            T.StructField("record_type", T.StringType()),
            T.StructField("url", T.StringType()),
            *([T.StructField("payload", T.BinaryType())] if payloads else []),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("payload_digest", T.StringType()),
            T.StructField("refers_to", T.LongType()),
            T.StructField("fault", T.StringType()),
        ]
    )
    kinds = {"LongType": pa.int64(), "StringType": pa.string(), "BinaryType": pa.binary()}
    arrow = pa.schema([(f.name, kinds[type(f.dataType).__name__]) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                found, size = [], 0
                for one in records(batch.column(0)[at].as_py() or b""):
                    if strict and one["fault"]:
                        raise ValueError(f"record of page {one['page_id']}: {one['fault']}")
                    found.append({k: one[k] for k in arrow.names})
                    size += one["payload_bytes"] or 0
                    if size > 16 << 20 or len(found) == 4096:
                        yield pa.RecordBatch.from_pylist(found, arrow)
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.filter("length > 0").select("content").mapInArrow(run, schema)
