"""WARC: archives written with segmented, chunk-framed records and put together again.

Writing: a response's payload goes into chunked transfer framing; one longer than the segment size becomes a first
record and continuation records that name it as origin (WARC-Segment-Origin-ID, WARC-Segment-Number), the last one
with WARC-Segment-Total-Length.  Of records with equal payloads of at least MIN_REVISIT bytes the one with the largest
id is the response and the others are revisits without a payload.  Every record ends with CR LF CR LF, which is what
Spark's text writer puts after each row, so the files are plain Spark output (gzip over the whole file), each of a
bounded number of records.

Reading: files are parsed by Content-Length, continuation records are grouped by origin, ordered by number and verified
against the total length; only segmented records are shuffled.  Truncated, missing or inconsistent segments give a row
with a reason in `problem` and a null payload, never a wrong payload.

A null payload is an empty one.  Every row is a record of its own, with a record id of its page id and a number of its row:
repeated rows are as many records (of equal ones with the largest id all are responses), and a null id stays null; it is
smaller than any other.  A payload of any length is cut into segments.  Other columns are ignored.  An empty table gives
an empty archive and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import released, scratch_path, small_batches, stored

MIN_REVISIT, SEGMENT, CHUNK, RECORDS_PER_FILE = 1000, 32 * 1024, 4096, 4000
#: Digests that are told to all tasks at most, and into how many groups one is split beyond.
BROADCAST_ROWS, SALTS = 1_000_000, 64
RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("origin_id", T.StringType()),
        T.StructField("segment", T.LongType()),
        T.StructField("total_length", T.LongType()),
        T.StructField("block", T.BinaryType()),
        T.StructField("problem", T.StringType()),
    ]
)


def revisit_plan(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """id, uri, payload -> also payload_bytes, payload_digest, `revisits` and refers_to (the response's id, of a revisit)."""
    sized = pages.select("id", "uri", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), F.sha2("payload", 256).alias("_same"))
    # Digests that occur again; payloads meet them by a broadcast where they are few, else in salted groups.
    light = pages.select("id", F.octet_length("payload").alias("n"), F.sha2("payload", 256).alias("_key")).filter(F.col("n") >= min_bytes)
    groups = stored(light.groupBy("_key").agg(F.max("id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select("_key", "_first"), "payloads")
    if groups.count() <= BROADCAST_ROWS:
        joined = sized.join(F.broadcast(groups), F.col("_same") == F.col("_key"), "left")
    else:
        spread = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = sized.withColumn("_own", F.pmod(F.xxhash64("id", "uri"), F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, (F.col("_same") == F.col("_key")) & (F.col("_own") == F.col("_salt")), "left")
    revisits = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("id"))
    return joined.select("id", "uri", "payload", "payload_bytes", "payload_digest", revisits.alias("revisits"), F.when(revisits, F.col("_first")).alias("refers_to"), F.monotonically_increasing_id().alias("row"))


def _chunked(payload: bytes) -> bytes:
    out = []
    for at in range(0, len(payload), CHUNK):
        piece = payload[at : at + CHUNK]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def _unchunked(block: bytes) -> bytes | None:
    """The payload, or None where the framing is broken."""
    out, at = [], 0
    while True:
        end = block.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            n = int(block[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if n == 0:
            return b"".join(out)
        if block[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(block[at : at + n])
        at += n + 2


def _header(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def _uri(text: str | None) -> str | None:
    return None if text is None else "".join(c if c > " " else "%%%02X" % ord(c) for c in text)


def _record_id(page_id, row) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{row}>"


def page_id(record_id: F.Column) -> F.Column:
    """The page id in a record's id, or null."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]*)[:>]", 1).try_cast("long")


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x in batch.to_pylist():
            own = _record_id(x["id"], x["row"])
            fields = [("WARC-Record-ID", own), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", _uri(x["uri"])), ("WARC-Payload-Digest", "sha1:" + x["payload_digest"])]
            if x["revisits"]:
                more = [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{x['refers_to']}>"), ("X-Payload-Length", x["payload_bytes"]), ("Content-Length", 0)]
                out.append(_header(more + fields))
                continue
            block = HTTP + _chunked(x["payload"] or b"")
            if len(block) <= SEGMENT:
                out.append(_header([("WARC-Type", "response"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)), *fields]) + block)
                continue
            starts = range(0, len(block), SEGMENT)
            for k, at in enumerate(starts, 1):
                piece = block[at : at + SEGMENT]
                last = ("WARC-Segment-Total-Length", len(block) if k == len(starts) else None)
                if k == 1:
                    head = [("WARC-Type", "response"), ("Content-Type", "application/http;msgtype=response"), *fields]
                else:
                    head = [("WARC-Type", "continuation"), ("WARC-Record-ID", _record_id(x["id"], f"{x['row']}:{k}")), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", own)]
                out.append(_header([*head, ("WARC-Segment-Number", k), last, ("Content-Length", len(piece))]) + piece)
        for at in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(out[at : at + 256], pa.binary())], names=["value"])


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT) -> None:
    """id, uri, payload (binary) -> WARC files under path, by Spark's own writer and commit protocol."""
    small_batches(pages.sparkSession, 256)
    records = revisit_plan(pages, min_bytes).mapInArrow(_write, "value binary")
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _records(data: bytes) -> Iterator[dict]:
    at, size = 0, len(data)
    while at < size:
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/1.", at) or end < 0:
            yield {"problem": "no record header"}
            return
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode("ascii", "replace")] = v.strip().decode("utf-8", "replace")
        length = int(head["content-length"]) if head.get("content-length", "").isdigit() else -1
        block = data[end + 4 : end + 4 + length] if length >= 0 else b""
        number = lambda k: int(head[k]) if head.get(k, "").isdigit() else None  # noqa: E731, B023
        yield {
            "record_id": head.get("warc-record-id"),
            "record_type": head.get("warc-type"),
            "uri": head.get("warc-target-uri"),
            "payload_digest": (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
            "refers_to": head.get("warc-refers-to"),
            "origin_id": head.get("warc-segment-origin-id"),
            "segment": number("warc-segment-number"),
            "total_length": number("warc-segment-total-length") if head.get("warc-type") != "revisit" else number("x-payload-length"),
            "block": block,
            "problem": "truncated record" if length < 0 or len(block) != length else None,
        }
        if length < 0 or len(block) != length:
            return
        at = end + 4 + length + 4


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"segment": pa.int64(), "total_length": pa.int64(), "block": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], kinds.get(f.name, pa.string())) for f in RECORD], names=[f.name for f in RECORD])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            data = batch.column(0)[k].as_py()
            if data[:2] == b"\x1f\x8b":
                data = b"".join(_members(data))
            rows, held = [], 0
            for r in _records(data):
                rows.append(r)
                held += len(r.get("block") or b"")
                if held > 4 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)


def _members(data: bytes) -> Iterator[bytes]:
    while data:
        one = zlib.decompressobj(31)
        yield one.decompress(data)
        data = one.unused_data


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records under path (plain or gzip, one or several members), one row each."""
    small_batches(spark, 1)  # a file at a time
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, RECORD)


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        rows = batch.to_pylist()
        out = []
        for r in rows:
            why, payload = r["problem"], None
            if why is None and r["record_type"] == "response":
                head, _, body = (r["block"] or b"").partition(b"\r\n\r\n")
                payload = _unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                if payload is None:
                    why = "broken transfer framing"
                elif r["payload_digest"] and hashlib.sha1(payload).hexdigest() != r["payload_digest"]:
                    why, payload = "payload differs from its digest", None
            out.append((r["record_id"], r["record_type"], r["uri"], r["payload_digest"], r["refers_to"], None if payload is None and r["record_type"] != "revisit" else len(payload) if payload is not None else r["total_length"], payload, why))
        kinds = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=PAYLOAD.names)


PAYLOAD = T.StructType([*RECORD.fields[:5], T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType()), T.StructField("problem", T.StringType())])


def reassemble(records: DataFrame) -> DataFrame:
    """Records -> one row per response or revisit, with the decoded payload, or null and a `problem`."""
    names = RECORD.names
    # A scan of the archive for each kind keeps records that are whole away from the shuffle.
    whole = records.filter("segment is null")
    parts = records.filter("segment is not null").withColumn("_origin", F.coalesce("origin_id", "record_id"))
    gathered = parts.groupBy("_origin").agg(F.array_sort(F.collect_list(F.struct("segment", *[n for n in names if n not in ("segment", "origin_id")]))).alias("p"))
    numbers = F.expr("transform(p, x -> x.segment)")
    total = F.expr("element_at(p, -1).total_length")
    length = F.expr("aggregate(p, 0L, (a, x) -> a + coalesce(octet_length(x.block), 0))")
    why = (
        F.when(F.expr("exists(p, x -> x.problem is not null)"), "truncated record")
        .when(numbers != F.sequence(F.lit(1).cast("long"), F.size("p").cast("long")), "missing or repeated segment")
        .when(total.isNull(), "no total length")
        .when(total != length, "total length differs")
    )
    first = lambda n: F.expr(f"p[0].{n}")
    joined = gathered.select(
        F.col("_origin").alias("record_id"), F.coalesce(F.when(numbers[0] == 1, first("record_type")), F.lit("response")).alias("record_type"), *[first(n).alias(n) for n in ("uri", "payload_digest", "refers_to")],
        F.lit(None).cast("string").alias("origin_id"), F.lit(None).cast("long").alias("segment"), total.alias("total_length"),
        F.when(why.isNull(), F.expr("aggregate(p, X'', (a, x) -> a || x.block)")).alias("block"), why.alias("problem"),
    )
    small_batches(records.sparkSession, 256)
    return whole.unionByName(joined).mapInArrow(_payload, PAYLOAD)


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """pages (id, uri, payload) written to an archive and read back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(pages, path, min_bytes)
    return reassemble(read_warc(spark, path))
