"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes cuts a text's UTF-8 bytes; normalised chunking asks for more zero bits before the
usual length and fewer after it, so lengths gather around it.  A fingerprint is the set of chunk digests, each with its
length; an insertion moves only the cuts near it.  likeness() is the share of a text's chunk bytes (each distinct
chunk once) that the other text has too: 1 for equal texts, 0 for texts without a common chunk.

A null text is an empty one; an empty text has the empty fingerprint, is like an empty one (1) and unlike any other (0).
Equal texts have equal fingerprints, wherever they stand.  A table of one row is its own next document; repeated ids follow each
other in the order of their texts, null ids come last.  Very long texts are hashed in blocks, with the same cuts as at once.
Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import partitions, small_batches

LEAST, USUAL, MOST = 32, 96, 512
HARD, EASY = np.uint32(0xFE000000), np.uint32(0xF8000000)  # 7 and 5 zero bits
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
BLOCK = 4 << 20


def cut_points(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which the gear hash has enough zero bits: for the hard mask, and for the easy one."""
    hard, easy = [], []
    for low in range(0, len(data), BLOCK):
        begin = max(0, low - 31)
        h = GEAR[np.frombuffer(data, np.uint8, min(len(data), low + BLOCK) - begin, begin)]
        for k in (1, 2, 4, 8, 16):  # h[i] becomes the sum of the last 2k bytes' gears, shifted by their distance
            h[k:] += h[:-k] << np.uint32(k)  # the right side is made before it is added
        at = np.flatnonzero((h & EASY) == 0)
        at = at[at >= low - begin]
        easy.append(at + begin + 1)
        hard.append(at[(h[at] & HARD) == 0] + begin + 1)
    return (np.concatenate(hard), np.concatenate(easy)) if hard else (np.zeros(0, int), np.zeros(0, int))


def chunk_set(text: str) -> dict[bytes, int]:
    """digest -> length of the distinct chunks of a text, in the order they first occur."""
    import xxhash

    data, found = text.encode("utf-8", "surrogatepass"), {}
    size = len(data)
    digest = xxhash.xxh3_64_digest
    if size <= LEAST:
        return {digest(data): size} if size else {}
    hard, easy = (x.tolist() for x in cut_points(data))
    n_hard, n_easy = len(hard), len(easy)
    at = i = j = 0
    while size - at > LEAST:
        # before the usual length by the hard mask, after it by the easy one
        low, mid, high = at + LEAST, at + USUAL, min(size, at + MOST)
        while i < n_hard and hard[i] < low:
            i += 1
        if i < n_hard and hard[i] <= mid:
            end = min(hard[i], high)
        else:
            while j < n_easy and easy[j] <= mid:
                j += 1
            end = easy[j] if j < n_easy and easy[j] <= high else high
        piece = data[at:end]
        found[digest(piece)] = end - at
        at = end
    if at < size:
        found[digest(data[at:])] = size - at
    return found


def fingerprint(chunks: dict[bytes, int]) -> str:
    """The set as text: digest and length in hexadecimal, in digest order."""
    return " ".join(f"{d.hex()}{n:x}" for d, n in sorted(chunks.items()))


def parse(text: str) -> dict[bytes, int]:
    return {bytes.fromhex(x[:16]): int(x[16:], 16) for x in text.split()}


def likeness(own: dict[bytes, int], other: dict[bytes, int]) -> float:
    """The share of own's chunk bytes that other has."""
    if not own:
        return 0.0 if other else 1.0
    total = sum(own.values())
    shared = own.keys() & other.keys()
    return 1.0 if len(shared) == len(own) else sum(own[d] for d in shared) / total


def edited(text: str, following: str) -> str:
    """text with its last floor(n/2) code points replaced by the first as many of the following text (or all)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("doc_id", "n_chars")),
        *(T.StructField(n, T.StringType()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        *(T.StructField(n, T.DoubleType()) for n in ("near_edited", "near_next")),
    ]
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range and id, each range closed by the next range's first document: a row comes out when its follower comes in."""
    held, out, size = None, [], 0
    for batch in batches:
        for rng, doc, closing, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = (rng, doc, text, chunk_set(text))
            if held is not None and held[0] == rng:
                _, own, this, chunks = held
                new = edited(this, text)
                other = chunks if new == this else chunk_set(new)
                out.append((own, len(this), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(chunks), fingerprint(other), likeness(chunks, other), likeness(chunks, row[3])))
                size += len(this)
            held = None if closing else row
            if size > 1 << 20:
                yield _batch(out)
                out, size = [], 0
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=RESULT.names)


#: Most ranges: the plan carries their bounds, and the driver one row for each.
MOST_RANGES = 20_000


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text -> RESULT: every document against its edited text and against the next one by id.

    Ids are cut into ranges at quantiles; texts are shuffled once, by range.  The first document of each range is
    sent a second time, to close the range before it (of the first range, the last): one more row for each range.
    Documents of equal ids are taken in the order of their texts.  Null ids come last, as one more id.
    """
    spark = docs.sparkSession
    small_batches(spark, 256)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = partitions(spark)
    n = min(4 * parts, MOST_RANGES)
    found = docs.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 100 * n).alias("q")).first()["q"]
    cuts = sorted(set(found or []))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.lit(None).cast("array<long>")
    steps = [1 << k for k in reversed(range(max(1, len(cuts).bit_length())))]
    # The number of bounds at or below the id, by binary search.
    inside = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when(F.get(bounds, low + s - 1) <= F.col("doc_id"), low + s).otherwise(low))
    ranged = docs.withColumn("rng", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(inside))
    heads = ranged.groupBy("rng").agg(F.min("doc_id").alias("head")).orderBy("rng").collect()  # one row for each range
    if not heads:
        return spark.createDataFrame([], RESULT)
    before = [(r["rng"], r["head"], heads[k - 1]["rng"]) for k, r in enumerate(heads)]  # before the first one comes the last
    firsts = F.broadcast(spark.createDataFrame(before, "h_rng int, head long, closes int"))
    sent = ranged.join(firsts, (F.col("rng") == F.col("h_rng")) & F.col("doc_id").eqNullSafe(F.col("head")), "left").select(
        F.explode(F.when(F.col("h_rng").isNull(), F.array(F.struct(F.col("rng").alias("rng"), F.lit(False).alias("closing")))).otherwise(F.array(F.struct(F.col("rng").alias("rng"), F.lit(False).alias("closing")), F.struct(F.col("closes").alias("rng"), F.lit(True).alias("closing"))))).alias("to"), "doc_id", "text"
    )
    sent = sent.select("to.rng", "doc_id", "to.closing", "text")
    placed = sent.repartitionById(parts, F.floor(F.col("rng") * parts / (len(cuts) + 2)).cast("int"))
    return placed.sortWithinPartitions("rng", "closing", F.col("doc_id").asc_nulls_last(), "text").mapInArrow(_pairs, RESULT)
