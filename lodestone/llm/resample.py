"""Importance resampling towards a target distribution over a stored sparse matrix of documents by hashed features.

Features are runs of one and of two consecutive words, joined by a space; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo BUCKETS.  Counts are stored as blocks of rows in compressed sparse row form (csr_blocks), each of at most
BLOCK_CELLS cells and one document more, so memory is bounded whatever a task reads; a document has at most BUCKETS cells.
Row groups and Arrow batches hold GROUP_BLOCKS blocks, so what writers and readers hold doesn't grow with the table either.
Column sums of the blocks, added up per task and then by Spark, are the two distributions; the gain of a bucket is the
floored 1000-fold log ratio of its smoothed shares; a matrix-vector product of each block with the gains gives weights.

The CRC of two joined words comes from the words' own: a CRC is linear, so appending n bytes is a product with a matrix
that depends on n, kept as lookups by byte for n up to TABLE_BYTES (longer words are hashed as they are).

drawn() adds the Gumbel term, by a hash of seed and id, and ranks the highest scores: rows are sorted by range over all
tasks, and a row's rank is its place in its range after the sizes of the ranges before, so no task holds a whole order.

Nulls: a null text has no words and weight 0, a null id is hashed as the empty string and comes last in ties.  Equal
scores and ids (repeated rows) get ranks of their own in any order.  An empty table gives no rows; with an empty target
every gain follows from the smoothing alone.  Very long texts are one row of the matrix.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm._common import batches_of, forget, partitions, released, stored

#: Buckets of features, the least words of a document that may be drawn, per cent drawn, and the seed.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7
#: Cells (and 8 a document) after which a block ends, remembered words, and bytes of a word in the lookups.
BLOCK_CELLS, REMEMBERED, TABLE_BYTES = 1 << 18, 1 << 18, 48
#: Texts a batch, and blocks (of some megabytes each) a row group of the stored matrix and a batch that a task reads.
TEXTS, GROUP_BLOCKS = 512, 4

#: Of a text's UTF-8 bytes: A-Z in lower case, ASCII other than letters and digits as spaces.
FOLD = bytes(k + 32 if 65 <= k <= 90 else k if 48 <= k <= 57 or 97 <= k <= 122 or k >= 128 else 32 for k in range(256))


def _bytewise() -> np.ndarray:
    """What a zero byte more makes of each value of a CRC's low byte: the rule of the polynomial 0xEDB88320."""
    v = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        v = np.where(v & 1, (v >> 1) ^ np.uint32(0xEDB88320), v >> 1)
    return v


def _appending() -> np.ndarray:
    """(n, 4, 256): what n zero bytes more make of a CRC whose k-th byte has a value, for n to TABLE_BYTES; bytes are combined by exclusive or."""
    one, out = _bytewise(), [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
    for _ in range(TABLE_BYTES):
        out.append((out[-1] >> np.uint32(8)) ^ one[out[-1] & np.uint32(255)])
    return np.stack(out)


def appended(tables: np.ndarray, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    return tables[n, 0, crc & 255] ^ tables[n, 1, (crc >> 8) & 255] ^ tables[n, 2, (crc >> 16) & 255] ^ tables[n, 3, crc >> 24]


class Hasher:
    """Buckets of all features of a text."""

    def __init__(self):
        self.tables, self.known = _appending(), {}

    def words(self, found: list[bytes]) -> np.ndarray:
        """CRC and length of each word in one number; the words seen last are remembered."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(found).difference(known):
            known[w] = zlib.crc32(w) | min(len(w), TABLE_BYTES + 1) << 32
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def buckets(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of each feature."""
        found = text.encode("utf-8", "surrogatepass").translate(FOLD).split()
        if not found:
            return 0, np.zeros(0, np.int64)
        packed = self.words(found)
        crc, n = (packed & 0xFFFFFFFF).astype(np.uint32), (packed >> 32).astype(np.intp)
        spaced = appended(self.tables, crc[:-1], np.ones(len(crc) - 1, np.intp)) ^ np.uint32(zlib.crc32(b" "))
        pairs = appended(self.tables, spaced, np.minimum(n[1:], TABLE_BYTES)) ^ crc[1:]
        for k in np.flatnonzero(n[1:] > TABLE_BYTES).tolist():
            pairs[k] = zlib.crc32(found[k] + b" " + found[k + 1])
        return len(found), np.concatenate([crc, pairs]).astype(np.int64) % BUCKETS


CSR = "doc_ids array<bigint>, n_words array<bigint>, ends binary, columns binary, counts binary"


def _csr(block_cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, ids, sizes, columns, counts, cells = Hasher(), [], [], [], [], 0

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(c) for c in columns]).astype("<i8")
            made = [pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))]
            made += [pa.array([b], pa.binary()) for b in (ends.tobytes(), np.concatenate(columns).astype("<u2").tobytes(), np.concatenate(counts).astype("<u4").tobytes())]
            return pa.RecordBatch.from_arrays(made, names=["doc_ids", "n_words", "ends", "columns", "counts"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, found = hasher.buckets(text.as_py() or "")
                held = np.bincount(found, minlength=BUCKETS)
                at = np.flatnonzero(held)
                ids.append(doc_id)
                sizes.append(n)
                columns.append(at)
                counts.append(held[at])
                cells += len(at) + 8
                if cells >= block_cells:
                    yield block()
                    ids, sizes, columns, counts, cells = [], [], [], [], 0
        if ids:
            yield block()
        released()

    return run


def csr_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", block_cells: int = BLOCK_CELLS) -> DataFrame:
    """The matrix of docs: a row for each block of documents (little-endian numbers; ends are of the rows' cells)."""
    with batches_of(docs.sparkSession, TEXTS):
        return stored(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(_csr(block_cells), CSR), "csr", GROUP_BLOCKS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            ids, sizes, ends, columns, counts = (batch.column(c)[k].as_py() for c in ("doc_ids", "n_words", "ends", "columns", "counts"))
            yield ids, sizes, np.frombuffer(ends, "<i8"), np.frombuffer(columns, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for _, _, _, columns, counts in _rows(batches):
        np.add.at(total, columns, counts)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
    released()


def column_sums(blocks: DataFrame) -> np.ndarray:
    """Of each bucket; one number for each of BUCKETS buckets comes to the driver, whatever the input's size."""
    out = np.zeros(BUCKETS, np.int64)
    with batches_of(blocks.sparkSession, GROUP_BLOCKS):
        for r in blocks.mapInArrow(_sums, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
            out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    whole, aim = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((float(t) + 1) * whole / ((float(s) + 1) * aim))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(by_bucket: np.ndarray, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, ends, columns, counts in _rows(batches):
            upto = np.concatenate([[0], np.cumsum(counts * by_bucket[columns])])
            seen = np.concatenate([[0], np.cumsum(counts)])
            starts = np.concatenate([[0], ends[:-1]])
            total, n = upto[ends] - upto[starts], seen[ends] - seen[starts]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([_noise(seed, d) for d in ids], np.int64)
            made = [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (sizes, n, weight, score))]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n_words", "n_features", "weight", "score"])
        released()

    return run


def weights(blocks: DataFrame, by_bucket: np.ndarray, seed: int = SEED) -> DataFrame:
    """One row per document, as a stored table: doc_id, n_words, n_features, weight and score."""
    with batches_of(blocks.sparkSession, GROUP_BLOCKS):
        return stored(blocks.mapInArrow(_weigh(by_bucket, seed), "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"), "scored")


def drawn(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """scored (a stored table) with rank: 1, 2, 3... by score for the drawn documents, null for the others."""
    spark = scored.sparkSession
    most = scored.filter(F.col("n_words") >= least_words).count() * percent // 100
    order = [(F.col("n_words") >= least_words).desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ranges = scored.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    # The id counts the rows of a partition from 0 in its low 33 bits, and partitions above; written, so it stays.
    placed = stored(ranges.drop("row").withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each range
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = placed.withColumn("part", part).join(F.broadcast(before), "part")
    return out.select(*scored.columns, F.when((F.col("n_words") >= least_words) & (rank <= most), rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """docs (doc_id, text) weighed towards target (text): doc_id, n_words, n_features, weight, score and rank of every document."""
    blocks = csr_blocks(docs, block_cells=block_cells)
    aimed = csr_blocks(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"))
    by_bucket = gains(column_sums(blocks), column_sums(aimed))
    scored = weights(blocks, by_bucket, seed)
    for held in (blocks, aimed):
        forget(held)
    return drawn(scored, least_words, percent)
