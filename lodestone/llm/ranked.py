"""Ranked lexical search over an impact-ordered index, a score at a time, with whole-number scores.

The corpus is cut into blocks of documents (term_blocks): a block's own dictionary and, term by term, its documents and
counts.  Corpus figures (documents and words with at least one term) are sums over the blocks.  impact_index then orders
every term's postings by their exact impact, highest first: documents of one impact are one segment.  Both are stored
tables of blocks, each of about BLOCK_TERMS words and one document more, with GROUP_BLOCKS of them in a row group and in an
Arrow batch, so the memory of a task, its reader and its writer doesn't grow with the corpus.

A query runs over every block.  In a block each term has a cursor, whose segment promises at most its weight times that
segment's impact.  Rounds take the segments whose promise is at least a part of the highest one and add it to their
documents' sums.  They end only when the promises that are left, added up, are less than the k-th sum (of this block, or
of what the task found before): a document not seen yet can't get in then, nor tie.  Documents whose sum and all promises
reach it are completed from the rest of the lists, so the scores are exact.  Each task keeps k documents a query and
Spark ranks them.  Queries come in groups of bounded size; each group is told to all tasks and runs over the whole index.

Terms keep everything but ASCII punctuation, space and controls; only A-Z is folded.  A null or wordless text holds no
term and is never found; a query without a known term finds nothing.  Equal scores rank by ascending doc_id, null last;
repeated rows are documents (or queries) of their own.  Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm._common import batches_of, forget, released, stored
from lodestone.llm.resample import FOLD, TEXTS

#: Words after which a block ends, and queries and characters after which a group of queries does.
BLOCK_TERMS, QUERIES, QUERY_CHARACTERS = 1 << 19, 4096, 8 << 20
#: Blocks (of some megabytes each) a row group of a stored table and a batch that a task reads.
GROUP_BLOCKS = 2
#: A round takes segments that promise at least this part of the highest promise.
PART = 0.7

BLOCK = "doc_ids array<bigint>, n_terms binary, n_docs bigint, words bigint, terms binary, ends binary, docs binary, counts binary"
INDEX = "doc_ids array<bigint>, n_docs bigint, terms binary, ends binary, impacts binary, stops binary, docs binary"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _batch(values: list, names: list[str]) -> pa.RecordBatch:
    kinds = {bytes: pa.binary(), int: pa.int64(), list: pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[type(v)]) for v in values], names=names)


def _names(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split(", ")]


def _count(block_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids, sizes, at, counts, held = {}, [], [], [], [], 0

        def block() -> pa.RecordBatch:
            """Postings of this block by term (in the order of their bytes) and document."""
            names = sorted(known)
            rank = np.empty(len(names), np.int64)
            rank[[known[t] for t in names]] = np.arange(len(names))
            term = rank[np.concatenate(at)] if at else np.zeros(0, np.int64)
            doc = np.repeat(np.arange(len(at)), [len(x) for x in at])
            order = np.argsort(term, kind="stable")
            ends = np.cumsum(np.bincount(term, minlength=len(names)))
            packed = [np.array(sizes, "<i8"), len(ids), sum(sizes), b" ".join(names), ends.astype("<i8"), doc[order].astype("<i4"), np.concatenate(counts)[order].astype("<i4") if at else np.zeros(0, "<i4")]
            return _batch([ids, *(x.tobytes() if isinstance(x, np.ndarray) else x for x in packed)], _names(BLOCK))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(text.as_py())
                if not found:
                    continue
                for t in set(found).difference(known):
                    known[t] = len(known)
                own, n = np.unique(np.fromiter(map(known.__getitem__, found), np.int64, len(found)), return_counts=True)
                ids.append(doc_id)
                sizes.append(len(found))
                at.append(own)
                counts.append(n)
                held += len(found)
                if held >= block_terms:
                    yield block()
                    known, ids, sizes, at, counts, held = {}, [], [], [], [], 0
        if ids:
            yield block()
        released()

    return run


def term_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Blocks of the documents (those with a term), as a stored table."""
    with batches_of(docs.sparkSession, TEXTS):
        return stored(docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(_count(block_terms), BLOCK), "term_blocks", GROUP_BLOCKS)


def _numbers(batch: pa.RecordBatch, k: int, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(column)[k].as_py(), kind)


def _impacts(n_docs: int, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ends, docs = _numbers(batch, k, "ends", "<i8"), _numbers(batch, k, "docs", "<i4")
                tf, size = _numbers(batch, k, "counts", "<i4").astype(np.int64), _numbers(batch, k, "n_terms", "<i8")
                m = np.array([100 - 75 + 75 * n * n_docs // n_words for n in size.tolist()], np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[docs])
                term = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
                order = np.lexsort((docs, -impact, term))
                term, impact, docs = term[order], impact[order], docs[order]
                last = np.flatnonzero(np.concatenate([(term[1:] != term[:-1]) | (impact[1:] != impact[:-1]), [True]])) if len(docs) else np.zeros(0, np.int64)
                segments = np.cumsum(np.bincount(term[last], minlength=len(ends)))
                packed = [segments.astype("<i4"), impact[last].astype("<i4"), (last + 1).astype("<i4"), docs]
                yield _batch([batch.column("doc_ids")[k].as_py(), batch.column("n_docs")[k].as_py(), batch.column("terms")[k].as_py(), *(x.tobytes() for x in packed)], _names(INDEX))
        released()

    return run


def impact_index(blocks: DataFrame) -> tuple[DataFrame, int]:
    """The index over the blocks, as a stored table, and the number of documents with a term."""
    total = blocks.agg(F.sum("n_docs").alias("n"), F.sum("words").alias("w")).first()
    n, n_words = total["n"] or 0, total["w"] or 0
    held = blocks.select("doc_ids", "n_docs", "n_terms", "terms", "ends", "docs", "counts")
    with batches_of(blocks.sparkSession, GROUP_BLOCKS):
        return stored(held.mapInArrow(_impacts(n, n_words), INDEX), "impacts", GROUP_BLOCKS), n


def _holding(wanted: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for k in range(batch.num_rows):
                docs = np.diff(_numbers(batch, k, "ends", "<i8"), prepend=0).tolist()
                for t, n in zip(batch.column("terms")[k].as_py().split(b" "), docs, strict=True):
                    if t in wanted:
                        total[t] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])
        released()

    return run


def document_frequencies(blocks: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the terms of a group of queries; at most as many rows as these are."""
    with batches_of(blocks.sparkSession, GROUP_BLOCKS):
        rows = blocks.select("terms", "ends").mapInArrow(_holding(wanted), "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["term"]): r["n"] for r in rows}


class _Lists:
    """A block of the index."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.ids, self.n = batch.column("doc_ids")[k].as_py(), batch.column("n_docs")[k].as_py()
        self.known = {t: i for i, t in enumerate(batch.column("terms")[k].as_py().split(b" "))}
        self.ends, self.impacts, self.stops, self.docs = (_numbers(batch, k, c, "<i4") for c in ("ends", "impacts", "stops", "docs"))

    def of(self, term: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """A term's impacts, highest first, how many of its postings each segment ends at, and the postings' documents."""
        i = self.known.get(term)
        if i is None:
            return None
        low, high = int(self.ends[i - 1]) if i else 0, int(self.ends[i])
        start = int(self.stops[low - 1]) if low else 0
        return self.impacts[low:high].astype(np.int64), self.stops[low:high] - start, self.docs[start : int(self.stops[high - 1])]


def _add(sums: np.ndarray, lists: tuple, low: int, high: int, weight: int, only: np.ndarray | None = None) -> None:
    """A term's segments low to high into their documents' sums; a document is once in a list."""
    impacts, stops, docs = lists
    start = int(stops[low - 1]) if low else 0
    value = np.repeat(impacts[low:high] * weight, np.diff(stops[low:high], prepend=start))
    docs = docs[start : int(stops[high - 1])]
    if only is not None:
        value, docs = value[only[docs]], docs[only[docs]]
    sums[docs] += value


def block_top(lists: dict[int, tuple], weights: dict[int, int], n: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's documents (places) and exact scores that can be among the k best, where others with least or more are known already."""
    cursor = dict.fromkeys(lists, 0)
    promise = {t: weights[t] * int(x[0][0]) for t, x in lists.items()}
    sums, bar = np.zeros(n, np.int64), least
    while promise:
        if sum(promise.values()) < bar:
            break
        level = PART * max(promise.values())
        for t in [t for t, p in promise.items() if p >= level]:
            impacts = lists[t][0]
            to = max(cursor[t] + 1, int(np.searchsorted(-impacts, -level / weights[t], "right")))
            _add(sums, lists[t], cursor[t], to, weights[t])
            cursor[t] = to
            if to < len(impacts):
                promise[t] = weights[t] * int(impacts[to])
            else:
                del promise[t]
        if n >= k:
            bar = max(least, int(np.partition(sums, n - k)[n - k]))
    rest = sum(promise.values())
    only = (sums > 0) & (sums + rest >= bar)
    if only.any():
        for t in promise:
            _add(sums, lists[t], cursor[t], len(lists[t][0]), weights[t], only)
    at = np.flatnonzero(only)
    return at, sums[at]


def _search(queries: list[tuple[int, dict[bytes, int]]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, float, int | None]]] = {}
        asked = {t: i for i, t in enumerate(dict.fromkeys(t for _, ws in queries for t in ws))}
        numbered = [(q, {asked[t]: w for t, w in ws.items()}) for q, ws in queries]
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Lists(batch, row)
                there = {i: x for t, i in asked.items() if (x := block.of(t)) is not None}
                for q, ws in numbered:
                    own = {t: there[t] for t in ws if t in there}
                    if not own:
                        continue
                    held = best.get(q, [])
                    at, scores = block_top(own, ws, block.n, k, -held[-1][0] if len(held) == k else 1)
                    if len(at) > k:  # equal scores stay until ids decide
                        keep = scores >= np.partition(scores, len(at) - k)[len(at) - k]
                        at, scores = at[keep], scores[keep]
                    ids = [block.ids[d] for d in at.tolist()]
                    found = [(-s, math.inf if d is None else d, d) for s, d in zip(scores.tolist(), ids, strict=True)]
                    best[q] = sorted([*held, *found], key=lambda x: x[:2])[:k]
        rows = [(q, d, -s) for q, held in best.items() for s, _, d in held]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])
        released()

    return run


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _groups(items: DataFrame, queries: int) -> Iterator[list[Row]]:
    group, size = [], 0
    for r in items.toLocalIterator():
        group.append(r)
        size += len(r["text"] or "")
        if len(group) >= queries or size >= QUERY_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS, queries: int = QUERIES) -> DataFrame:
    """For each item (item_id, text) its k best documents of docs (doc_id, text): item_id, rank (from 1), doc_id, score."""
    spark: SparkSession = docs.sparkSession
    asked = stored(items.select(F.monotonically_increasing_id().alias("query"), "item_id", F.col("text").cast("string").alias("text")), "queries")
    blocks = term_blocks(docs, block_terms=block_terms)
    index, n = impact_index(blocks)
    parts = []
    for group in _groups(asked.select("query", "text"), queries):
        counted = [(r["query"], Counter(terms_of(r["text"]))) for r in group]
        holding = document_frequencies(blocks, {t for _, c in counted for t in c})
        weigh = {t: term_weight(n, df) for t, df in holding.items()}
        weighed = [(q, ws) for q, c in counted if (ws := {t: m * weigh[t] for t, m in c.items() if weigh.get(t, 0) > 0})]
        with batches_of(spark, GROUP_BLOCKS):
            parts.append(stored(index.mapInArrow(_search(weighed, k), "query bigint, doc_id bigint, score bigint"), "found"))
    found = spark.createDataFrame([], "query bigint, doc_id bigint, score bigint")
    for part in parts:
        found = found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = stored(best.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score"), "ranked")
    for held in (asked, blocks, index, *parts):
        forget(held)
    return out
