"""N-gram Jaccard join: documents whose sets of 5-word shingles are alike, by T-occurrence search with DivideSkip.

Sets are 64-bit shingle hashes; equal sets are collapsed to one node each.  Like sets of n and m elements share at least
o = 3/7 (n + m) of them (for 0.75), so a set may hold at most n - ceil(0.75 n) elements that nobody else has.

1. Prefixes.  The first n - ceil(0.75 n) + T elements of a set in the order of their hashes share T with those of any
   like set (T grows with n).  They are dealt by hash, counted, and a node whose prefix holds too few shared elements is out.
2. Live elements.  Of the nodes left, whole sets are dealt the same way: elements of one node only are dead, nodes with too
   many dead ones are out, and again, since their going kills others.  What stays are near copies and little else; an
   overlap of two sets is one of their l live elements, so 7 min(l, l') >= 3 (n + n') must hold for a link.
3. Leaders.  In the order of rising frequency, the first l - ceil(0.75 n) + T live elements of a node are its lists.  Each
   node is compared with the node that leads most of its lists (the one with the largest live share), which connects
   nearly all near copies.
4. Search.  Nodes of one component (or, alone, with one best leader) form blocks of bounded size.  A node of a smaller
   component asks the blocks that share T of its lists, and a block answers by T-occurrence search in its inverted
   lists: short ones are heap-merged and counted, candidates that can still reach the required overlap are probed in the long ones by
   binary search.  No pair of documents is listed before it is a link.  Every pair of nodes of different components
   is covered, so `component_id` is exact.

Texts are lower-cased A-Z only; words are [^\\x20\\x09-\\x0D]+.  With fewer than five words the whole sequence is one
shingle; without any (or with a null text) the set is empty and is linked with nothing.  Of equal sets the smallest doc_id
counts.  Rows that share a doc_id are rows of their own; a null doc_id links like any other, but is nobody's
component_id unless all of a component's are null.  Very long texts are sets like others.  Extra columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm._common import forget, partitions, released, small_batches, stored
from lodestone.llm.components import components

WORDS, SIMILARITY_PERCENT, OCCURRENCES = 5, 75, 4
#: Rows that are told to all tasks at most (each of some 40 bytes), and elements of a block of the index.
BROADCAST_ROWS, BLOCK_ELEMENTS, QUERIES = 1_000_000, 200_000, 256
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    import xxhash

    if not text:
        return np.zeros(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    n = len(words)
    if n < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64) if n else np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    h = w[: n - 4] * FACTORS[0]
    for k in range(1, WORDS):
        h = h + w[k : n - 4 + k] * FACTORS[k]
    return np.unique(_mixed(h))


def required(n: int, percent: int = SIMILARITY_PERCENT) -> int:
    """The least overlap of a set of n with any set that is like it."""
    return -(-percent * n // 100)


def occurrences(n: int) -> int:
    """T of the first step."""
    return min(8 + n // 8, required(n))


def prefix_length(n: int) -> int:
    return min(n, n - required(n) + occurrences(n))


def overlap(n, m, percent: int = SIMILARITY_PERCENT):
    """What sets of n and m share at least if |x & y| * 100 >= percent * |x | y|."""
    return -(-percent * (n + m) // (100 + percent))


def _digest(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return (d & 0xFFFFFFFFFFFFFFFF) - (1 << 63), (d >> 64) - (1 << 63)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its id, size and set digest."""
    for batch in batches:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        digests = [_digest(s) for s in sets]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64())], names=["doc_id", "n", "one", "two"])
    released()


CELLS = "p int, hashes binary, ids binary"


def _cells(h: np.ndarray, d: np.ndarray, parts: int) -> pa.RecordBatch:
    """Postings packed by the partition of their element: 32 bits of the hash, and the differences of the sorted ids."""
    p = (h >> np.uint64(40)) % np.uint64(parts)
    order = np.lexsort((d, p))
    p, h, d = p[order], (h[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32), d[order]
    first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    ends = np.append(first[1:], len(p))
    step = np.diff(d, prepend=0)
    step[first] = d[first]
    bounds = list(zip(first.tolist(), ends.tolist(), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(p[first].astype(np.int32)), pa.array([h[a:b].tobytes() for a, b in bounds], pa.binary()), pa.array([step[a:b].tobytes() for a, b in bounds], pa.binary())], names=["p", "hashes", "ids"])


def _dealt(rows: Iterator[tuple[int, np.ndarray]], parts: int) -> Iterator[pa.RecordBatch]:
    hs, ds, size = [], [], 0
    for node, s in rows:
        hs.append(s)
        ds.append(np.full(len(s), node, np.int64))
        size += len(s)
        if size > 400_000:
            yield _cells(np.concatenate(hs), np.concatenate(ds), parts)
            hs, ds, size = [], [], 0
    if size:
        yield _cells(np.concatenate(hs), np.concatenate(ds), parts)
    released()


def _prefixes(parts: int):
    """doc_id, text -> the postings of prefixes; of equal sets in one task only the first's."""

    def rows(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = shingles(text)
                if len(s) and (key := _digest(s)) not in seen:
                    if len(seen) < 100_000:
                        seen.add(key)
                    # The set stands for itself here: its node isn't known yet.
                    yield key[0], s[: prefix_length(len(s))]

    return lambda batches: _dealt(rows(batches), parts)


def _whole_sets(parts: int):
    """node, s -> the postings of whole sets."""

    def rows(batches):
        for batch in batches:
            for node, s in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield node, s.values.to_numpy(zero_copy_only=False).view(np.uint64)

    return lambda batches: _dealt(rows(batches), parts)


def _shared(parts: int):
    """All postings of a partition -> for each id in it, how many of its elements somebody else has too, packed by the id's partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, ds = [], []
        for batch in batches:
            for h, d in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                hs.append(np.frombuffer(h, np.uint32))
                ds.append(np.cumsum(np.frombuffer(d, np.int64)))
        if hs:
            h, d = np.concatenate(hs), np.concatenate(ds)
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            own = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))  # equal sets of other tasks count once
            h, d = h[own], d[own]
            same = h[1:] == h[:-1]
            live = np.append(False, same) | np.append(same, False)
            ids, counts = np.unique(d[live], return_counts=True)
            q = ids.view(np.uint64) * FACTORS[0] >> np.uint64(33)
            q = (q % np.uint64(parts)).astype(np.int32)
            order = np.lexsort((ids, q))
            ids, counts, q = ids[order], counts[order].astype(np.int32), q[order]
            first = np.flatnonzero(np.append(True, q[1:] != q[:-1])[: len(q)])
            bounds = list(zip(first.tolist(), np.append(first[1:], len(q)).tolist(), strict=True)) if len(q) else []
            yield pa.RecordBatch.from_arrays([pa.array(q[first]), pa.array([ids[a:b].tobytes() for a, b in bounds], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in bounds], pa.binary())], names=["q", "ids", "counts"])
        released()

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a partition's ids from all partitions of elements -> their sums."""
    rows = [r for batch in batches for r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
    if rows:
        ids, place = np.unique(np.concatenate([np.frombuffer(a, np.int64) for a, _ in rows]), return_inverse=True)
        sums = np.bincount(place, np.concatenate([np.frombuffer(b, np.int32) for _, b in rows])).astype(np.int64)
        for at in range(0, len(ids), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 50_000]), pa.array(sums[at : at + 50_000])], names=["id", "live"])
    released()


def _live_counts(packed: DataFrame) -> DataFrame:
    """CELLS -> id, live."""
    parts = partitions(packed.sparkSession)
    shared = packed.repartitionById(parts, F.col("p")).mapInArrow(_shared(parts), "q int, ids binary, counts binary")
    return shared.repartitionById(parts, F.col("q")).mapInArrow(_added, "id long, live long")


class Index:
    """A block of sets with its inverted lists; answers which of them are like a query."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        lengths = np.array([len(s) for s in sets], np.int64)
        self.n, self.live, self.sets = np.array(sizes, np.int64), lengths, len(sets)
        elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), lengths)
        order = np.lexsort((owner, elements))
        self.elements, self.owner = elements[order], owner[order]

    def search(self, query: np.ndarray, n: int, percent: int = SIMILARITY_PERCENT) -> list[int]:
        """query: a set's live elements; n: its size with the dead ones.  Numbers of the like sets, by DivideSkip.

        The longest lists are left out of the merge, which then asks for so many occurrences fewer, and whoever
        survives is probed in them by binary search.
        """
        least = overlap(n, self.n, percent)
        can = np.minimum(self.live, len(query)) >= least
        if not can.any():
            return []
        low, high = np.searchsorted(self.elements, query, "left"), np.searchsorted(self.elements, query, "right")
        at = np.flatnonzero(high > low)
        t = int(least[can].min())
        if len(at) < t:
            return []
        at = at[np.argsort(high[at] - low[at], kind="stable")]
        lists = [self.owner[a:b].tolist() for a, b in zip(low[at].tolist(), high[at].tolist(), strict=True)]
        skip = min(t - 1, int(t / (0.0085 * math.log2(max(2, len(lists[-1]))) + 1)))
        short, probed = lists[: len(lists) - skip], lists[len(lists) - skip :]
        wanted, possible = least.tolist(), can.tolist()
        counts: dict[int, int] = {}
        for k in heapq.merge(*short):
            counts[k] = counts.get(k, 0) + 1
        found = []
        for k, c in sorted(counts.items()):
            t, left = wanted[k], len(probed)
            if not possible[k] or c + left < t:
                continue
            for one in probed:
                x = bisect_left(one, k)
                c += x < len(one) and one[x] == k
                left -= 1
                if c >= t or c + left < t:
                    break
            if c >= t:
                found.append(k)
        return found


def divide_skip(query: np.ndarray, sets: list[np.ndarray], percent: int = SIMILARITY_PERCENT) -> list[int]:
    """Numbers of the sets that are like the query."""
    return Index(sets, [len(s) for s in sets]).search(query, len(query), percent) if sets and len(query) else []


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block's nodes (asks false) and the nodes that ask it: the links found; of a block that is one component, one for each asker."""
    asks = pdf["asks"].to_numpy(bool)
    block, askers = pdf[~asks], pdf[asks]
    us, vs = [], []
    if len(block) and len(askers):
        index = Index([np.asarray(s, np.int64).view(np.uint64) for s in block["live"]], block["n"].tolist())
        nodes, one = block["node"].to_numpy(np.int64), bool(block["whole"].all())
        for node, n, live in zip(askers["node"].tolist(), askers["n"].tolist(), askers["live"], strict=True):
            found = [k for k in index.search(np.asarray(live, np.int64).view(np.uint64), n) if nodes[k] != node]
            for k in found[:1] if one else found:
                us.append(node)
                vs.append(int(nodes[k]))
    return pd.DataFrame({"u": pd.Series(us, dtype="int64"), "v": pd.Series(vs, dtype="int64")})


def _answers(asked: DataFrame, blocks: DataFrame, nodes: DataFrame) -> DataFrame:
    """asked (node, block), blocks (node, block, whole), nodes (node, n, live) -> links (u, v).

    The askers of a block come in chunks of about QUERIES, each with a copy of the block.
    """
    chunks = stored(asked.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("chunks")), "chunks")
    few = chunks.count() <= BROADCAST_ROWS
    near = F.broadcast(chunks) if few else chunks
    held = blocks.join(near, "block").join(nodes, "node").select("block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "node", "n", "live", "whole", F.lit(False).alias("asks"))
    asking = asked.join(near, "block").join(nodes, "node").select("block", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), "node", "n", "live", F.lit(False).alias("whole"), F.lit(True).alias("asks"))
    return held.unionByName(asking).groupBy("block", "chunk").applyInPandas(_answer, "u long, v long")


def _need(c: F.Column) -> F.Column:
    return F.ceil(c * SIMILARITY_PERCENT / 100)


def _fit(n: str, live: str, m: str, other: str) -> F.Column:
    """Whether two nodes can share enough."""
    return F.least(F.col(live), F.col(other)) * (100 + SIMILARITY_PERCENT) >= (F.col(n) + F.col(m)) * SIMILARITY_PERCENT


def similar(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, n_shingles, component_id: one row per row of docs."""
    spark = docs.sparkSession
    small_batches(spark, 256)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sizes = stored(docs.mapInArrow(_measure, "doc_id long, n long, one long, two long"), "sizes")
    heads = sizes.filter("n > 0").groupBy("one", "two", "n").agg(F.min("doc_id").alias("doc")).withColumn("node", F.monotonically_increasing_id())
    heads = stored(heads, "heads")
    linked = components(_links(docs, heads))
    # A component's smallest doc_id; nodes without a link keep their own.
    named = linked.join(heads.select("node", "doc"), "node").groupBy("component").agg(F.min("doc").alias("smallest"))
    renamed = linked.join(named, "component").select("node", "smallest")
    labelled = heads.join(renamed, "node", "left").select(F.col("one").alias("h1"), F.col("two").alias("h2"), F.col("n").alias("hn"), F.coalesce("smallest", "doc").alias("component"))
    out = sizes.join(labelled, (F.col("one") == F.col("h1")) & (F.col("two") == F.col("h2")) & (F.col("n") == F.col("hn")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _sets(docs: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """node, n, s: the sets of the wanted nodes (node, doc, n, one, two), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["h1", "h2", "s"])
        released()

    few = n_wanted <= BROADCAST_ROWS
    near = F.broadcast if few else (lambda d: d)
    ids = wanted.select("doc").distinct()
    mine = docs.join(near(ids), docs["doc_id"].eqNullSafe(ids["doc"]), "left_semi").mapInArrow(run, "h1 long, h2 long, s array<long>")
    # Rows that repeat an id and a text give one node twice.
    return mine.join(near(wanted.select("node", "n", "one", "two")), (F.col("h1") == F.col("one")) & (F.col("h2") == F.col("two"))).select("node", "n", "s").dropDuplicates(["node"])


def _lively(docs: DataFrame, heads: DataFrame) -> DataFrame | None:
    """node, n, l, live: the nodes that can have a link, with their live elements, rare ones first; None without any."""
    parts = partitions(docs.sparkSession)
    first = _live_counts(docs.mapInArrow(_prefixes(parts), CELLS))
    n = F.col("n")
    smaller = _need(n)
    least = F.least(F.lit(8) + F.floor(smaller / 8), _need(smaller))
    wanted = stored(heads.join(first, heads["one"] == first["id"]).filter(F.col("live") >= least).drop("id", "live"), "wanted")
    count = wanted.count()
    if not count:
        return None
    sets = stored(_sets(docs, wanted, count), "sets")
    forget(wanted)
    while True:  # ends: fewer nodes each time, or nearly as many
        live = _live_counts(sets.select("node", "s").mapInArrow(_whole_sets(parts), CELLS)).withColumnRenamed("id", "node")
        fewer = stored(sets.join(live.filter("live > 0"), "node").filter(F.col("live") * 100 >= n * SIMILARITY_PERCENT).select("node", "n", "s"), "sets")
        forget(sets)
        sets, before = fewer, count
        count = sets.count()
        if not count:
            return None
        if count > 0.9 * before:
            break
    postings = stored(sets.select("node", F.explode("s").alias("h")), "postings")
    often = postings.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    live = postings.join(often, "h").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("x")).select("node", F.expr("transform(x, e -> e.h)").alias("live"))
    out = stored(sets.select("node", "n").join(live, "node").withColumn("l", F.size("live").cast("long")).filter(F.col("l") * 100 >= n * SIMILARITY_PERCENT), "lively")
    forget(sets)
    forget(postings)
    return out


def _links(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """Links among nodes that connect all of each component."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "u long, v long")
    nodes = _lively(docs, heads)
    if nodes is None:
        return empty
    t = F.least(F.lit(OCCURRENCES), _need(_need(F.col("n"))))
    some = F.expr(f"slice(live, 1, cast(l - ceil(n * {SIMILARITY_PERCENT} / 100) + {OCCURRENCES} as int))")
    lists = stored(nodes.select("node", "n", "l", t.cast("int").alias("t"), F.explode(some).alias("list")), "lists")

    # 3. Everybody meets the leader of most of its lists.
    leader = lists.groupBy("list").agg(F.max(F.struct((F.col("l") / F.col("n")).alias("share"), (-F.col("node")).alias("back"), F.col("n").alias("m"), F.col("l").alias("k"))).alias("x"), F.count("*").alias("df")).filter("df > 1")
    leader = leader.select("list", (-F.col("x.back")).alias("lead"), F.col("x.m").alias("m"), F.col("x.k").alias("k"))
    met = lists.join(leader, "list").filter(F.col("node") != F.col("lead")).groupBy("node", "lead", "t").agg(F.count("*").alias("c"), F.first(_fit("n", "l", "m", "k")).alias("fit"))
    met = met.groupBy("node").agg(F.max(F.struct((F.col("fit") & (F.col("c") >= F.col("t"))).alias("fit"), "c", (-F.col("lead")).alias("back"))).alias("x"))
    # Nodes that can't be like their leader still stand with it in the index.
    near = stored(met.select("node", (-F.col("x.back")).alias("lead"), "x.fit"), "near")
    best = near.filter("fit").select("node", "lead")
    led = best.select("lead").distinct().select(F.col("lead").alias("node"), F.col("lead").alias("block"), F.lit(True).alias("whole"))
    links = stored(_answers(best.select("node", F.col("lead").alias("block")), led, nodes.select("node", "n", "live")), "links")
    known = stored(components(links), "known")

    # 4. Blocks of one component, or of lone nodes with one leader's component; those of smaller components ask.
    of = known.select(F.col("node").alias("lead"), F.col("component").alias("led_by"))
    at = nodes.select("node", "l").join(known, "node", "left").join(near.select("node", "lead"), "node", "left").join(of, "lead", "left")
    alone = F.col("component").isNull()
    at = at.select("node", "l", alone.alias("alone"), F.coalesce("component", "node").alias("comp"), F.coalesce(F.col("component"), F.col("led_by"), F.col("lead"), F.col("node")).alias("key"))
    groups = at.groupBy("alone", "key").agg(F.sum("l").alias("elements"), F.count("*").alias("size"))
    groups = groups.select(F.col("alone").alias("a"), F.col("key").alias("k"), F.when(F.col("alone"), 1).otherwise(F.col("size")).alias("size"), F.ceil(F.col("elements") / BLOCK_ELEMENTS).alias("blocks"))
    placed = at.join(groups, (F.col("alone") == F.col("a")) & (F.col("key") == F.col("k")))
    # A component's rank orders who asks whom: smaller ones ask larger ones.
    placed = stored(placed.select("node", "comp", "alone", F.struct("size", F.when(F.col("alone"), 0).otherwise(F.col("comp")).alias("comp")).alias("rank"), F.xxhash64("alone", "key", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block")), "placed")
    whose = stored(lists.select("node", "n", "l", "t", "list").join(placed, "node"), "whose")
    # An inverted index over blocks: one posting for each block and list.
    index = whose.groupBy("list", "block", "rank").agg(F.count("*").alias("size"), F.min("node").alias("only"), F.min("n").alias("m"), F.max("l").alias("k"))
    index = index.select("list", F.col("block").alias("to"), F.col("rank").alias("to_rank"), "size", "only", "m", "k")
    # Nobody of a list's largest component asks by it.
    top = index.groupBy("list").agg(F.max("to_rank").alias("top"), F.count("*").alias("to_blocks"), F.max("size").alias("most")).filter("to_blocks > 1 or most > 1").select("list", "top")
    askers = whose.join(top, "list").filter(F.col("alone") | (F.col("rank") < F.col("top")))
    # A block without a node of this list that the asker can be like isn't asked by it.
    asked = askers.join(index, "list").filter(_fit("n", "l", "m", "k") & ((F.col("rank") < F.col("to_rank")) | (F.col("alone") & (F.col("rank") == F.col("to_rank")) & ~((F.col("size") == 1) & (F.col("only") == F.col("node"))))))
    asked = asked.groupBy("node", "to", "t").agg(F.count("*").alias("c")).filter("c >= t").select("node", F.col("to").alias("block"))
    more = _answers(stored(asked, "asked"), placed.select("node", "block", (~F.col("alone")).alias("whole")), nodes.select("node", "n", "live"))
    found = stored(links.unionByName(more), "found")
    for table in (lists, links, whose):
        forget(table)
    return found
