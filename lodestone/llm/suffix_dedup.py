"""Suffix-array deduplication with a logarithmic family of indexes.

What counts as a match is a byte string of LENGTH bytes that starts somewhere else too.  Every such string contains an
anchor: the 64-byte piece of smallest hash in it, the leftmost of equal ones, which depends on the string alone.  So the
suffixes that begin at anchors (about one in seventy) stand for all of them: equal strings have equal suffix heads (the
first 64 bytes) at equal offsets.  Each start belongs to one anchor; an anchor's context is the text that its starts' strings cover.

1. Equal texts (by 128 bits of hash) are collapsed: each is a match of the others as a whole, and one of them is indexed.
2. A task's texts, some 20 MB at a time, are a batch.  Its suffix array is its anchors in the lexicographic order of their
   heads.  Anchors of a batch with equal heads and contexts are matches at once, and only one of them goes on.
3. Suffixes are dealt by head.  In each partition a family of levels takes in one batch after the other: a batch's sorted heads are
   scanned by themselves and against every level, neighbours that agree in all 64 bytes are long matches, and levels
   of equally many batches merge, so a head takes part in as many merges as the logarithm of the number of batches.
4. Of suffixes whose head occurs again, equal contexts are matches as a whole.  Where contexts of one head differ, their bytes are fetched,
   and a suffix array of all their positions, sorted to a depth of LENGTH by doubling, has strings that
   occur twice as neighbours with a common prefix of LENGTH.  A head with more than SPLIT contexts is compared by 128 bits of hash of
   each of its strings, spread over all tasks.  All matches of a document are united at last.

Matches are judged on the input; the same document counts, overlaps count, matches never cross documents.  A null text
is an empty one: nothing is removed.  Equal rows are two documents, whatever their ids; a null doc_id stays null.  Of equal
heads or contexts none is preferred.  Very long texts are cut at no place.  Extra columns are ignored, whatever their
names.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm._common import forget, partitions, released, small_batches, stored

LENGTH, PIECE = 200, 64
STARTS = LENGTH - PIECE + 1  # pieces in a string
SPLIT = 8_000  # contexts of one head that one task compares
BATCH = 300_000  # suffixes of a batch
BROADCAST_MB = 32
BYTES32 = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)
BYTES64, OTHER64 = (np.random.default_rng(k).integers(0, 1 << 63, 256, dtype=np.uint64) for k in (6, 7))
FACTOR32, FACTOR64 = 0x9E3779B1, 0x9E3779B97F4A7C15


def _grams(data: np.ndarray, length: int, wide: bool, table: np.ndarray = BYTES64) -> np.ndarray:
    """A hash of the `length` bytes from each position (the last length - 1 positions have none)."""
    kind, factor, mask = (np.uint64, FACTOR64, (1 << 64) - 1) if wide else (np.uint32, FACTOR32, (1 << 32) - 1)
    block = (table if wide else BYTES32)[data]  # of blocks of `size` bytes
    size, out, covered = 1, None, 0
    while True:
        if length & size:
            # the blocks of a binary number, shortest first
            out = block if out is None else block[: len(block) - covered] * kind(pow(factor, covered, mask + 1)) + out[size : size + len(block) - covered]
            covered += size
        if covered == length:
            break
        block = block[: len(block) - size] * kind(pow(factor, size, mask + 1)) + block[size:]
        size *= 2
    out = out[: len(data) - length + 1]
    shift = 31 if wide else 15
    out = (out ^ (out >> kind(shift))) * kind(0xBF58476D1CE4E5B9 & mask | 1)
    return out ^ (out >> kind(shift))


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first start and last start, of every run of starts with one anchor; documents lie at starts to ends."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none
    h = _grams(data, PIECE, False)
    low = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)  # smallest hash, then leftmost
    reach = 1
    while reach * 2 <= STARTS:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[: len(low) - (STARTS - reach)], low[STARTS - reach :])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the string from each position
    # Starts whose string lies within its document.
    edge = np.zeros(len(data) + 1, np.int32)
    last = ends - LENGTH + 1
    fits = last > starts
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, last[fits], -1)
    valid = np.cumsum(edge)[: len(anchor)] > 0
    at = np.flatnonzero(valid)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    a = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (a[1:] != a[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return a[first], at[first], at[np.append(first[1:], len(at)) - 1]


HEAD = np.dtype(f"S{PIECE}")  # all heads are PIECE bytes long, so padding tells none apart
FIELDS = (("head", HEAD), ("ctx", np.uint64), ("rid", np.int64), ("pos", np.int32), ("left", np.int16), ("right", np.int16))
RUN = "p int, " + ", ".join(f"{n} binary" for n, _ in FIELDS)


def _alike(a: np.ndarray) -> np.ndarray:
    """For each element of a sorted array, whether it equals the one before."""
    return np.append(False, a[1:] == a[:-1])[: len(a)]


def _batch(columns: list[np.ndarray], parts: int, turn: int) -> Iterator[pa.RecordBatch]:
    """A batch's suffix array, cut by partition; anchors that equal another in head and context are settled (a row with an empty head)."""
    order = np.argsort(columns[0], kind="stable")
    order = order[np.lexsort((columns[1][order], np.cumsum(~_alike(columns[0][order]))))]
    columns = [c[order] for c in columns]
    again = _alike(columns[0]) & _alike(columns[1])
    group = np.cumsum(~again)
    settled = np.bincount(group)[group] > 1
    # The first of alike anchors stands for them in the index.
    first = [c[~again] for c in columns]
    p = np.frombuffer(first[0].tobytes(), np.uint64).reshape(-1, PIECE // 8) @ (np.arange(1, PIECE // 8 + 1, dtype=np.uint64) * np.uint64(FACTOR64))
    p = ((p ^ (p >> np.uint64(33))) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(p, kind="stable")
    p, first = p[order], [c[order] for c in first]
    at = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    bounds = list(zip(at.tolist(), np.append(at[1:], len(p)).tolist(), strict=True))
    names = ["p", *(n for n, _ in FIELDS)]
    yield pa.RecordBatch.from_arrays([pa.array(p[at]), *(pa.array([c[a:b].tobytes() for a, b in bounds], pa.binary()) for c in first)], names=names)
    if settled.any():
        rows = [c[settled] for c in columns[2:]]
        yield pa.RecordBatch.from_arrays([pa.array([turn % parts], pa.int32()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary()), *(pa.array([c.tobytes()], pa.binary()) for c in rows)], names=names)


def _suffixes(parts: int, batch: int):
    """rid, text -> the batches' suffix arrays, packed by partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest, held, size, turn = xxhash.xxh3_64_intdigest, [], 0, 0

        def columns():
            return [np.concatenate([h[k] for h in held]) for k in range(len(FIELDS))]

        for part in batches:
            rids, texts = part.column(0).to_numpy(), [t.encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
            at = 0
            while at < len(texts):  # a bounded number of bytes at a time
                to, n = at, 0
                while to < len(texts) and (n == 0 or n + len(texts[to]) < 1 << 20):
                    n += len(texts[to])
                    to += 1
                joined = b"".join(texts[at:to])
                sizes = np.array([len(t) for t in texts[at:to]], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                a, first, last = anchors(np.frombuffer(joined, np.uint8), starts, ends)
                if len(a):
                    heads = np.frombuffer(b"".join([joined[x : x + PIECE] for x in a.tolist()]), HEAD)
                    ctx = np.array([digest(joined[f : e + LENGTH], x - f) for f, e, x in zip(first.tolist(), last.tolist(), a.tolist(), strict=True)], np.uint64)
                    doc = np.searchsorted(ends, a, side="right")
                    held.append((heads, ctx, rids[at:to][doc], (a - starts[doc]).astype(np.int32), (a - first).astype(np.int16), (a - last).astype(np.int16)))
                    size += len(a)
                at = to
                if size > batch:
                    turn += 1 + int(held[0][2][0]) % 997
                    yield from _batch(columns(), parts, turn)
                    held, size = [], 0
        if held:
            yield from _batch(columns(), parts, turn + 1 + int(held[0][2][0]) % 997)
        released()

    return run


class IndexFamily:
    """Levels of sorted distinct heads; a batch is scanned against all of them and then joins them."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray]] = []  # (batches in it, heads)
        self.repeated: list[np.ndarray] = []

    def insert(self, heads: np.ndarray) -> None:
        """heads: a batch's, in order."""
        same = _alike(heads)
        self.repeated.append(heads[same])
        heads = heads[~same]
        for _, level in self.levels:
            # A head's neighbours in the merged order: the one it would stand before is the only one that can agree in full.
            at = np.minimum(np.searchsorted(level, heads), len(level) - 1)
            self.repeated.append(heads[level[at] == heads])
        new = (1, heads)
        while self.levels and self.levels[-1][0] == new[0]:
            count, level = self.levels.pop()
            merged = np.sort(np.concatenate([level, new[1]]), kind="stable")  # of two sorted runs: a linear merge
            new = (count + new[0], merged[~_alike(merged)])
        if len(new[1]):
            self.levels.append(new)

    def matches(self) -> np.ndarray:
        """The heads that occurred more than once, in order."""
        return np.unique(np.concatenate(self.repeated)) if self.repeated else np.zeros(0, HEAD)


JUDGED = "p int, what int, rid long, a long, b long"


def _judged(p: int, what: np.ndarray, rid: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rid), 50_000):
        w = slice(at, at + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rid[w]), p, np.int32)), pa.array(what[w].astype(np.int32)), pa.array(rid[w]), pa.array(a[w].astype(np.int64)), pa.array(b[w].astype(np.int64))], names=["p", "what", "rid", "a", "b"])


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's suffix arrays -> matches as a whole (what 0), and contexts to compare (1; 2: of heads with very many)."""
    family, runs, part = IndexFamily(), [], 0
    for batch in batches:
        for row in batch.to_pylist():
            columns = [np.frombuffer(row[n], kind) for n, kind in FIELDS]
            if not len(columns[0]):  # settled
                _, _, rid, pos, left, right = columns
                yield from _judged(row["p"], np.zeros(len(rid), np.int32), rid, pos.astype(np.int64) - left, pos.astype(np.int64) - right + LENGTH)
                continue
            part = row["p"]
            family.insert(columns[0])
            runs.append(columns)
    repeated = family.matches()
    if len(repeated):
        live = []
        for columns in runs:
            at = np.minimum(np.searchsorted(repeated, columns[0]), len(repeated) - 1)
            hit = repeated[at] == columns[0]
            live.append([at[hit], *(c[hit] for c in columns[1:])])
        key, ctx, rid, pos, left, right = (np.concatenate(c) for c in zip(*live, strict=True))
        order = np.lexsort((ctx, key))
        key, ctx, rid, pos, left, right = (c[order] for c in (key, ctx, rid, pos.astype(np.int64), left.astype(np.int64), right.astype(np.int64)))
        new_key = ~_alike(key)
        new_ctx = new_key | ~_alike(ctx)
        ctx_no, key_no = np.cumsum(new_ctx) - 1, np.cumsum(new_key) - 1
        alike = np.bincount(ctx_no)[ctx_no]
        kinds = np.bincount(key_no, new_ctx.astype(np.int64)).astype(np.int64)[key_no]
        whole = np.flatnonzero(alike > 1)
        compare = np.flatnonzero((kinds > 1) & new_ctx)  # a context that occurs more than once is compared once
        take = np.concatenate([whole, compare])
        what = np.concatenate([np.zeros(len(whole), np.int32), np.where(kinds[compare] > SPLIT, 2, 1).astype(np.int32)])
        yield from _judged(part, what, rid[take], (pos - left)[take], (pos - right)[take] + LENGTH)
    released()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid, text, asked (p, what, a, b) -> the contexts' bytes, or for split heads the hash of each string in them."""
    names, kinds = ["p", "rid", "a", "piece", "h", "h2"], [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    for part in batches:
        out: list[tuple] = []
        for rid, text, asked in zip(*(c.to_pylist() for c in part.columns), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for x in asked:
                piece = data[x["a"] : x["b"]]
                if x["what"] == 1:
                    out.append((x["p"], rid, x["a"], piece, None, None))
                else:
                    both = (_grams(np.frombuffer(piece, np.uint8), LENGTH, True, t).view(np.int64).tolist() for t in (BYTES64, OTHER64))
                    out += [(0, rid, x["a"] + k, None, *h) for k, h in enumerate(zip(*both, strict=True))]
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)
                    out = []
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)], names=names)
    released()


def ranks_to_depth(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The rank of every position's suffix among all, by its first `depth` bytes (at least 4): equal ranks, equal bytes.

    Prefix doubling: ranks by 4 bytes, then 8, 16 and so on from pairs of ranks.  Beyond the end stand zeros.
    """
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    n = len(data)
    key = padded[:n] << 24 | padded[1 : n + 1] << 16 | padded[2 : n + 2] << 8 | padded[3 : n + 3]
    rank, known = np.unique(key, return_inverse=True)[1].astype(np.int64), 4
    while known < depth:
        step = min(known, depth - known)
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        rank = np.unique(rank << 32 | after, return_inverse=True)[1].astype(np.int64)
        known += step
    return rank


def repeated_starts(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start) of the strings of LENGTH bytes that occur twice in the pieces, by a suffix array of all their bytes."""
    sizes = np.array([len(x) for x in pieces], np.int64)
    begin = np.cumsum(sizes) - sizes
    rank = ranks_to_depth(np.frombuffer(b"".join(pieces), np.uint8))
    n = np.maximum(sizes - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(pieces)), n)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    own = rank[begin[owner] + start]  # strings within a piece; others' ranks only helped to sort
    order = np.argsort(own, kind="stable")  # the suffix array
    same = _alike(own[order])
    twice = np.zeros(len(own), bool)
    twice[order[same]] = True
    twice[order[np.flatnonzero(same) - 1]] = True
    return owner[twice], start[twice]


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's contexts -> runs of starts whose string occurs in two of them."""
    rid, a, pieces = [], [], []
    for part in batches:
        rid += part.column(1).to_pylist()
        a += part.column(2).to_pylist()
        pieces += part.column(3).to_pylist()
    if pieces:
        o, s = repeated_starts(pieces)
        if len(o):
            first = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (s[1:] != s[:-1] + 1)))
            last = np.append(first[1:], len(o)) - 1
            base = np.array(a, np.int64)[o[first]]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(rid, np.int64)[o[first]]), pa.array(base + s[first]), pa.array(base + s[last] + LENGTH)], names=["rid", "a", "b"])
    released()


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        spans = [[x for s in united([(x["a"], x["b"]) for x in asked]) for x in s] for asked in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, pa.list_(pa.int64()))], names=["rid", "spans"])


def _joined_by_rid(docs: DataFrame, asked: DataFrame, elements: str, width: int, how: str) -> DataFrame:
    """A broadcast where what is asked is few bytes; beyond, texts are shuffled by document."""
    mb = (asked.agg(F.sum(F.size(elements) * width + 32)).first()[0] or 0) / 1e6
    return docs.join(F.broadcast(asked) if mb <= BROADCAST_MB else asked, "rid", how)


def repeated_spans(docs: DataFrame, batch: int = BATCH) -> DataFrame:
    """rid (of a text), text (not null) -> rid, a, b: byte ranges of matches between different texts, or within one."""
    spark = docs.sparkSession
    small_batches(spark, 256)
    parts = partitions(spark)
    packed = docs.select("rid", "text").mapInArrow(_suffixes(parts, batch), RUN).repartitionById(parts, F.col("p"))
    judged = stored(packed.mapInArrow(_family, JUDGED), "contexts")
    asked = stored(judged.filter("what > 0").groupBy("rid").agg(F.collect_list(F.struct("p", "what", "a", "b")).alias("asked")), "asked")
    texts = _joined_by_rid(docs.select("rid", "text"), asked, "asked", 24, "inner").select("rid", "text", "asked").mapInArrow(_texts, "p int, rid long, a long, piece binary, h long, h2 long")
    in_part = texts.filter("piece is not null").repartitionById(parts, F.col("p")).mapInArrow(_strings, "rid long, a long, b long")
    spans = judged.filter("what = 0").select("rid", "a", "b").unionByName(in_part)
    if judged.filter("what = 2").limit(1).count():
        split = stored(texts.filter("h is not null").select("h", "h2", "rid", "a"), "strings")
        twice = split.groupBy("h", "h2").agg(F.count("*").alias("n")).filter("n > 1")
        spans = spans.unionByName(split.join(twice.select("h", "h2"), ["h", "h2"], "left_semi").select("rid", "a", (F.col("a") + LENGTH).alias("b")))
    return spans


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        rows = []
        for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
            data, kept, at, removed = text.encode("utf-8", "surrogatepass"), [], 0, 0
            for a, b in zip((spans or [])[::2], (spans or [])[1::2], strict=True):
                kept.append(data[at:a])
                removed += b - a
                at = b
            kept.append(data[at:])
            rows.append((len(data), removed, len(spans or []) // 2, hashlib.sha256(b"".join(kept)).hexdigest()))
        yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _hashes(text: F.Column) -> tuple[F.Column, F.Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _identified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with rid, and rid, first and bytes of each text that occurs more than once.

    Texts are told apart by 128 bits: where texts with one first hash have several second ones, the second is their rid.
    """
    one, two = _hashes(F.col("text"))

    def repeated(docs: DataFrame) -> DataFrame:
        found = docs.groupBy("rid").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max(F.octet_length("text")).cast("long").alias("bytes"), F.min("other").alias("low"), F.max("other").alias("high"))
        return stored(found.filter("n > 1").select("rid", "first", "bytes", (F.col("low") != F.col("high")).alias("clash")), "copies")

    docs = docs.withColumns({"rid": one, "other": two})
    copies = repeated(docs)
    clash = copies.filter("clash").select(F.col("rid").alias("clashing"))
    n = clash.count()
    if n:
        docs = docs.join(F.broadcast(clash) if n <= 1_000_000 else clash, F.col("rid") == F.col("clashing"), "left").withColumn("rid", F.when(F.col("clashing").isNull(), F.col("rid")).otherwise(F.col("other"))).drop("clashing")
        copies = repeated(docs)
        if copies.filter("clash").limit(1).count():
            raise RuntimeError("suffix deduplication: different texts have equal hashes")
    return docs.drop("other"), copies.drop("clash")


def deduplicate(docs: DataFrame, batch: int = BATCH) -> DataFrame:
    """doc_id, text -> doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs, copies = _identified(docs)
    near = F.broadcast(copies) if copies.count() <= 1_000_000 else copies
    one = docs.join(near.select("rid", "first", F.lit(True).alias("again")), "rid", "left").filter(F.col("again").isNull() | F.col("doc_id").eqNullSafe(F.col("first"))).select("rid", "text")
    spans = repeated_spans(one, batch).unionByName(copies.filter(F.col("bytes") >= LENGTH).select("rid", F.lit(0).cast("long").alias("a"), F.col("bytes").alias("b")))
    small_batches(docs.sparkSession, 512)
    spans = stored(spans.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("x")).mapInArrow(_united, "rid long, spans array<long>"), "spans")
    small_batches(docs.sparkSession, 256)
    return _joined_by_rid(docs, spans, "spans", 8, "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
