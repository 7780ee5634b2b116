"""Best-fit packing by a grouping genetic algorithm on islands with elite migration.

Documents become token ids (byte-level BPE) and a closing id 0; only longer ones are cut, the first piece taking the
remainder.  A first packing of all pieces is best-fit decreasing over the whole table: which sizes meet in which bins follows
from how many pieces there are of each size, and a piece finds its bin by its rank in the order of sizes.  Whole bins of it
are dealt to groups of a bounded number of pieces.  A group whose bins are as few as its tokens allow rests; every other
one is packed by ISLANDS populations, each a row of a Spark table and a task's work of its own.  An individual is a
packing; fitness is Falkenauer's: fewer bins, then the mean square of their fill.  The first individual is the group's
part of the first packing, the others best-fit of its own and of disturbed orders, so no group ever gets worse.  A
generation crosses two of them: whole well-filled bins of one are injected into the other, bins that hold a piece twice are
dissolved, and the displaced pieces are best-fitted again; a mutation opens a few bins.  A round ends when GENERATIONS in a row
bring nothing better.  After each of MIGRATIONS rounds
the populations are written, and each island's elite individual moves to the next island of its group, where it replaces the worst.
An island rests once its best packing is as good as any can be (all bins full but one).

Between epochs the exactly full bins of a group's best individual stay, and the other bins are dealt anew, whole, to fewer
groups, so what one group could not fill is filled with what others could not place.

A null text is an empty one and is packed as its closing id alone; a null doc_id stays null.  Every row is packed, repeated
rows as pieces of their own, each in a place of its own.  Of equally good packings the earlier found stays; the same
table gives packings of equal quality.  Very long texts are cut into pieces like others.  Extra columns are ignored, and an empty
table packs into no sequence.
"""

from __future__ import annotations

import base64
import struct
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import forget, partitions, released, small_batches, stored

CAPACITY, GROUP = 2048, 512
#: A round of an island goes on until GENERATIONS in a row have brought no better best individual.
ISLANDS, MIGRATIONS, POPULATION, GENERATIONS = 3, 2, 4, 20
CACHE = 120_000
SPECIAL = "<|endoftext|>"
PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "piece", "start", "length", "ids_crc32")])


class Ids(dict):
    """Token ids, as little-endian unsigned 32-bit integers, of texts; pieces between single spaces are kept.

    A token of this vocabulary takes at most the one space before it, so a text without other white space beside a
    space splits there without changing any token.
    """

    def __init__(self, json_file: str, ranks_file: str, pattern: str):
        import re

        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.json_file, self.full = json_file, None
        self.joined = re.compile(r" \s|\s |^ | $|\x00")

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        made = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < CACHE and len(word) < 32:
            self[word] = made
        return made

    def of(self, text: str) -> bytes:
        if SPECIAL in text:  # the library knows this string as one token
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.json_file)
            ids = self.full.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if self.joined.search(text):
            ids = self.encode(text)
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, text.replace(" ", "\x00 ").split("\x00")))


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids with the closing one."""
    data = ids + b"\0\0\0\0"
    n = len(data) // 4
    if n <= capacity:
        return [(0, 0, n, zlib.crc32(data))]
    first = n % capacity or capacity
    edges = [0, *range(first, n + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(data[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


def _tokenize(json_file: str, ranks_file: str, pattern: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokenize.known.get(json_file) or _tokenize.known.setdefault(json_file, Ids(json_file, ranks_file, pattern))
        for batch in batches:
            rows = [(d, *p) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for p in pieces_of(known.of(t), capacity)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], names=PIECES.names)
        released()

    return run


_tokenize.known = {}


def token_pieces(docs: DataFrame, json_file: str, ranks_file: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, text -> PIECES.  The files must be readable at the same path by every executor."""
    small_batches(docs.sparkSession, 256)
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(_tokenize(json_file, ranks_file, pattern, capacity), PIECES)


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Pieces, in the given order, each into the fullest bin that still holds it; existing bins are copied."""
    bins = [list(b) for b in bins or []]
    room = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        s = sizes[i]
        at = bisect_left(room, (s, -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
        else:
            left, k = capacity, len(bins)
            bins.append([i])
        if left > s:
            insort(room, (left - s, k))
    return bins


def best_fit_runs(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int]], int]:
    """Best-fit decreasing of so many pieces of each length, at a cost that depends on the lengths alone.

    Pieces are ranked from the longest.  A run (first rank, pieces a bin, first bin) puts pieces that follow each other into
    bins that do; returned are the runs in order, and the number of bins.
    """
    by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first bin, bins) with so much room
    runs, rank, bins = [], 0, 0
    for size in sorted(counts, reverse=True):
        left, room = counts[size], size
        while left:
            while room <= capacity and not by_room[room]:
                room += 1
            if room > capacity:
                first, n, here = bins, -(-left // (capacity // size)), capacity
                bins += n
            else:
                (first, n), here = by_room[room].pop(), room
            fits = min(here // size, left)
            used = min(n, left // fits)
            runs.append((rank, fits, first))
            rank, left = rank + fits * used, left - fits * used
            by_room[here - fits * size].append((first, used))
            if used < n:
                by_room[here].append((first + used, n - used))
                room = min(room, here)
    return runs, bins


def quality(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, fuller ones (the mean square of the fill)."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def best_possible(sizes: list[int], capacity: int) -> tuple[int, float]:
    """The quality of a packing with every bin full but the last; no packing is better."""
    full, rest = divmod(sum(sizes), capacity)
    n = full + (rest > 0)
    return -n, (full + (rest / capacity) ** 2) / max(1, n)


def crossed(one: list[list[int]], two: list[list[int]], sizes: list[int], capacity: int, rng) -> list[list[int]]:
    """Well-filled bins of one injected into two; what they displace, and what a mutation frees, is best-fitted again, longest first."""
    fill = [sum(sizes[i] for i in b) for b in one]
    fair = sorted(fill)[len(fill) // 2]
    good = [b for b, f in zip(one, fill, strict=True) if f >= fair and rng.random() < 0.5] or [one[max(range(len(one)), key=fill.__getitem__)]]
    taken = {i for b in good for i in b}
    kept, loose = [], []
    for b in two:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            loose += [i for i in b if i not in taken]
    # Mutation: the emptiest of the other bins and a few of any fill are opened, so that their pieces can fill others.
    kept.sort(key=lambda b: -sum(sizes[i] for i in b))
    n = max(1, len(kept) // 20)
    opened = set(range(len(kept) - n, len(kept))) | set(rng.sample(range(len(kept)), min(len(kept), n)))
    loose += [i for k in opened if k >= 0 for i in (kept[k] if k < len(kept) else ())]
    rest, loose = exchanged(good + [b for k, b in enumerate(kept) if k not in opened], loose, sizes, capacity, rng)
    order = sorted(loose, key=lambda i: (-sizes[i] * (1 + 0.1 * rng.random()), i))
    return best_fit(order, sizes, capacity, rest)


def exchanged(bins: list[list[int]], loose: list[int], sizes: list[int], capacity: int, rng, tries: int = 16) -> tuple[list[list[int]], list[int]]:
    """Some bins that aren't full give one or two pieces for one or two larger loose ones that fill them better."""
    bins, loose = list(bins), sorted(loose, key=lambda i: (sizes[i], i))
    room = [k for k, b in enumerate(bins) if sum(sizes[i] for i in b) < capacity]
    for k in rng.sample(room, min(tries, len(room))):
        b, left = bins[k], capacity - sum(sizes[i] for i in bins[k])
        loads = [sizes[i] for i in loose]
        best: tuple[int, tuple, tuple] | None = None
        for out in [*((i,) for i in b[:12]), *((i, j) for x, i in enumerate(b[:12]) for j in b[x + 1 : 12])]:
            least = sum(sizes[i] for i in out)
            x = bisect_right(loads, least + left) - 1
            if x >= 0 and loads[x] > least:
                best = max(best or (0, (), ()), (loads[x] - least, out, (x,)))
            if len(out) == 2:  # two loose pieces, by two pointers
                low, high = 0, len(loads) - 1
                while low < high:
                    gain = loads[low] + loads[high] - least
                    if gain > left:
                        high -= 1
                    else:
                        if gain > 0:
                            best = max(best or (0, (), ()), (gain, out, (low, high)))
                        low += 1
        if best:
            _, out, into = best
            bins[k] = [i for i in b if i not in out] + [loose[x] for x in into]
            loose = sorted([y for x, y in enumerate(loose) if x not in into] + list(out), key=lambda i: (sizes[i], i))
    return bins, loose


def first_packings(sizes: list[int], seed: list[list[int]], capacity: int, rng, population: int) -> list[list[list[int]]]:
    """The bins that came with the pieces, best-fit decreasing, and best-fit of disturbed orders."""
    every = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    alive = [seed, best_fit(every, sizes, capacity)][:population]
    for k in range(1, population - 1):
        jitter = {i: sizes[i] * (1 + 0.15 * k * rng.random()) for i in every}
        alive.append(best_fit(sorted(every, key=lambda i: (-jitter[i], i)), sizes, capacity))
    return alive


def evolve(sizes: list[int], capacity: int, rng, alive: list[list[list[int]]], generations: int = GENERATIONS) -> list[list[list[int]]]:
    """An island's next population, best first: each generation a child of two individuals takes the worst one's place if it is better.

    It ends when no packing can be better, or after so many generations in a row without a better best.
    """
    score = lambda b: quality(b, sizes, capacity)
    scored = sorted(((score(b), -k, b) for k, b in enumerate(alive)), key=lambda x: x[:2], reverse=True)
    most = best_possible(sizes, capacity)
    g, idle = 0, 0
    while idle < generations and scored[0][0] < most and len(scored) > 1:
        before = scored[0][0]
        # The best half is likelier to give its bins.
        one = scored[rng.randrange((len(scored) + 1) // 2)]
        two = rng.choice([x for x in scored if x is not one])
        child = crossed(one[2], two[2], sizes, capacity, rng)
        new = (score(child), -len(alive) - g, child)
        if new[0] > scored[-1][0] and all(new[0] != x[0] for x in scored):
            scored[-1] = new
            scored.sort(key=lambda x: x[:2], reverse=True)
        g, idle = g + 1, 0 if scored[0][0] > before else idle + 1
    return [b for _, _, b in scored]


def as_bins(numbers: list[int]) -> list[list[int]]:
    """The bin number of each piece -> bins."""
    bins: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        bins.setdefault(k, []).append(i)
    return [bins[k] for k in sorted(bins)]


def as_numbers(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


#: A row of it is an island: its group's lengths, its population (bin numbers of all pieces, best first), and the visitor.
STATE = "group long, island int, lengths array<int>, alive array<array<int>>, bins long, fill double, over boolean"


def _island(capacity: int, round_: int, population: int, generations: int):
    """group, island, lengths, seed (at first; the bin of each piece), alive (null at first), visitor (null, or the elite of the neighbour) -> STATE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import random

        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for group, island, lengths, seed, alive, visitor in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rng = random.Random(f"{group} {island} {round_}")
                packings = [as_bins(x) for x in alive] if alive else first_packings(lengths, as_bins(seed), capacity, rng, population)
                if visitor is not None:
                    packings = [*packings[: population - 1], as_bins(visitor)]
                packings = evolve(lengths, capacity, rng, packings, generations)
                best, most = quality(packings[0], lengths, capacity), best_possible(lengths, capacity)
                row = (group, island, lengths, [as_numbers(b, len(lengths)) for b in packings], -best[0], best[1], best >= most)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), pa.int64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["group", "island", "lengths", "alive", "bins", "fill", "over"])

    return run


def best_packings(groups: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, migrations: int = MIGRATIONS, population: int = POPULATION, generations: int = GENERATIONS) -> DataFrame:
    """group, lengths (array<int>), seed (array<long>, the bin of each piece) -> group, numbers: the bin number of each piece in the best individual of all islands."""
    spark = groups.sparkSession
    small_batches(spark, 8)
    nothing = [F.lit(None).cast("array<array<int>>").alias("alive"), F.lit(None).cast("array<int>").alias("visitor")]
    fresh = groups.select("group", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("lengths").cast("array<int>").alias("lengths"), "seed", *nothing)
    spread = fresh.repartition(partitions(spark), "group", "island")
    state = stored(spread.mapInArrow(_island(capacity, 0, population, generations), STATE), "islands")
    for round_ in range(1, migrations + 1):
        # Elites move around the ring of their group's islands; a group in which some packing can't be bettered is done.
        elite = state.select(F.col("group").alias("g"), F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("to"), F.col("alive")[0].alias("visitor"))
        done = state.filter("over").select(F.col("group").alias("ended")).distinct()
        going = state.join(done, F.col("group") == F.col("ended"), "left_anti").join(elite, (F.col("group") == F.col("g")) & (F.col("island") == F.col("to")))
        going = going.select("group", "island", "lengths", F.lit(None).cast("array<bigint>").alias("seed"), "alive", "visitor")
        moved = going.repartition(partitions(spark), "group", "island").mapInArrow(_island(capacity, round_, population, generations), STATE)
        new = stored(moved.unionByName(state.join(done, F.col("group") == F.col("ended"), "left_semi")), "islands")
        forget(state)
        state = new
    best = state.groupBy("group").agg(F.max(F.struct((-F.col("bins")).alias("fewest"), "fill", (-F.col("island")).alias("island"), F.col("alive")[0].alias("numbers"))).alias("x")).select("group", "x.numbers")
    best = stored(best, "best")
    forget(state)
    return best


def _first_bins(before: dict[int, int], runs: list[tuple[int, int, int]], place: int):
    """Rows with, at `place`, the partition (above 33 bits) and place in it of the order by length -> with the bin in its stead."""
    first, fits, bins = (np.array(c, np.int64) for c in (zip(*runs, strict=True) if runs else ((0,), (1,), (0,))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(place).to_numpy()
            rank = np.array([before.get(k, 0) for k in (at >> 33).tolist()], np.int64) + (at & ((1 << 33) - 1))
            k = np.searchsorted(first, rank, "right") - 1
            bin_ = pa.array(bins[k] + (rank - first[k]) // fits[k], pa.int64())
            yield pa.RecordBatch.from_arrays([bin_ if i == place else c for i, c in enumerate(batch.columns)], names=[*batch.schema.names[:place], "bin", *batch.schema.names[place + 1 :]])

    return run


def first_packing(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """PIECES, also row and bin: best-fit decreasing over all of them.  To the driver come a count for each length and one for each partition."""
    spark, names = pieces.sparkSession, PIECES.names
    held = stored(pieces.select(*names, F.monotonically_increasing_id().alias("row")), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}
    order = [F.col("length").desc(), F.col("row")]
    # The id counts a partition's rows from 0 in its low 33 bits; written, so that it stays.
    ranges = held.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    placed = stored(ranges.withColumn("place", F.monotonically_increasing_id()), "ranked")
    forget(held)
    before, total = {}, 0
    for r in sorted(placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n")).collect()):
        before[r["part"]] = total
        total += r["n"]
    runs, _ = best_fit_runs(counts, capacity)
    out = stored(placed.mapInArrow(_first_bins(before, runs, len(names) + 1), T.StructType([*PIECES, T.StructField("row", T.LongType()), T.StructField("bin", T.LongType())])), "first")
    forget(placed)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, epochs: int = 3) -> DataFrame:
    """PIECES -> also sequence_id and offset: each piece once, each sequence gapless from 0 and at most capacity long."""
    names = PIECES.names
    loose, done = first_packing(pieces, capacity), []
    for epoch in range(epochs):
        total = loose.agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.countDistinct("bin").alias("bins")).first()
        last = epoch == epochs - 1 or total["n"] <= group or total["bins"] * capacity - total["tokens"] < capacity
        dealt = loose.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(epoch)), F.lit(max(1, -(-total["n"] // group)))))
        # About `group` elements in each array.
        groups = stored(dealt.groupBy("group").agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("neg"), "row", *names, "bin"))).alias("pieces")), "groups")
        tokens = F.expr("aggregate(pieces, 0L, (a, p) -> a + p.length)")
        settled = F.size(F.array_distinct("pieces.bin")) <= F.ceil(tokens / capacity)
        best = best_packings(groups.filter(~settled).select("group", F.expr("transform(pieces, p -> cast(p.length as int))").alias("lengths"), F.col("pieces.bin").alias("seed")), capacity)
        flat = groups.join(best, "group", "left").select("group", F.posexplode("pieces").alias("k", "p"), "numbers")
        # A settled group's bins keep their numbers, which are smaller than this epoch's.
        own = F.lit((epoch + 1) << 56) + F.col("group") * (1 << 20) + F.expr("get(numbers, k)")
        placed = flat.select("k", *[F.col(f"p.{c}").alias(c) for c in (*names, "row")], F.coalesce(own, F.col("p.bin")).alias("sequence_id"))
        within = Window.partitionBy("sequence_id")
        placed = placed.withColumns({"offset": F.sum("length").over(within.orderBy("k")) - F.col("length"), "filled": F.sum("length").over(within)})
        placed = stored(placed.drop("k"), f"epoch{epoch}")
        for held in (groups, best, loose):
            forget(held)
        full = F.lit(True) if last else F.col("filled") == capacity
        done.append(placed.filter(full).select(*names, "sequence_id", "offset"))
        if last:
            break
        loose = stored(placed.filter(~full).select(*names, "row", F.col("sequence_id").alias("bin")), "loose")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
