"""Embedding near-duplicates by sorted projection passes.

Each pass orders the vectors of a label by the concatenated signs of random projections (ties by a hash of the id) and
compares every vector with its neighbours in that order: the order is cut into blocks of BLOCK rows, and a block's rows
are compared with each other and with the next block's, so the window is bounded and every block is as large as any
other, whatever the groups of copies.  Pairs are verified by cosine in double precision and the passes' pairs united.
The last of PASSES is compared with those before it: what both found of all links, in each band of cosines, tells how many
there are; passes with ever wider windows follow until RECALL of them are found.  No sample decides.  Links that are neither in a ball nor equal vectors' are listed, so a dense group that forms no
ball costs the square of its size.

Two things keep large groups whole without comparing all their pairs.  Equal vectors are collapsed to the smallest id
and counted.  And vectors that lie within half the linking angle of one centre are all linked with each other, by the
triangle inequality: such balls are proposed in the blocks of a first pass, joined where their centres nearly meet, and
every member's angle to the common centre is verified; inside a ball links are counted, not listed.

A vector that is null, empty, zero or holds a null or non-finite component, or whose label is null, links with nothing;
so do vectors of different lengths, however long, and rows with a null vec_id, whose component is null.  Rows with equal ids
count as one vector each.  Ties in an order go by a hash of the id.  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm._common import forget, partitions, small_batches, stored
from lodestone.llm.components import components

COSINE, PASSES, BLOCK, BITS = 0.93, 6, 1024, 60
#: Of a vector without a ball, where whole numbers must stay whole.
NO_BALL = -(1 << 63)
#: The share of the links that the passes must find.  QUERIES is no longer read: no sample of vectors decides.
QUERIES, RECALL = 512, 0.999
#: A ball: at least BALL vectors; centres whose cosine is at least MEET are one.
BALL, MEET = 32, math.cos(math.radians(2.5))


def projection(dim: int, turn: int) -> np.ndarray:
    return np.random.default_rng([dim, turn]).normal(size=(dim, BITS))


def _keys(passes: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims = np.array(batch.column(2).to_pylist(), np.int64)
            vectors = batch.column(3).to_pylist()
            for turn in passes:
                keys = np.zeros(len(dims), np.int64)
                for dim in np.unique(dims).tolist():
                    at = np.flatnonzero(dims == dim)
                    p = planes.setdefault((dim, turn), projection(dim, turn))
                    keys[at] = ((np.array([vectors[k] for k in at.tolist()]) @ p) > 0) @ weights
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(dims), turn, np.int32)), pa.array(keys)], names=["id", "label", "dim", "vec", "ball", "turn", "key"])

    return run


def _blocks(rows: DataFrame, passes: range, width: int = 1) -> DataFrame:
    """rows (id, label, dim, vec, ball) in each pass's order, by block and step; every row also follows the `width` blocks before."""
    spark = rows.sparkSession
    small_batches(spark, 2000)
    keyed = rows.select("id", "label", "dim", "vec", F.coalesce("ball", F.lit(NO_BALL)).alias("ball")).mapInArrow(_keys(passes), "id long, label string, dim int, vec array<double>, ball long, turn int, key long")
    order = ["turn", "label", "dim", "key", "tie"]
    keyed = keyed.withColumn("tie", F.xxhash64("id", "turn"))
    placed = stored(keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "order")
    # One row for each partition: where it begins in the whole order.
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n")).collect())
    begins, total = [], 0
    for p, n in counts:
        begins.append((p, total))
        total += n
    table = F.broadcast(spark.createDataFrame(begins or [(0, 0)], "p long, begin long"))
    place = placed.withColumn("p", F.shiftright("at", 33)).join(table, "p").withColumn("place", F.col("begin") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    own = F.floor(F.col("place") / BLOCK).cast("long")
    steps = F.explode(F.sequence(F.lit(1), F.lit(width)))
    sides = F.explode(F.array(F.struct(own.alias("block"), F.lit(True).alias("own")), F.struct((own - F.col("step")).alias("block"), F.lit(False).alias("own"))))
    return place.withColumn("step", steps).select("id", "label", "dim", "vec", "ball", "turn", "place", "step", sides.alias("b")).select("id", "label", "dim", "vec", "ball", "turn", "place", "step", "b.block", "b.own")


def _segments(pdf: pd.DataFrame):
    """The rows of each pass, label and length in a block, in order: unit vectors, and how many are the block's own."""
    pdf = pdf.sort_values("place", ignore_index=True)
    for _, part in pdf.groupby(["turn", "label", "dim"], sort=False):
        own = int(part["own"].sum())
        if own and len(part) > 1:
            x = np.stack(part["vec"].to_numpy()).astype(np.float64)
            yield part, x / np.sqrt((x * x).sum(1, keepdims=True)), own


def _compare(least: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        us, vs, cs = [], [], []
        # A block's own rows are compared with each other in its first step.
        first = bool((pdf["step"] == 1).all())
        for part, x, own in _segments(pdf):
            ids, balls = part["id"].to_numpy(), part["ball"].to_numpy(np.int64)
            for low in range(0, own, 256):
                high = min(own, low + 256)
                cosine = x[low:high] @ x.T
                near = cosine >= least
                near &= np.arange(len(x))[None, :] > (np.arange(low, high)[:, None] if first else own - 1)
                near &= (balls[low:high, None] != balls[None, :]) | (balls[low:high, None] == NO_BALL)
                i, j = np.nonzero(near)
                us.append(ids[low + i])
                vs.append(ids[j])
                cs.append((cosine[i, j] * 100).astype(np.int64))
        u, v, band = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (us, vs, cs))
        return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v), "band": band}).drop_duplicates(["u", "v"])

    return run


def near_pairs(rows: DataFrame, least: float, passes: range, width: int = 1) -> DataFrame:
    """Distinct pairs (u < v) of ids with cosine of at least `least` that stand in one window in some pass, and its hundredths."""
    pairs = _blocks(rows, passes, width).groupBy("block", "step").applyInPandas(_compare(least), "u long, v long, band long")
    return pairs.groupBy("u", "v").agg(F.min("band").alias("band"))  # rounding may differ from block to block


def links_there_are(united: DataFrame) -> tuple[int, float]:
    """How many links united (band, before, now) holds, and an estimate of how many there are, from every link found.

    A pass finds links without regard to what those before it found, so what both found tells what both missed (Chapman's
    estimate).  It's made in each band of cosines and summed up, since links near the bound are found less often.
    """
    known = [F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in (("old", F.col("before")), ("new", F.col("now")), ("both", F.col("before") & F.col("now"))))]
    bands = united.groupBy("band").agg(*known).collect()  # a row for each hundredth of the cosine
    return sum(r["n"] for r in bands), sum((r["old"] + 1) * (r["new"] + 1) / (r["both"] + 1) - 1 for r in bands)


def found_pairs(rows: DataFrame, least: float, passes: int) -> DataFrame:
    """Pairs by passes; then by further ones, each with twice the window, until they hold RECALL of the links that there are.

    The last pass is compared with those before it over the whole table.  A window as wide as the whole order compares
    everything, so this ends.
    """
    n, turn, width = rows.count(), max(1, passes - 1), 1
    pairs = stored(near_pairs(rows, least, range(turn)), "links")
    while True:
        told = [x.select("u", "v", "band", F.lit(old).alias("before"), F.lit(not old).alias("now")) for x, old in ((pairs, True), (near_pairs(rows, least, range(turn, turn + 1), width), False))]
        united = stored(told[0].unionByName(told[1]).groupBy("u", "v").agg(F.min("band").alias("band"), F.bool_or("before").alias("before"), F.bool_or("now").alias("now")), "links")
        forget(pairs)
        found, there = links_there_are(united)
        if width * BLOCK >= n or found >= RECALL * there:
            return united.select("u", "v")
        pairs, turn, width = united, turn + 1, 2 * width


def _propose(half: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for part, x, own in _segments(pdf[pdf["own"]]):
            ids, free = part["id"].to_numpy(), np.ones(own, bool)
            alike = x @ x.T >= 2 * half * half - 1 + 0.03
            degree = alike.sum(1)
            for k in np.argsort(-degree, kind="stable").tolist():
                if degree[k] < BALL:
                    break
                group = alike[k] & free
                if not free[k] or group.sum() < BALL:
                    continue
                centre = x[group].mean(0)
                centre /= np.sqrt((centre * centre).sum())
                members = free & (x @ centre >= half)
                if members.sum() >= BALL:
                    free &= ~members
                    name = int(ids[members].min())
                    out += [(int(i), name, centre.tolist()) for i in ids[members]]
        return pd.DataFrame(out, columns=["id", "local", "centre"])

    return run


def balls(rows: DataFrame, least: float) -> DataFrame:
    """(id, ball): vectors that are all linked with every other of the same ball, named by its smallest id."""
    half = math.cos(math.acos(least) / 2) + 2e-5
    proposed = stored(_blocks(rows, range(1)).groupBy("block").applyInPandas(_propose(half), "id long, local long, centre array<double>"), "balls")
    places = rows.select("id", "label", "dim")
    centres = proposed.filter("id = local").select(F.col("local").alias("id"), F.col("centre").alias("vec")).join(places, "id").withColumn("ball", F.lit(None).cast("long"))
    centres = stored(centres.select("id", "label", "dim", "vec", "ball"), "centres")
    if not centres.limit(1).count():
        return proposed.select("id", F.col("local").alias("ball"))
    joined = components(near_pairs(centres, MEET, range(1, 3)))
    named = centres.join(joined, F.col("id") == F.col("node"), "left").select(F.col("id").alias("local"), F.coalesce("component", "id").alias("whole"), "vec")
    mean = named.select("whole", F.posexplode("vec").alias("k", "x")).groupBy("whole", "k").agg(F.avg(F.col("x").cast("decimal(30,18)")).cast("double").alias("x"))
    mean = mean.groupBy("whole").agg(F.expr("transform(array_sort(collect_list(struct(k, x))), s -> s.x)").alias("c"))
    own = proposed.select("id", "local").join(named.select("local", "whole"), "local").join(mean, "whole").join(rows.select("id", "vec"), "id")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("vec", "c") / F.sqrt(dot("vec", "vec") * dot("c", "c"))
    inside = stored(own.filter(cosine >= half).select("id", "whole"), "inside")
    names = inside.groupBy("whole").agg(F.min("id").alias("ball"))
    return inside.join(names, "whole").select("id", "ball")


def near_duplicates(vectors: DataFrame, least: float = COSINE, passes: int = PASSES) -> DataFrame:
    """vec_id, embedding, label -> vec_id, n_links, component_id, kept: one row per row of vectors."""
    vec = F.col("embedding").cast("array<double>")
    bad = vec.isNull() | (F.size(vec) < 1) | F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(vec, lambda x: x != 0) | F.col("label").isNull() | F.col("vec_id").isNull()
    every = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(~bad, vec).alias("vec"))
    every = every.withColumns({"one": F.xxhash64("label", "vec"), "two": F.sha1(F.to_json(F.struct("label", "vec")))})
    heads = stored(every.filter("vec is not null").groupBy("one", "two").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")).withColumn("dim", F.size("vec")), "heads")
    member = stored(balls(heads.withColumn("ball", F.lit(None).cast("long")), least), "members")
    rows = stored(heads.join(member, "id", "left"), "rows")
    pairs = found_pairs(rows, least, passes)
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    outer = both.join(heads.select(F.col("id").alias("v"), "copies"), "v").groupBy("u").agg(F.sum("copies").alias("outer"))
    inner = rows.filter("ball is not null").groupBy("ball").agg(F.sum("copies").alias("inner"))
    edges = pairs.unionByName(member.select(F.col("id").alias("u"), F.col("ball").alias("v")))
    counted = rows.join(outer, F.col("id") == F.col("u"), "left").join(inner, "ball", "left").join(components(edges), F.col("id") == F.col("node"), "left")
    links = F.coalesce("outer", F.lit(0)) + F.when(F.col("ball").isNotNull(), F.col("inner") - F.col("copies")).otherwise(0) + F.col("copies") - 1
    named = counted.select(F.col("one").alias("h1"), F.col("two").alias("h2"), links.cast("long").alias("n"), F.coalesce("component", "id").alias("c"))
    out = every.select("vec_id", "one", "two", F.col("vec").isNull().alias("alone")).join(named, (F.col("one") == F.col("h1")) & (F.col("two") == F.col("h2")) & ~F.col("alone"), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
