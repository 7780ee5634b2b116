"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the total of all sizes; a target stops at CAP
times its source's size and the excess goes to the others by weight.  That fixed point is found in closed form: in the
order of CAP * size / weight a first part of the sources is capped, and the rest share what is left.

Each document then gets a rate min(CAP, exp(lambda * size / mean size of its source)), the entropy-balanced weights
under the token constraint of its source; lambda is the dual's solution, found by safeguarded Newton steps that run for
all sources at once over counts by source and size.  Sums are decimal, so their order doesn't matter and reruns agree.

Rates become whole copies by running sums over a source's sizes, longest first, so the copies of all sizes up to any one
are right to within half a copy.  What a source's words then miss is made up by one size of each power of two, longest
first, so it ends at about half of the smallest such size.  Within a size, who gets one more copy goes by a hash of id and
text: the smallest hashes do, up to a threshold that is found among the rows of one of BUCKETS ranges of it.  No text is
shuffled: texts meet one row for each source and size, told to all tasks where these are few enough.

A null or wordless text has size 0, and takes 0 words and one copy.  A null source is a source of its own, the last.
Equal rows (same id and text) get equal copies; an empty table gives no rows.  A very long text is a size like others.
Columns of the input stay in mix(), where those with a result column's name give way, and in repeated(), where all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm._common import WORD_PATTERN, forget, stored

#: The weights, which repeat, and the most a target or a document may grow by.
WEIGHTS, CAP = (5, 2, 1), 3
ROUNDS, STEPS_A_ROUND, CLOSE, FAR_OFF = 30, 3, 1e-7, 0.05
BUCKETS, BROADCAST_ROWS = 1024, 1_000_000
RESULT = ("size", "source_size", "target", "copies", "taken")


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _keys() -> dict[str, F.Column]:
    """Source, size, and a hash of 63 bits that orders a size's documents."""
    src = F.when(F.col("source").isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    return {"_src": src, "_size": word_count(F.col("text")), "_h": F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 63) - 1))}


def targets(by_size: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """_src, _size, _n -> one row per source: _src, _total, _mean, _target."""
    sums = by_size.groupBy("_src").agg(F.sum(F.col("_size") * F.col("_n")).alias("_total"), F.sum("_n").alias("_docs"))
    # The windows below have one row per source.
    by_name = Window.orderBy("_src")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sums.withColumn("_w", w).withColumn("_most", F.col("_total") * float(cap))
    by_need = Window.orderBy(F.col("_most") / F.col("_w"), "_src")
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    s = s.withColumns({"_k": F.row_number().over(by_need), "_level": (F.sum("_total").over(every) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / F.sum("_w").over(after)})
    free = F.col("_level") <= F.col("_most") / F.col("_w")
    s = s.withColumn("_share", F.min_by(F.when(free, F.col("_level")), F.when(free, F.col("_k"))).over(every))
    return s.select("_src", "_total", (F.col("_total") / F.greatest(F.col("_docs"), F.lit(1))).alias("_mean"), F.least(F.col("_most"), F.coalesce(F.col("_share") * F.col("_w"), F.col("_most"))).alias("_target"))


def _rate(cap: int) -> F.Column:
    return F.when(F.col("_target") >= F.col("_total") * cap * (1 - 1e-12), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(F.lit(50.0), F.col("_lambda") * F.col("_size") / F.col("_mean")))))


def balance(by_size: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """The dual's solution: wanted with _lambda.  Every round is one job over the counts by source and size."""
    exact = lambda c: F.sum(c.cast("decimal(38,10)")).cast("double")
    at = wanted.withColumns({"_lambda": F.lit(0.0), "_low": F.lit(-60.0), "_high": F.lit(60.0), "_miss": F.lit(1.0)})
    for _ in range(ROUNDS):
        for _ in range(STEPS_A_ROUND):
            terms = by_size.join(at, "_src").withColumn("_r", _rate(cap)).withColumn("_words", F.col("_n") * F.col("_size") * F.col("_r"))
            slope = F.when(F.col("_r") < cap, F.col("_words") * F.col("_size") / F.col("_mean")).otherwise(0.0)
            keys = ["_src", "_total", "_mean", "_target", "_lambda", "_low", "_high"]
            g = terms.groupBy(*keys).agg(exact(F.col("_words")).alias("_got"), exact(slope).alias("_slope"))
            g = g.withColumns({"_low": F.when(F.col("_got") < F.col("_target"), F.col("_lambda")).otherwise(F.col("_low")), "_high": F.when(F.col("_got") > F.col("_target"), F.col("_lambda")).otherwise(F.col("_high"))})
            g = g.withColumn("_miss", F.when((F.col("_total") == 0) | (F.col("_target") >= F.col("_total") * cap * (1 - 1e-12)), 0.0).otherwise(F.abs(F.col("_got") - F.col("_target")) / F.greatest(F.col("_target"), F.lit(1.0))))
            newton = F.col("_lambda") + (F.col("_target") - F.col("_got")) / F.greatest(F.col("_slope"), F.lit(1e-9))
            inside = (newton > F.col("_low")) & (newton < F.col("_high"))
            at = g.withColumn("_lambda", F.when(F.col("_miss") <= CLOSE, F.col("_lambda")).when(inside, newton).otherwise((F.col("_low") + F.col("_high")) / 2)).drop("_got", "_slope")
        at = stored(at, "dual")
        worst = at.agg(F.max("_miss").alias("m")).first()["m"]
        if worst is None or worst <= CLOSE:
            break
    if worst is not None and worst > FAR_OFF:
        raise RuntimeError(f"mixing: a source's words miss their target by {worst:.3f} after {ROUNDS} rounds")
    return at.select("_src", "_total", "_mean", "_target", "_lambda")


def copies_by_size(by_size: DataFrame, solved: DataFrame, cap: int = CAP) -> DataFrame:
    """_src, _size, _n -> also _k, the copies that all documents of this source and size get together."""
    rated = by_size.filter("_size > 0").join(solved, "_src").withColumn("_r", _rate(cap))
    # One row for each size that occurs in the source: as many as sizes, not as documents.
    longest = Window.partitionBy("_src").orderBy(F.col("_size").desc())
    upto = F.round(F.sum((F.col("_n") * F.col("_r")).cast("decimal(38,10)")).over(longest.rowsBetween(Window.unboundedPreceding, 0))).cast("long")
    rounded = rated.withColumn("_upto", upto).withColumn("_k", F.col("_upto") - F.coalesce(F.lag("_upto").over(longest), F.lit(0)))
    rounded = stored(rounded.select("_src", "_size", "_n", "_k", "_target"), "rounded")
    # The size of each power of two with the most documents changes its copies, the longest first.
    power = F.floor(F.log2(F.col("_size"))).cast("int")
    by_power = rounded.groupBy("_src", power.alias("power")).agg(F.max(F.struct("_n", (-F.col("_size")).alias("neg"), "_k")).alias("x"), F.sum(F.col("_k") * F.col("_size")).alias("got"), F.first("_target").alias("target"))
    # At most 63 elements for each source.
    by_source = by_power.groupBy("_src").agg((F.first("target") - F.sum("got")).alias("miss"), F.array_sort(F.collect_list(F.struct("x.neg", F.col("x._n").alias("n"), F.col("x._k").alias("k")))).alias("a"))
    step = f"greatest(-x.k, least({cap} * x.n - x.k, cast(round(acc.miss / -x.neg) as bigint)))"
    changed = F.expr(f"""aggregate(a, named_struct('miss', cast(miss as double), 'ds', cast(array() as array<struct<size:bigint,d:bigint>>)),
        (acc, x) -> named_struct('miss', acc.miss + x.neg * {step}, 'ds', concat(acc.ds, array(named_struct('size', -x.neg, 'd', {step}))))).ds""")
    change = by_source.select("_src", F.explode(changed).alias("x")).select("_src", F.col("x.size").alias("_size"), F.col("x.d").alias("_d"))
    return rounded.join(change, ["_src", "_size"], "left").select("_src", "_size", "_n", (F.col("_k") + F.coalesce("_d", F.lit(0))).alias("_k"))


def seats(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row for each source and size: _each copies for a document, one more where _h is at most _last; _total, _target."""
    light = stored(docs.select(*[c.alias(k) for k, c in _keys().items()]), "light")
    by_size = stored(light.groupBy("_src", "_size").agg(F.count("*").alias("_n")), "sizes")
    wanted = stored(targets(by_size, weights, cap), "targets")
    copies = copies_by_size(by_size, balance(by_size, wanted, cap), cap).select("_src", "_size", "_k")
    whole = by_size.join(copies, ["_src", "_size"], "left").withColumn("_k", F.when(F.col("_size") == 0, F.col("_n")).otherwise(F.coalesce("_k", F.lit(0))))
    whole = stored(whole.select("_src", "_size", F.floor(F.col("_k") / F.col("_n")).cast("long").alias("_each"), F.pmod("_k", "_n").alias("_more")), "copies")
    # Where the hash with rank _more lies: first its range, then the rank among that range's rows.
    bucket = F.shiftright("_h", 63 - (BUCKETS - 1).bit_length()).alias("_b")
    some = whole.filter("_more > 0").select("_src", "_size", "_more")
    counted = light.join(some, ["_src", "_size"]).groupBy("_src", "_size", "_more", bucket).agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy("_src", "_size").orderBy("_b"))  # at most BUCKETS rows
    found = counted.withColumn("_upto", upto).filter("_upto >= _more and _upto - _c < _more").select("_src", "_size", "_b", (F.col("_more") - F.col("_upto") + F.col("_c")).alias("_rank"))
    ranked = light.select("_src", "_size", "_h", bucket).join(found, ["_src", "_size", "_b"]).withColumn("_k", F.row_number().over(Window.partitionBy("_src", "_size", "_b").orderBy("_h")))
    last = ranked.filter("_k = _rank").select("_src", "_size", F.col("_h").alias("_last"))
    out = whole.join(last, ["_src", "_size"], "left").join(wanted.select("_src", "_total", "_target"), "_src")
    out = stored(out.select("_src", "_size", "_each", F.coalesce("_last", F.lit(-1)).cast("long").alias("_last"), "_total", "_target"), "seats")
    for table in (light, by_size, whole):
        forget(table)
    return out


def _seated(docs: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """A struct of docs' columns, and _size, _total, _target and _copies."""
    found = seats(docs, weights, cap)
    near = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(k) for k, c in _keys().items()])
    return rows.join(near, ["_src", "_size"]).select("_row", "_size", "_total", "_target", (F.col("_each") + (F.col("_h") <= F.col("_last")).cast("long")).alias("_copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """docs (doc_id, text, source and any others) without the text, with size, source_size, target, copies and taken for each row."""
    kept = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in (*RESULT, "text")]
    return _seated(docs, weights, cap).select(*kept, F.col("_size").alias("size"), F.col("_total").alias("source_size"), F.col("_target").alias("target"), F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """docs, each row as often as the mix takes it (none at all where that is 0)."""
    again = _seated(docs, weights, cap).select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return again.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
