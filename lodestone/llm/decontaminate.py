"""Benchmark decontamination over a positional inverted index, with DataFrame functions only.

The index has one posting for each word of the corpus: term (64 hash bits of the word), num (the document's number) and
pos.  It is written once, in shards of documents, each in the order of its terms, so that a term's list is one run in each
shard and Parquet's statistics skip to it.  Two words of one hash would be taken for one: with 10^5 benchmark words
against 10^10 corpus words the odds of one such pair are about 5 in 100,000, and a match then still needs the other words.

Phrases are answered by intersection of lists adjusted by the words' offsets in the phrase.  Every window of a phrase
names its rarest and its second rarest word by the lengths of their lists.  The rarest words' postings give candidates
(phrase, document, diagonal = position less offset); those whose second rarest word does not stand on the same diagonal
go; the lists of all other words are then read for the documents that are left only.  Maximal runs of words that stand
on one diagonal, of a window's length or more, are the exact matches.  A window with a word that the corpus lacks needs
no list at all.  Proximity asks instead for all words of a window within some positions of its rarest word, in any order.

Nulls: a null text has no words, a null item id counts as one item with the empty name.  Empty texts, items without words
and empty tables give no matches; repeated documents are matched each on its own, repeated phrases once for all items
that hold them; an item id that occurs more than once counts once.  Very long texts are rows of many postings.
Columns of the inputs other than ids and texts are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm._common import forget, stored

#: Fixed value: what a word is, once A-Z is in lower case.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words in a window; a phrase of fewer is one window.
WIDTH = 10
#: A stored table of at most so many rows of a few numbers each, or phrases of so many words in all, is told to all tasks; a larger one is shuffled.
BROADCAST_ROWS = 1_000_000


def words(text: F.Column) -> F.Column:
    plain = F.octet_length(text) == F.char_length(text)  # without other letters lower() changes A-Z only, and is faster
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


@dataclass
class Index:
    """tokens: num, doc_id, n_words, words; postings: term, num, pos."""

    tokens: DataFrame
    postings: DataFrame

    def drop(self) -> None:
        forget(self.postings)
        forget(self.tokens)


def build(docs: DataFrame) -> Index:
    """The index of docs (doc_id, text); documents are numbered by row, so ids may repeat or be null."""
    split = docs.select(F.monotonically_increasing_id().alias("num"), "doc_id", words(F.col("text").cast("string")).alias("words"))
    tokens = stored(split.select("num", "doc_id", F.size("words").cast("long").alias("n_words"), "words"), "tokens")
    each = tokens.select("num", F.posexplode("words").alias("pos", "word"))
    postings = each.select(F.xxhash64("word").alias("term"), "num", "pos").sortWithinPartitions("term", "num", "pos")
    return Index(tokens, stored(postings, "postings"))


def near(df: DataFrame, array: str | None = None, wide: int = 1) -> DataFrame:
    """A stored table, told to all tasks if it is small: by its rows (each as wide as so many plain ones), or by the elements of an array."""
    size = df.agg(F.coalesce(F.sum(F.size(array)), F.lit(0))).first()[0] if array else df.count()
    return F.broadcast(df) if size * wide <= BROADCAST_ROWS else df


def phrases(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """items (item_id, text) -> each different phrase once (phrase, terms), and which items hold it (item, phrase)."""
    held = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.transform(words(F.col("text").cast("string")), lambda w: F.xxhash64(w)).alias("terms"))
    held = stored(held.filter(F.size("terms") > 0), "items")
    different = stored(held.select("terms").distinct().select(F.monotonically_increasing_id().alias("phrase"), "terms"), "phrases")
    return different, held.join(different, "terms").select("item", "phrase").distinct()


def windows(index: Index, different: DataFrame, width: int) -> DataFrame:
    """phrase, first, length, and by length of list the rarest words' offset and term (at, term; at2, term2) of each window all of whose words occur."""
    asked = different.select("phrase", "terms", F.posexplode("terms").alias("at", "term"))
    # Partial counts come first, so a frequent word is no hot key.
    lists = index.postings.groupBy("term").agg(F.count("*").alias("n_postings"))
    counted = asked.join(lists, "term").select("phrase", "at", "term", "n_postings", F.size("terms").alias("size"))
    counted = stored(counted, "counted")
    length = F.least(F.col("size"), F.lit(width))
    firsts = F.sequence(F.greatest(F.col("at") - length + 1, F.lit(0)), F.least(F.col("at"), F.col("size") - length))
    each = counted.withColumn("first", F.explode(firsts)).withColumn("length", length)
    ranked = each.groupBy("phrase", "first", "length").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("n_postings", "at", "term"))).alias("by_list"))
    rare, next_rare = F.col("by_list")[0], F.get(F.col("by_list"), F.lit(1))
    whole = ranked.filter("n = length").select("phrase", "first", "length", rare.at.alias("at"), rare.term.alias("term"), next_rare.at.alias("at2"), next_rare.term.alias("term2"))
    return stored(whole, "windows")


def candidates(index: Index, live: DataFrame) -> DataFrame:
    """phrase, num, diagonal where the rarest and the second rarest word of some window stand in the right places, and the window's range low to high."""
    ends = live.groupBy("phrase", "at", "term", "at2", "term2").agg(F.min("first").alias("low"), F.max(F.col("first") + F.col("length") - 1).alias("high"))
    ends = stored(ends, "anchors")
    rare = stored(ends.select("term").union(ends.filter("term2 is not null").select("term2")).distinct(), "rare")
    lists = stored(index.postings.join(near(rare), "term", "left_semi"), "lists")
    anchors = near(ends)
    first = lists.join(anchors, "term").select("phrase", "num", (F.col("pos") - F.col("at")).alias("diagonal"), "low", "high", "at2", "term2")
    alone = first.filter("at2 is null")
    asked = first.filter("at2 is not null").withColumn("pos", F.col("diagonal") + F.col("at2"))
    there = lists.select(F.col("term").alias("term2"), "num", "pos")
    both = asked.join(there, ["num", "pos", "term2"], "left_semi")
    columns = ["phrase", "num", "diagonal", "low", "high"]
    found = stored(alone.select(columns).union(both.select(columns)).groupBy("phrase", "num", "diagonal").agg(F.min("low").alias("low"), F.max("high").alias("high")), "candidates")
    for used in (lists, rare, ends):
        forget(used)
    return found


def phrase_matches(index: Index, different: DataFrame, width: int = WIDTH) -> DataFrame:
    """Maximal exact matches of a window's length or more, as a stored table: phrase, num, and start and stop (exclusive) in the document's words."""
    live = windows(index, different, width)
    found = candidates(index, live)
    asked = found.join(near(different, "terms"), "phrase").select("phrase", "num", "diagonal", F.size("terms").alias("size"), F.explode(F.transform(F.sequence("low", "high"), lambda j: F.struct(j.alias("at"), F.col("terms")[j].alias("term")))).alias("x"))
    asked = asked.select("phrase", "num", "diagonal", "size", "x.at", "x.term", (F.col("diagonal") + F.col("x.at")).alias("pos"))
    left = stored(found.select("num").distinct(), "left")
    terms = stored(different.select(F.explode("terms").alias("term")).distinct(), "terms")
    lists = index.postings.join(near(left), "num", "left_semi").join(near(terms), "term", "left_semi")
    stands = asked.join(lists, ["num", "pos", "term"])
    # At most as many rows as the phrase has words.
    diagonal = Window.partitionBy("phrase", "num", "diagonal")
    runs = stands.withColumn("run", F.col("at") - F.row_number().over(diagonal.orderBy("at")))
    runs = runs.groupBy("phrase", "num", "diagonal", "run", "size").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("stop"))
    matches = stored(runs.filter(F.col("stop") - F.col("start") >= F.least(F.col("size"), F.lit(width))).select("phrase", "num", "start", "stop"), "matches")
    for used in (live, found, left, terms):
        forget(used)
    return matches


def proximity_matches(index: Index, different: DataFrame, width: int = WIDTH, slop: int = 15) -> DataFrame:
    """phrase, num, first and pos: all words of the phrase's window at first stand within slop positions of pos, where its rarest word is, in any order."""
    live = windows(index, different, width)
    others = live.join(near(different, "terms"), "phrase").select("phrase", "first", "term", F.explode(F.array_distinct(F.slice("terms", F.col("first") + 1, F.col("length")))).alias("other")).filter("other <> term").select("phrase", "first", "other")
    found = index.postings.join(near(live), "term").select("phrase", "first", "num", "pos", "term2", "term")
    size = others.groupBy("phrase", "first").agg(F.count("*").alias("n_others"))

    def beside(asked: DataFrame) -> DataFrame:
        """Those of asked (with other) that stand near it: an equi-join on stretches of slop positions."""
        stretches = asked.withColumn("stretch", F.explode(F.array(*[F.floor(F.col("pos") / slop) + k for k in (-1, 0, 1)])))
        lists = index.postings.select(F.col("term").alias("other"), "num", F.col("pos").alias("place"), F.floor(F.col("pos") / slop).alias("stretch"))
        return stretches.join(lists, ["num", "other", "stretch"]).filter(F.abs(F.col("place") - F.col("pos")) <= slop)

    # The second rarest word first: few candidates are left for the others.
    alone = F.col("term2").isNull() | (F.col("term2") == F.col("term"))
    columns = ["phrase", "first", "num", "pos"]
    paired = beside(found.filter(~alone).withColumn("other", F.col("term2"))).select(columns).distinct()
    some = stored(found.filter(alone).select(columns).union(paired), "paired")
    near_all = beside(some.join(others, ["phrase", "first"])).groupBy(columns).agg(F.countDistinct("other").alias("n"))
    single = some.join(size, ["phrase", "first"], "left_anti")
    return near_all.join(size, ["phrase", "first"]).filter("n = n_others").select(columns).union(single)


def covered(matches: DataFrame) -> DataFrame:
    """num, n_hit: the words of a document that stand in at least one match."""
    spans = matches.select("num", "start", "stop").distinct()
    in_order = Window.partitionBy("num").orderBy("start", "stop")
    upto = F.coalesce(F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    new = spans.withColumn("new", F.greatest(F.col("stop") - F.greatest("start", upto), F.lit(0)))
    return new.groupBy("num").agg(F.sum("new").cast("long").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    index = build(docs)
    different, holders = phrases(items)
    matches = phrase_matches(index, different, width)
    named = matches.select("num", "phrase").distinct().join(holders, "phrase").groupBy("num").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hits = stored(covered(matches).join(named, "num").select("num", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")), "hits")
    n_hit = F.coalesce("n_hit", F.lit(0))
    out = index.tokens.select("num", "doc_id", "n_words").join(near(hits, wide=8), "num", "left")
    out = out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
    out = stored(out, "decontaminated")
    for used in (matches, hits):
        forget(used)
    index.drop()
    return out


def near_items(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 15) -> DataFrame:
    """Documents and items with a window of the item's words close together: doc_id, item_id (as text), n_places (of the windows' rarest words)."""
    index = build(docs)
    different, holders = phrases(items)
    places = proximity_matches(index, different, width, slop).select("phrase", "num", "pos").distinct()
    by_item = places.join(holders, "phrase").groupBy("num", "item").agg(F.countDistinct("pos").alias("n_places"))
    out = stored(by_item.join(index.tokens.select("num", "doc_id"), "num").select("doc_id", F.col("item").alias("item_id"), "n_places"), "near_items")
    index.drop()
    return out
