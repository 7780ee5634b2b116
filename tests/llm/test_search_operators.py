"""Decontamination, resampling and ranked search against plain Python."""

import glob
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lodestone.llm import decontaminate, ranked, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = [a + b for a in "bcdfg" for b in "aeiou"] + ["Ünü", "É", "é", "日本", "x" * 60, "y" * 90, "7"]


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def prose(n, seed):
    r = random.Random(seed)
    return "".join(r.choice(VOCABULARY) + r.choice([" ", ", ", ".\n", "-", "\t"]) for _ in range(n))


def corpus():
    items = [(k, prose(r, 900 + k)) for k, r in enumerate([25, 14, 10, 9, 4, 1, 40, 12])]
    items += [(8, None), (9, ""), (10, "..."), (11, items[0][1]), (11, items[1][1]), (None, items[2][1]), (12, "nowhere " + items[0][1])]
    docs = [(k, prose(random.Random(k).randrange(0, 400), k)) for k in range(60)]
    for k in range(30):
        cut = words(items[k % 7][1])
        docs.append((100 + k, prose(30, k) + " ".join(cut[k % 3 : max(k % 3 + 1, len(cut) - k % 4)]).upper() + " " + prose(20, 50 + k)))
    docs += [(200, items[0][1] + items[6][1]), (201, items[0][1][40:]), (202, None), (203, ""), (204, " .,"), (100, docs[60][1]), (None, items[6][1]), (205, prose(20_000, 7))]
    return docs, items


def frames(spark, docs, items):
    """With columns whose names clash with the operators' own."""
    d = spark.createDataFrame([(*r, 1, "a", 2.5) for r in docs], "doc_id long, text string, num int, words string, score double").repartition(3)
    return d, spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, phrase int").repartition(2)


def test_decontaminate(spark):
    docs, items = corpus()
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    wanted = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        wanted.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    d, i = frames(spark, docs, items)
    got = [tuple(r) for r in decontaminate.decontaminate(d, i).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    assert sum(x[-1] for x in wanted) > 30 and not all(x[-1] for x in wanted)


def test_decontaminate_shuffles_alike(spark, monkeypatch):
    docs, items = corpus()
    d, i = frames(spark, docs[:70], items)
    wanted = sorted(map(repr, decontaminate.decontaminate(d, i).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert sorted(map(repr, decontaminate.decontaminate(d, i).collect())) == wanted


def test_decontaminate_empty(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    assert decontaminate.decontaminate(d.limit(0), i).count() == 0
    assert {(r.n_hit, r.contaminated) for r in decontaminate.decontaminate(d, i.limit(0)).collect()} == {(0, False)}


@pytest.mark.parametrize("slop", [6, 15])
def test_proximity(spark, slop):
    r = random.Random(slop)
    items = [(k, " ".join(r.sample(VOCABULARY[:25], n))) for k, n in enumerate([3, 4, 2, 1, 12])]
    docs = [(k, prose(r.randrange(0, 60), 3000 + k)) for k in range(40)] + [(99, " ".join(reversed(items[4][1].split()))), (98, None)]
    df = Counter(w for _, t in docs for w in words(t))
    wanted = set()
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9)):
            own = w[k : k + 10]
            rarest = min(range(len(own)), key=lambda j: (df[own[j]], j))
            for doc, t in docs:
                at = words(t)
                for p, x in enumerate(at):
                    if x == own[rarest] and set(own) <= set(at[max(0, p - slop) : p + slop + 1]):
                        wanted.add((doc, str(item), p))
    counts = Counter((d, i) for d, i, _ in wanted)
    d, i = frames(spark, docs, items)
    got = {(x.doc_id, x.item_id): x.n_places for x in decontaminate.near_items(d, i, slop=slop).collect()}
    assert got == dict(counts) and (99, "4") in got


def test_bucket_of_features():
    hasher = resample.Hasher()
    for k in range(40):
        text = prose(k * 3, k)
        w = words(text)
        runs = [*w, *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]
        n, found = hasher.buckets(text)
        assert n == len(w) and Counter(found.tolist()) == Counter(zlib.crc32(f.encode()) % 10_000 for f in runs)


@pytest.mark.parametrize("cells", [1, 3000, resample.BLOCK_CELLS])
def test_resample(spark, cells):
    docs, items = corpus()
    runs = lambda t: [*(w := words(t)), *(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = (Counter(bucket(f) for _, text in rows for f in runs(text)) for rows in (docs, items))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s | t}
    wanted = []
    for doc, text in docs:
        f = runs(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        wanted.append((doc, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in wanted if x[1] >= 20), key=lambda x: (-x[4], math.inf if x[0] is None else x[0]))
    ranks = {}
    for k, x in enumerate(able[: 25 * len(able) // 100]):
        ranks.setdefault(x, []).append(k + 1)
    d, i = frames(spark, docs, items)
    got = [tuple(r) for r in resample.resample(d, i, block_cells=cells).collect()]
    assert sorted(repr(r[:5]) for r in got) == sorted(map(repr, wanted))
    assert {r[5]: r[:5] for r in got if r[5] is not None} == {k: x for x, ks in ranks.items() for k in ks}


def group_rows(blocks):
    """The rows of each row group of a stored table."""
    files = [pq.ParquetFile(f) for f in glob.glob(blocks._stored_path.removeprefix("file://") + "/*.parquet")]
    return [f.metadata.row_group(k).num_rows for f in files for k in range(f.metadata.num_row_groups)]


def test_blocks_of_the_matrix_are_written_and_read_by_few(spark, monkeypatch):
    docs, items = corpus()
    blocks = resample.csr_blocks(frames(spark, docs, items)[0].coalesce(1), block_cells=1)
    assert sum(group_rows(blocks)) == len(docs) and max(group_rows(blocks)) <= resample.GROUP_BLOCKS

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int32()), pa.array([b.num_rows])], names=["bucket", "n"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(resample, "_sums", sizes)
    rows = resample.column_sums(blocks)
    assert rows.sum() == len(docs) and np.flatnonzero(rows).max() <= resample.GROUP_BLOCKS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_resample_empty(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    assert resample.resample(d.limit(0), i).count() == 0
    assert resample.resample(d, i.limit(0)).count() == len(docs)


def scores(docs, items):
    tf = [Counter(words(t)) for _, t in docs]
    n = sum(1 for c in tf if c)
    total = sum(c.total() for c in tf)
    df = Counter(w for c in tf for w in c)
    weight = lambda w: math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
    out = []
    for item, text in items:
        each = []
        for (doc, _), c in zip(docs, tf, strict=True):
            m = 100 - 75 + 75 * c.total() * n // total
            score = sum(weight(w) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if c[w])
            if score > 0:
                each.append((doc, score))
        each.sort(key=lambda x: (-x[1], math.inf if x[0] is None else x[0]))
        out += [(item, k + 1, *x) for k, x in enumerate(each[:10])]
    return out


@pytest.mark.parametrize("terms, queries", [(1, 4), (2000, 100), (ranked.BLOCK_TERMS, ranked.QUERIES)])
def test_ranked(spark, terms, queries):
    docs, items = corpus()
    docs += [(300 + k, docs[60][1]) for k in range(15)]  # equal scores beyond k
    d, i = frames(spark, docs, items)
    got = [tuple(r) for r in ranked.search(d, i, block_terms=terms, queries=queries).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, scores(docs, items)))


def test_blocks_of_the_index_are_written_by_few(spark):
    docs, items = corpus()
    blocks = ranked.term_blocks(frames(spark, docs, items)[0].coalesce(1), block_terms=1)
    index, n = ranked.impact_index(blocks)
    for held in (blocks, index):
        assert sum(group_rows(held)) == n and max(group_rows(held)) <= ranked.GROUP_BLOCKS


def test_ranked_empty(spark):
    docs, items = corpus()
    d, i = frames(spark, docs, items)
    assert ranked.search(d.limit(0), i).count() == 0 and ranked.search(d, i.limit(0)).count() == 0
    assert ranked.search(d.filter("doc_id in (202, 203, 204)"), i).count() == 0


def test_search_stops_early():
    r = np.random.default_rng(1)
    for _ in range(200):
        n, k, lists, ws = int(r.integers(1, 300)), 5, {}, {}
        exact = np.zeros(n, np.int64)
        for t in range(int(r.integers(1, 8))):
            docs = r.permutation(n)[: int(r.integers(1, n + 1))]
            impact = np.sort(r.integers(1, 60, len(docs)))[::-1] ** 2
            stops = np.append(np.flatnonzero(impact[1:] != impact[:-1]) + 1, len(docs))
            lists[t], ws[t] = (impact[stops - 1], stops, docs), int(r.integers(1, 2000))
            exact[docs] += impact * ws[t]
        least = int(r.choice([1, 1000, int(np.sort(exact)[-1])]))
        at, found = ranked.block_top(lists, ws, n, k, least)
        assert (exact[at] == found).all()
        bar = max(least, int(np.sort(exact)[-k]) if n >= k else 1, 1)
        assert set(np.flatnonzero(exact >= bar)) <= set(at.tolist())
