"""Embeddings, n-gram join, suffix deduplication and mixing against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestone.llm import embeddings, mixing, ngram_join, suffix_dedup

WORDS = [a + b + c for a in "bcdfg" for b in "aeiou" for c in ("n", "r", "st", "ll")]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, share, seed):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(max(1, int(len(words) * share))):
        words[r.randrange(len(words))] = r.choice(WORDS).upper()
    return " ".join(words)


def corpus():
    docs, n = [], 0
    for k in range(30):
        docs.append(prose(random.Random(k).randrange(1, 300), k))
    for k in range(40):  # a large group of near copies, and one of exact ones
        docs.append(edited(docs[7] + " " + prose(200, 70), 0.01, 100 + k))
        docs.append(prose(120, 5))
    for k in range(40):  # a passage that many documents share
        docs.append(prose(60, 300 + k) + " " + prose(40, 999) + " " + prose(60, 400 + k))
        docs.append(prose(8, 999) + " " + prose(2, 500 + k))
    rows = [(k, t) for k, t in enumerate(docs)]
    return [*rows, (1000, None), (1001, ""), (1002, "  \t\n"), (1003, "a b"), (1004, "A\tB"), (1005, docs[3].upper()), (7, docs[7]), (1006, "word " * 5000)]


def components(n, pairs):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(k) for k in range(n)]


def test_ngram_join(spark):
    rows = corpus()
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = components(len(rows), pairs)
    least = {}
    for (d, _), c in zip(rows, comp, strict=True):
        least[c] = min(d, least.get(c, d))
    got = ngram_join.similar(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_shingles string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((d, len(s), least[c]) for (d, _), s, c in zip(rows, sets, comp, strict=True))
    assert ngram_join.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_components(rows):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp, least = components(len(rows), pairs), {}
    for (d, _), c in zip(rows, comp, strict=True):
        least[c] = min((x for x in (d, least.get(c)) if x is not None), default=None)
    return sorted(((d, len(s), least[c]) for (d, _), s, c in zip(rows, sets, comp, strict=True)), key=str)


def test_ngram_join_of_copies_of_copies(spark, monkeypatch):
    # Chains of edits: many nodes aren't like their leader, so they must find each other through the index.
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", 2000)
    monkeypatch.setattr(ngram_join, "QUERIES", 8)
    r, rows = random.Random(4), []
    for g in range(3):
        texts = [prose(60 + 40 * g, 900 + g)]
        for k in range(120):
            texts.append(edited(r.choice(texts), r.choice((0.01, 0.02, 0.03)), 5000 + 200 * g + k))
        rows += [(g * 1000 + k, t) for k, t in enumerate(texts)]
    r.shuffle(rows)
    rows += [(None, rows[0][1] + " x"), (None, "nothing like any other text here"), (5, rows[9][1]), (5, "the same id with another text here")]
    got = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute_components(rows)


def test_divide_skip_is_exact():
    r = np.random.default_rng(1)
    query = np.unique(r.integers(0, 400, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate([query[r.random(len(query)) < p], r.integers(400, 900, k).astype(np.uint64)])) for p in (1, 0.95, 0.85, 0.8, 0.5, 0) for k in (1, 10, 30)]
    wanted = [k for k, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 75 * len(np.union1d(query, s))]
    assert ngram_join.divide_skip(query, sets) == wanted


@pytest.mark.parametrize("batch, split", [(300_000, 1000), (200, 20)])
def test_suffix_dedup(spark, monkeypatch, batch, split):
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    rows = [*corpus(), (2000, "ab" * 400), (2001, "é" * 99 + "x"), (2002, "é" * 150), (None, prose(80, 5)), (2003, "n\0" * 150), (2004, "n\0" * 101 + "n")]
    data = [(t or "").encode() for _, t in rows]
    counts = Counter(t[k : k + 200] for t in data for k in range(len(t) - 199))
    wanted = []
    for (d, _), t in zip(rows, data, strict=True):
        hit = bytearray(len(t))
        for k in range(len(t) - 199):
            if counts[t[k : k + 200]] > 1:
                hit[k : k + 200] = b"\1" * 200
        kept = bytes(b for b, h in zip(t, hit, strict=True) if not h)
        runs = sum(1 for k, h in enumerate(hit) if h and not (k and hit[k - 1]))
        wanted.append((d, len(t), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rid string, n_bytes int").repartition(3)
    got = suffix_dedup.deduplicate(docs, batch=batch).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert suffix_dedup.deduplicate(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_dedup_tells_texts_with_one_hash_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    wanted = sorted(map(repr, suffix_dedup.deduplicate(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "_hashes", lambda text: (F.length(text).cast("long") % 3, F.xxhash64(text)))
    assert sorted(map(repr, suffix_dedup.deduplicate(docs).collect())) == wanted


def test_index_family_merges_geometrically():
    family = suffix_dedup.IndexFamily()
    for k in range(5):
        family.insert(np.array(sorted([b"%064d" % k, b"same" * 16, b"%064d" % (200 + k)]), suffix_dedup.HEAD))
    assert [n for n, _ in family.levels] == [4, 1] and [len(h) for _, h in family.levels] == [9, 3]
    assert all((h[1:] > h[:-1]).all() for _, h in family.levels)
    assert family.matches().tolist() == [b"same" * 16]


def test_suffix_ranks_are_lexicographic():
    data = bytes(random.Random(1).choices(b"ab", k=600)) * 2
    rank = suffix_dedup.ranks_to_depth(np.frombuffer(data, np.uint8), 200)
    at = list(range(len(data) - 200))
    assert sorted(at, key=lambda k: (rank[k], k)) == sorted(at, key=lambda k: (data[k : k + 200], k))
    assert all((rank[k] == rank[k + 600]) == (data[k : k + 200] == data[k + 600 : k + 800]) for k in range(400))


def test_embeddings(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(60, 16))
    vectors = [v for v in base] + [base[0] + r.normal(size=16) * 0.05 for _ in range(80)] + [base[1] + r.normal(size=16) * 0.2 for _ in range(20)] + [base[2].copy() for _ in range(5)]
    rows = [(k, [float(x) for x in v], k % 2 if k < 60 else 0) for k, v in enumerate(vectors)]
    odd = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [None] + [1.0] * 15, 0), (905, rows[0][1], None), (906, rows[0][1][:8], 0), (2, rows[2][1], 0)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")).collect()
    usable = rows + [odd[-1], odd[-2]]
    n, pairs = len(usable), []
    for a in range(n):
        for b in range(a):
            if usable[a][2] == usable[b][2] and len(usable[a][1]) == len(usable[b][1]):
                x, y = np.array(usable[a][1]), np.array(usable[b][1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    pairs.append((a, b))
    degree, comp = Counter(k for p in pairs for k in p), components(n, pairs)
    least = {}
    for (d, *_), c in zip(usable, comp, strict=True):
        least[c] = min(d, least.get(c, d))
    wanted = [(u[0], degree[k], least[comp[k]], u[0] == least[comp[k]]) for k, u in enumerate(usable)] + [(o[0], 0, o[0], True) for o in odd[:6]]
    assert sorted(tuple(x) for x in got) == sorted(wanted)
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_embeddings_over_many_blocks(spark, monkeypatch):
    """Recall of links near the bound, in one label of some forty blocks; ids beyond 2**53, a null id and clashing columns."""
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    monkeypatch.setattr(embeddings, "RECALL", 0.95)
    r = np.random.default_rng(11)
    base = r.normal(size=(1200, 32))
    base /= np.sqrt((base * base).sum(1, keepdims=True))
    turned = r.normal(size=(1200, 32))
    turned -= (turned * base).sum(1, keepdims=True) * base
    turned /= np.sqrt((turned * turned).sum(1, keepdims=True))
    x = np.concatenate([base, 0.94 * base + np.sqrt(1 - 0.94**2) * turned])
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    first = 2**60 + 1
    rows = [(first + k, v.tolist(), 0, 5, "x") for k, v in enumerate(x)] + [(None, x[0].tolist(), 0, 5, "x")]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int, ball string")).collect()
    links = {g.vec_id: g.n_links for g in got}
    assert len(got) == 2401 and links.pop(None) == 0 and set(links) == {first + k for k in range(2400)}
    wanted = near.sum(1)
    assert all(links[first + k] <= n for k, n in enumerate(wanted.tolist())) and sum(links.values()) >= 0.9 * wanted.sum()


def test_embeddings_whose_few_links_no_sample_holds(spark, monkeypatch):
    """Forty links among 1280 vectors, two passes in blocks of 8: one vector compared with all others tells nothing of them."""
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    monkeypatch.setattr(embeddings, "QUERIES", 1)
    r = np.random.default_rng(21)
    x = r.normal(size=(1240, 32))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    turned = r.normal(size=(40, 32))
    turned -= (turned * x[:40]).sum(1, keepdims=True) * x[:40]
    turned /= np.sqrt((turned * turned).sum(1, keepdims=True))
    x = np.concatenate([x, 0.935 * x[:40] + np.sqrt(1 - 0.935**2) * turned])
    wanted = (x @ x.T >= 0.93).sum(1) - 1  # 80
    rows = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: g.n_links for g in embeddings.near_duplicates(rows, passes=2).collect()}
    assert wanted.sum() >= 80 and sum(got.values()) >= 0.9 * wanted.sum()
    assert all(got[k] <= n for k, n in enumerate(wanted.tolist()))


def test_embeddings_of_a_dense_group_without_balls(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 32)
    monkeypatch.setattr(embeddings, "QUERIES", 64)
    r = np.random.default_rng(8)
    noise = r.normal(size=(600, 64))
    noise[:, 0] = 0
    x = np.tan(np.radians(13)) * noise / np.sqrt((noise * noise).sum(1, keepdims=True))
    x[:, 0] = 1
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    links = (unit @ unit.T >= 0.93).sum(1) - 1
    rows = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {g.vec_id: g.n_links for g in embeddings.near_duplicates(rows).collect()}
    assert links.mean() > 500 and sum(got.values()) >= 0.995 * links.sum()
    assert all(got[k] <= n for k, n in enumerate(links.tolist()))


def test_mixing(spark):
    rows = [(k, prose(random.Random(k).randrange(0, 60), k) if k % 9 else None, [None, "a", "b", "c", "é", "Z"][k % 6 if k > 40 else 1], 5) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mixing.mix(docs).collect()
    size = {k: len((t or "").split()) for k, t, *_ in rows}
    total = Counter()
    for k, _, s, _ in rows:
        total[s] += size[k]
    order = sorted((s for s in total if s is not None)) + [None]
    weight, capped, whole = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, {}, sum(total.values())
    while True:
        free = [s for s in order if s not in capped]
        share = {s: (whole - sum(capped.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s]]
        if not over:
            break
        capped |= {s: 3 * total[s] for s in over}
    target = share | capped
    assert len(got) == 400
    taken = Counter()
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= max(3, 0.01 * target[s]) for s in order)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    assert mixing.repeated(docs).count() == sum(r.copies for r in got)
    assert {r.taken for r in mixing.repeated(docs).select("taken").collect()} == {5}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_of_repeated_rows_and_long_texts(spark):
    long = "word " * 5000
    rows = [(1, "a b c", "s", 7, 1)] * 50 + [(k, "a b c d", "s", 7, 2) for k in range(300)] + [(None, long, "t", 7, 3), (9, None, None, 7, 4), (9, "", None, 7, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, _size int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and {r._size for r in got} == {1, 2, 3, 4}
    assert len({r.copies for r in got if r.doc_id == 1 and r.source == "s" and r.size == 3}) == 1
    assert all(r.size == 0 and r.taken == 0 and r.copies == 1 for r in got if r.source is None)
    taken = {s: sum(r.taken for r in got if r.source == s) for s in ("s", "t")}
    target = {r.source: r.target for r in got}
    assert abs(taken["s"] - target["s"]) <= 160 and taken["t"] in (0, 5000, 10000, 15000)
    assert {r.size for r in mixing.repeated(docs).select("size").collect()} == {7}
