"""Language ID: a bidirectional gated recurrent network over bytes, trained here in numpy by backpropagation through time.

Every byte of a text belongs to one window; in each, one network reads forwards and one backwards, every position gets
log-probabilities of the languages, and a document's are the means over all its positions.  Gates and candidate use
clipped linear functions (and their derivatives in training), which cost less than exponentials.

Training uses a sample of at most PER_LANGUAGE documents of each language and WINDOWS windows of each, spread over its
whole text; the bound is a parameter, and the sample is the same on every run.  Prediction covers all bytes.

A null text, and one without any letter (str.isalpha), is `und` with score 0.  Documents without a known language can be
predicted but not learned from; if nothing can be learned from, every document is `und`.  Repeated rows get equal
predictions; equally probable languages go by their order.  A very long text is read whole, in parts of bounded size.
Input columns named lang_pred or score give way to the result's; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import released, small_batches

WINDOW, HIDDEN, WINDOWS, PER_LANGUAGE, BUCKETS = 96, 8, 8, 768, 256
STEPS, BATCH, RATE = 400, 192, 0.02
WORD_SIGN = re.compile(r"[^\W\d_]")
ROWS_AT_ONCE = 2048


def has_letter(text: str) -> bool:
    """Whether any character is a letter; ½, ² and ① are word characters but aren't."""
    return any(m[0].isalpha() for m in WORD_SIGN.finditer(text))


def held_out(doc_id: F.Column) -> F.Column:
    """Documents that training never sees: crc32 of the id as text, modulo 4, is 2.  A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Network:
    """Weights by name; `f` and `b` for the two directions."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def initial(languages: list[str], seed: int = 8) -> Network:
    rng = np.random.default_rng(seed)
    n, h = len(languages), HIDDEN
    w = {}
    for d in "fb":
        w["gate_in" + d] = rng.normal(0, 0.1, (256, 2 * h)) + 0.5
        w["cand_in" + d] = rng.normal(0, 0.3, (256, h))
        w["gate_h" + d] = rng.normal(0, 0.1, (h, 2 * h))
        w["cand_h" + d] = rng.normal(0, 0.3, (h, h))
        w["out" + d] = rng.normal(0, 0.3, (h, n))
    w["bias"] = np.zeros(n)
    return Network(languages, {k: v.astype(np.float32) for k, v in w.items()})


def states(w: dict, d: str, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """x: (time, batch) bytes -> hidden states (time, batch, hidden), read in the order of x."""
    steps, n = x.shape
    gate_in, cand_in, gate_h, cand_h = (w[k + d] for k in ("gate_in", "cand_in", "gate_h", "cand_h"))
    out = np.empty((steps, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    gates, cand, mixed = np.empty((n, 2 * HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
    for t in range(steps):
        if trace is not None:
            gates, cand, mixed = np.empty_like(gates), np.empty_like(cand), np.empty_like(mixed)
        np.matmul(h, gate_h, out=gates)
        gates += gate_in.take(x[t], axis=0)
        raw_gates = gates.copy() if trace is not None else None
        np.maximum(gates, 0, out=gates)
        np.minimum(gates, 1, out=gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        np.matmul(h, cand_h, out=mixed)
        np.multiply(mixed, r, out=cand)
        cand += cand_in.take(x[t], axis=0)
        raw_cand = cand.copy() if trace is not None else None
        np.maximum(cand, -1, out=cand)
        np.minimum(cand, 1, out=cand)
        if trace is not None:
            trace.append((h, z, r, mixed, cand, raw_gates, raw_cand))
        new = out[t]
        np.subtract(h, cand, out=new)
        new *= z
        new += cand
        h = new
    return out


def backward(w: dict, d: str, x: np.ndarray, trace: list, d_out: np.ndarray) -> dict:
    """Gradients by backpropagation through time; d_out: the loss's gradient by each hidden state."""
    steps = len(trace)
    g = {k + d: np.zeros_like(w[k + d]) for k in ("gate_h", "cand_h")}
    d_gates, d_cands = np.empty((steps, x.shape[1], 2 * HIDDEN), np.float32), np.empty((steps, x.shape[1], HIDDEN), np.float32)
    dh = np.zeros(d_out.shape[1:], np.float32)
    for t in reversed(range(steps)):
        h, z, r, mixed, cand, raw_gates, raw_cand = trace[t]
        dh = dh + d_out[t]
        d_cand = dh * (1 - z) * (np.abs(raw_cand) < 1)
        d_gate = np.concatenate([dh * (h - cand), d_cand * mixed], 1) * ((raw_gates > 0) & (raw_gates < 1))
        d_mixed = d_cand * r
        g["cand_h" + d] += h.T @ d_mixed
        g["gate_h" + d] += h.T @ d_gate
        dh = dh * z + d_mixed @ w["cand_h" + d].T + d_gate @ w["gate_h" + d].T
        d_gates[t], d_cands[t] = d_gate, d_cand
    flat = x.ravel()
    for name, grads in (("gate_in", d_gates), ("cand_in", d_cands)):
        two = grads.reshape(len(flat), -1)
        g[name + d] = np.stack([np.bincount(flat, two[:, c], 256) for c in range(two.shape[1])], 1).astype(np.float32)
    return g


def log_probabilities(w: dict, forwards: np.ndarray, backwards: np.ndarray) -> np.ndarray:
    """(time, batch, language), from both directions' states at each position."""
    logits = forwards @ w["outf"] + backwards @ w["outb"] + w["bias"]
    logits -= logits.max(-1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(-1, keepdims=True))


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = STEPS, seed: int = 8) -> Network:
    """windows: (n, WINDOW) bytes; Adam on the mean cross-entropy of all positions, languages drawn evenly."""
    net, rng = initial(languages, seed), np.random.default_rng(seed)
    w = net.weights
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    groups = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        picked = np.concatenate([rng.choice(g, max(1, BATCH // len(groups))) for g in groups])
        x, y = windows[picked].T, labels[picked]
        trace_f, trace_b = [], []
        hf = states(w, "f", x, trace_f)
        hb = states(w, "b", x[::-1], trace_b)[::-1]
        d = np.exp(log_probabilities(w, hf, hb))
        d[:, np.arange(len(y)), y] -= 1
        d = (d / (x.size / 16)).astype(np.float32)
        g = {"bias": d.sum((0, 1)), "outf": np.einsum("tbh,tbl->hl", hf, d), "outb": np.einsum("tbh,tbl->hl", hb, d)}
        g |= backward(w, "f", x, trace_f, d @ w["outf"].T)
        g |= backward(w, "b", x[::-1], trace_b, (d @ w["outb"].T)[::-1])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (n, WINDOW) over all bytes of all texts, zero-filled; each one's text, and its bytes."""
    sizes = np.array([len(t) for t in texts])
    counts = -(-sizes // WINDOW)
    room = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]]) * WINDOW
    for t, s, n in zip(texts, starts.tolist(), sizes.tolist(), strict=True):
        room[s : s + n] = np.frombuffer(t, np.uint8)
    owner = np.repeat(np.arange(len(texts)), counts)
    within = np.arange(len(owner)) - np.repeat(starts // WINDOW, counts)
    return room.reshape(-1, WINDOW), owner, np.minimum(WINDOW, sizes[owner] - within * WINDOW)


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """(text, language): the mean log-probability over all positions of each text; zeros for an empty one."""
    total = np.zeros((len(texts), len(net.languages)))
    windows, owner, length = cut(texts)
    w = net.weights
    for low in range(0, len(windows), ROWS_AT_ONCE):
        part = slice(low, low + ROWS_AT_ONCE)
        x = np.ascontiguousarray(windows[part].T)
        p = log_probabilities(w, states(w, "f", x), states(w, "b", x[::-1])[::-1])
        p *= (np.arange(WINDOW)[:, None] < length[part])[:, :, None]
        by_window = p.sum(0, dtype=np.float64)
        for k in range(by_window.shape[1]):
            total[:, k] += np.bincount(owner[part], by_window[:, k], len(texts))
    return total / np.maximum(1, [len(t) for t in texts])[:, None]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network from the documents with text and language that are not held out; None without any."""
    known = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    from pyspark.sql import Window

    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))
    order = Window.partitionBy("lang", "bucket").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    chosen = known.select("doc_id", "lang").distinct().select("doc_id", "lang", bucket.alias("bucket")).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= -(-per_language // BUCKETS)).select("doc_id", "lang")
    # At most per_language ids of each language: the size of what is broadcast is bounded.
    pieces = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda k: F.substring(F.col("text"), (F.lit(1) + F.floor(k * F.char_length("text") / WINDOWS)).cast("int"), F.lit(WINDOW)))
    sample = known.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("doc_id", "lang", pieces.alias("pieces"))
    # One text for each id and language, however many rows have them.
    sample = sample.groupBy("doc_id", "lang").agg(F.min("pieces").alias("pieces")).collect()
    sample.sort(key=lambda r: (r["lang"], str(r["doc_id"]), r["pieces"]))
    languages = sorted({r["lang"] for r in sample})
    windows, labels = [], []
    for r in sample:
        for piece in dict.fromkeys(r["pieces"]):
            data = piece.encode("utf-8", "surrogatepass")[:WINDOW]
            if data and has_letter(piece):
                windows.append(np.frombuffer((data * (WINDOW // len(data) + 1))[:WINDOW], np.uint8))
                labels.append(languages.index(r["lang"]))
    if not windows:
        return None
    seen = sorted(set(labels))
    labels = np.searchsorted(seen, labels)
    return fit(np.stack(windows), labels, [languages[k] for k in seen])


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            live = [k for k, t in enumerate(texts) if net is not None and t and has_letter(t)]
            at = 0
            while at < len(live):  # a bounded number of bytes at a time
                to, held = at, 0
                while to < len(live) and (held == 0 or held + len(texts[live[to]]) < 2 << 20):
                    held += len(texts[live[to]])
                    to += 1
                group = live[at:to]
                means = pooled(net, [texts[k].encode("utf-8", "surrogatepass") for k in group])
                p = np.exp(means - means.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                for k, best, row in zip(group, p.argmax(1).tolist(), p, strict=True):
                    names[k], scores[k] = net.languages[best], float(row[best])
                at = to
            keep = [n for n in batch.schema.names if n not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in keep), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])
        released()

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """docs (with a text column), and lang_pred and score for each row."""
    small_batches(docs.sparkSession, 512)
    keep = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return docs.select(*[F.col(f"`{f.name}`") for f in keep]).mapInArrow(_predict(net), T.StructType([*keep, *made]))


def crc_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4
