"""Secret scans: three base patterns, and novelty measured by dictionary-primed zstandard.

A candidate is a long mixed string near a sensitive word, taken whole however long; the following and preceding lines of
a key are near through it.  Its marginal cost is what a zstandard frame grows by when
the candidate follows its surrounding text, with a dictionary of identifiers as history: fixed words of code, the most
frequent identifiers of the scanned table itself (a bounded list, counted over all documents; words that mix letters
and digits inside aren't learnt, so no secret can be, however often it is copied), and the surrounding text.
Words and identifiers compress against the dictionary; random keys don't.  Names whose digits are all at the end and ids of
the form of a UUID are no candidates; a slash belongs to a candidate only where the run looks like base 64 (all of upper and
lower case and digits, few slashes), so the parts of a path or address are judged each on their own.

Rows: one per document.  A null text is an empty one; an empty text has no span and the digest of the empty string.
Work is linear in a text's length, whatever it holds.  Repeated rows are scanned each on their own, ties of spans go by
kind as listed; other columns of the input are kept as they are unless they clash with a result column, which replaces
them in scan_secrets(); mask_secrets() changes nothing but text and n_chars.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.llm._common import released, small_batches

#: The base kinds in their order, patterns and least lengths (of the group given).
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: The same matches found sooner: a run that is long enough, or a text without any keyword.
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
KEYWORD = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"passw|secret|token|api.?key|credential|bearer|private.?key|auth", re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
#: Between the lines of one key, and its last line.
GAP = re.compile(r"[^A-Za-z0-9]{1,96}", re.ASCII)
TAIL = re.compile(r"""["']?(?:\r?\n|\\(?=n))[\x20\t]*["']?([A-Za-z0-9+/_=-]+)["']?[\x20\t]*(?=\r?\n|\\|\Z)""", re.ASCII)
#: What ordinary code around a candidate looks like: fixed text that primes the compressor.
DICTIONARY = (
    b"import from return class function const let var public private static void string int float bool null None True False "
    b"username password passwd secret token api_key apikey access_key client_id client_secret authorization bearer header "
    b"config settings environment variable default example localhost http https www com org net json xml yaml text html "
    b"abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000 1234567890 xxxxxxxxxxxxxxxx "
    b"get_set_value user_name file_path data_table index_number getElementById toString camelCaseIdentifier snake_case_identifier "
)
CONTEXT, LEAST_NOVELTY = 96, 0.55
LEAST_RUN, SLASH_EVERY = 12, 16
INSIDE = re.compile(r"[0-9].*[A-Za-z]")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Identifiers that are learnt from the table at most, and what one looks like: digits only at its end.
LEARNT, IDENTIFIER = 2048, re.compile(rb"[A-Za-z_]{4,30}[0-9]{0,2}")
#: Words that a task counts before it hands its counts on, and what stands between words.
COUNTED, BETWEEN = 1 << 18, bytes(k if chr(k).isalnum() and k < 128 or k == 95 else 32 for k in range(256))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base kinds, by start and then kind as listed."""
    found = []
    if KEYWORD.search(text):
        _, pattern, group, least = BASE[0]
        found += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in BASE[1][1].finditer(text) if m.end() - m.start() >= BASE[1][3]]
    found += [(m.start(), 2, m.end()) for m in HEX_RUN.finditer(text)]
    found.sort()
    return [(start, end, KINDS[kind]) for start, kind, end in found]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> identifiers with how often they occur, in parts of a bounded number of words."""

    def part() -> pa.RecordBatch:
        found = [(w.decode(), n) for w, n in seen.items() if IDENTIFIER.fullmatch(w)]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["w", "n"])

    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0):
            seen.update((text.as_py() or "").encode("utf-8", "surrogatepass").translate(BETWEEN).split())
            if len(seen) >= COUNTED:
                yield part()
                seen.clear()
    yield part()
    seen.clear()
    released()


def identifiers(docs: DataFrame, most: int = LEARNT) -> bytes:
    """The most frequent identifiers of all texts, rarer ones first (later bytes of a dictionary cost less to name)."""
    words = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "w string, n long")
    top = words.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "w").limit(most).collect()
    return " ".join(r["w"] for r in reversed(top)).encode()


def novelty(before: bytes, candidate: bytes, after: bytes, learnt: bytes = b"") -> float:
    """Bytes that a zstandard frame grows by for the candidate, for each of its bytes."""
    import zstandard

    primed = zstandard.ZstdCompressionDict(learnt + b" " + DICTIONARY + after + b"\n" + before, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False)
    return (len(press.compress(candidate)) - len(press.compress(b""))) / max(1, len(candidate))


def _runs(text: str) -> list[tuple[int, int]]:
    """Where candidates may stand: whole runs, or the parts between slashes of a run that doesn't look like base 64."""
    found = []
    for m in CANDIDATE.finditer(text):
        piece = m[0]
        slashes = piece.count("/")
        mixed = any(c.isdigit() for c in piece) and any(c.isupper() for c in piece) and any(c.islower() for c in piece)
        if not slashes or mixed and slashes <= 1 + len(piece) // SLASH_EVERY:
            found.append(m.span())
            continue
        at = m.start()
        for part in piece.split("/"):
            if len(part) >= LEAST_RUN:
                found.append((at, at + len(part)))
            at += len(part) + 1
    return found


def _near(words: list[int], start: int, end: int) -> bool:
    k = bisect_right(words, start - CONTEXT)
    return k < len(words) and words[k] < end + CONTEXT


def novel_spans(text: str, known: list[tuple[int, int, str]], learnt: bytes = b"") -> list[tuple[int, int, str]]:
    """What no base span covers of the whole candidates that don't compress, in a sensitive context or next to such a one."""
    words = [m.start() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    runs = _runs(text)
    secret: dict[int, bool] = {}

    def judged(k: int) -> bool:
        if k not in secret:
            start, end = runs[k]
            piece = text[start:end]
            secret[k] = bool(INSIDE.search(piece)) and not UUID.fullmatch(piece) and novelty(text[max(0, start - CONTEXT) : start].encode("utf-8", "surrogatepass"), piece.encode(), text[end : end + CONTEXT].encode("utf-8", "surrogatepass"), learnt) >= LEAST_NOVELTY
        return secret[k]

    def adjoin(k: int) -> bool:
        """Whether only punctuation and line ends stand between candidates k and k + 1."""
        return bool(GAP.fullmatch(text, runs[k][1], runs[k + 1][0]))

    held = {k for k, (start, end) in enumerate(runs) if _near(words, start, end) and judged(k)}
    for order, step in ((range(len(runs) - 1), 1), (range(len(runs) - 1, 0, -1), -1)):
        for k in order:
            if k in held and k + step not in held and adjoin(min(k, k + step)) and judged(k + step):
                held.add(k + step)
    spans = [runs[k] for k in sorted(held)]
    for k in held:  # the last line of a key is shorter
        if k - 1 in held and adjoin(k - 1) and k + 1 not in held and (m := TAIL.match(text, runs[k][1])) and m.end(1) - m.start(1) <= runs[k][1] - runs[k][0]:
            spans.append(m.span(1))
    found = []
    begins, reach = [s[0] for s in known], list(accumulate((s[1] for s in known), max))
    for start, end in sorted(spans):
        # Base spans stand by start; those before the first that reaches beyond the candidate's start end before it.
        over = [s for s in known[bisect_right(reach, start) : bisect_left(begins, end)] if s[1] > start]
        at = start
        for low, high, kind in [*over, (end, end, "")]:
            # What stands before an assignment's word is the rest of its name.
            if low > at and kind != "assign":
                found.append((at, low, "novel"))
            at = max(at, high)
    return found


def all_spans(text: str, learnt: bytes = b"") -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    base = base_spans(text)
    more = novel_spans(text, base, learnt)
    return base, sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if more else base


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def masked(text: str, spans: list[tuple[int, int, str]], mask: str = "[SECRET]") -> str:
    """text with every maximal run of overlapping spans replaced by the mask."""
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


RESULT = T.StructType(
    [T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()), T.StructField("n_novel", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("masked_text", T.StringType())]
)


def _scan(with_mask: bool, learnt: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spans, texts = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                base, every = all_spans(text or "", learnt)
                kinds = [s[2] for s in every]
                for k, kind in enumerate(KINDS):
                    counts[k].append(kinds.count(kind))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
                texts.append((masked(text, every) if every and text else text) if with_mask else None)
            made = {f"n_{k}": pa.array(c, pa.int64()) for k, c in zip(KINDS, counts, strict=True)}
            made |= {"base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string()), "masked_text": pa.array(texts, pa.string())}
            keep = [n for n in batch.schema.names if n not in made and (with_mask or n != "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in keep), *made.values()], names=[*keep, *made])
        released()

    return run


def scan_secrets(docs: DataFrame, with_mask: bool = False) -> DataFrame:
    """docs (with a text column) and, for each row, counts by kind, spans, and with_mask the text with secrets masked.

    Without with_mask the text is not sent back from the workers and masked_text is null.
    """
    small_batches(docs.sparkSession)
    made = {f.name for f in RESULT}
    keep = [f for f in docs.schema if f.name not in made and (with_mask or f.name != "text")]
    source = docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name not in made])
    # At most LEARNT words go with every task.
    return source.mapInArrow(_scan(with_mask, identifiers(docs)), T.StructType([*keep, *RESULT]))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """docs with every secret replaced by a mask and n_chars, where there is one, counted again; no document goes."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"), F.col("text").cast("string").alias("text"))
    out = scan_secrets(held, with_mask=True)
    changed = {"text": F.col("masked_text").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("spans") != "", F.char_length("masked_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("held.n_chars"))
    return out.select(*[changed.get(c, F.col("held").getField(c)).alias(c) for c in docs.columns])
