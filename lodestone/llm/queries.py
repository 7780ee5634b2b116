"""The opN queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, embeddings, extract, fingerprints, langid, mixing, ngram_join, packing, ranked, resample, secrets, suffix_dedup, warc
from lodestone.llm._common import table


def tokenizer_files() -> dict[str, str]:
    """Where the public byte-level vocabulary lies on this machine; callers may pass other paths."""
    import public_tokenizers as P

    return {"json_file": P.path("byte_bpe_50k.json"), "ranks_file": P.path("byte_bpe_50k.tiktoken"), "pattern": P.PATTERN}


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("uri"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    own = warc.page_id
    return warc.round_trip(pages).select(own(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", own(F.col("refers_to")).alias("refers_to"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), net).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), **tokenizer_files()))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return weighed.select("doc_id", "n_features", "weight", "score", "rank")


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_extract, op2_embeddings, op3_mixing, op4_ngram_join, op5_suffix_dedup, op6_warc, op7_secrets, op8_language, op9_packing, op10_fingerprints, op11_decontaminate, op12_resample, op13_ranked)}


#: DuckDB's statement of an operator's whole result, where SQL can express it.
ORACLE = {
    "op6_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
        g AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to FROM g
    """,
}


ORACLE["op4_ngram_join"] = """
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 75 * (a.n + b.n - k)),
    e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
    r(node, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.y FROM r JOIN e ON e.x = r.reach)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
    FROM (SELECT node AS doc_id, min(reach) AS c FROM r GROUP BY node) LEFT JOIN n USING (doc_id)
"""


#: Words of a text in SQL: A-Z in lower case, letters, digits and whatever isn't ASCII.
SQL_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

ORACLE["op11_decontaminate"] = f"""
    WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
    iw AS (SELECT DISTINCT item_id, l, array_to_string(w[s:s + l - 1], ' ') AS k
           FROM (SELECT item_id, w, least(10, len(w)) AS l, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM i WHERE len(w) > 0)),
    dw AS (SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS k
           FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS s FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)),
    h AS (SELECT doc_id, s, l, item_id FROM dw JOIN iw USING (l, k)),
    n AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + l)) AS p FROM h) GROUP BY 1),
    m AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
           sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(n.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


ORACLE["op12_resample"] = f"""
    WITH words AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents UNION ALL SELECT NULL, {SQL_WORDS} FROM benchmark),
    runs AS (SELECT doc_id, len(w) AS n_words, list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM words),
    each AS (SELECT doc_id, unnest(f) AS f FROM runs),
    bits AS (SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS bit FROM range(256) t(k)),
    bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM each)),
    numbers AS (SELECT f, list_transform(range(1, len(h), 2), lambda i: (strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1) AS b FROM bytes),
    crc AS (SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, bit[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM numbers, bits),
    cells AS (SELECT doc_id, bucket, count(*) AS n FROM each JOIN crc USING (f) GROUP BY 1, 2),
    sums AS (SELECT bucket, coalesce(sum(n) FILTER (doc_id IS NOT NULL), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (doc_id IS NULL), 0)::DOUBLE AS t FROM cells GROUP BY 1),
    gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sums) + 10000))))::BIGINT AS g FROM sums),
    weighed AS (SELECT doc_id, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS g FROM cells JOIN gain USING (bucket) WHERE doc_id IS NOT NULL GROUP BY 1),
    hashed AS (SELECT doc_id, n_words, coalesce(n, 0) AS n_features,
                      CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight, sha256('7:' || doc_id)[1:8] AS h
               FROM runs LEFT JOIN weighed USING (doc_id) WHERE doc_id IS NOT NULL),
    noisy AS (SELECT *, list_reduce(list_prepend(0, list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', h[i]) - 1)), lambda a, x: a * 16 + x) AS v FROM hashed),
    scored AS (SELECT *, weight + floor(-1000 * ln(-ln((v + 0.5) / 4294967296)))::BIGINT AS score FROM noisy),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 25 * count(*) OVER () // 100 AS k FROM scored WHERE n_words >= 20)
    SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN r <= k THEN r END::BIGINT AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)
"""

ORACLE["op13_ranked"] = f"""
    WITH tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest({SQL_WORDS}) AS t FROM documents) GROUP BY 1, 2),
    n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
    total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
    m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // terms) AS m FROM n, total),
    w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), total),
    q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({SQL_WORDS}) AS t FROM benchmark) GROUP BY 1, 2),
    s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN w USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY 1, 2)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
