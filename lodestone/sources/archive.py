"""Archives of published documents: written once, scanned by content, told apart by schema, and merged idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_lines(rows: DataFrame, path: str, run: str) -> None:
    """rows (line, and the column named by `run`) -> one folder of text files for each run; a run that is there is left alone."""
    rows.select("line", run).write.mode("append").partitionBy(run).text(path)


def read_lines(spark: SparkSession, path: str, run: str, kind: str = "string") -> DataFrame:
    return spark.read.schema(f"line string, {run} {kind}").text(path)


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Every file under path by the digest of its bytes: sha, bytes, paths (a repeated content adds only a path)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.sha2("content", 256).alias("sha"), F.col("length").alias("bytes"), "path").groupBy("sha", "bytes").agg(F.count("*").alias("paths"), F.min("path").alias("first_path"))


def dispatch(lines: DataFrame, adapters: dict[str, tuple[str, str]], body: str = "line", most_bytes: int = 32 << 20) -> DataFrame:
    """lines with state, reason and value: each document by the adapter of its schema.

    adapters: schema -> (DDL of its document, expression of its value, from `d`).  accepted; rejected: the adapter finds no value;
    quarantined: too large, not JSON, not an object, holds a number that JSON doesn't know, or of an unknown schema.
    """
    known = F.get_json_object(body, "$.schema")
    whole = F.from_json(F.col(body), "schema string", {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"})
    out = lines.withColumn("_schema", known)
    value, document = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    for schema, (ddl, pick) in adapters.items():
        out = out.withColumn("d", F.when(F.col("_schema") == schema, F.from_json(F.col(body), ddl)))
        out = out.withColumn(f"_v_{len(out.columns)}", F.expr(pick))
        value = F.coalesce(value, F.when(F.col("_schema") == schema, F.col(out.columns[-1])))
        document = F.coalesce(document, F.when(F.col("_schema") == schema, F.lit(True)))
    reason = (
        F.when(F.octet_length(body) > most_bytes, "too_large")
        .when(~F.coalesce(F.trim(body).startswith("{"), F.lit(False)) | whole.isNull() | F.try_parse_json(body).isNull(), "not_json")
        .when(F.col("_schema").isNull(), "no_schema")
        .when(document.isNull(), "unknown_schema")
        .when(value.isNull(), "no_value")
    )
    state = F.when(reason.isNull(), "accepted").when(reason == "no_value", "rejected").otherwise("quarantined")
    return out.select(*lines.columns, F.col("_schema").alias("schema"), state.alias("state"), reason.alias("reason"), F.when(reason.isNull(), value).alias("value"))


def parse_index(lines: DataFrame, on: str, fields: tuple[str, ...] = ("cik", "company", "form", "filed", "file_name"), body: str = "line") -> tuple[DataFrame, DataFrame]:
    """Lines of a pipe-delimited daily index of one day -> filings (a row for each accession, its registrants together) and refused lines with reasons.

    A header, rules of hyphens and empty lines are no records.
    """
    cells = F.split(F.col(body), "\\|")
    rows = lines.filter(~F.lower(F.trim(body)).startswith("cik|") & ~F.col(body).rlike("^[-\\s]*$")).withColumn("c", cells)
    rows = rows.withColumns({n: F.trim(F.get("c", F.lit(k))) for k, n in enumerate(fields)})
    filed, day = F.try_to_date("filed", "yyyyMMdd"), F.lit(on).cast("date")
    accession = F.regexp_extract("file_name", r"([0-9]{10}-[0-9]{2}-[0-9]{6})\.txt$", 1)
    reason = F.when(F.size("c") != len(fields), "field_count").when(~F.col("cik").rlike("^[0-9]{1,10}$"), "bad_identity").when(filed.isNull(), "bad_date").when(filed > day, "future_date").when(accession == "", "no_accession")
    judged = rows.withColumns({"reason": reason, "filed_on": filed, "accession": accession})
    good = judged.filter("reason is null").groupBy("accession", "form", "filed_on").agg(F.array_join(F.array_sort(F.collect_set(F.lpad("cik", 10, "0"))), "+").alias("registrants"), F.count("*").alias("lines"))
    return good, judged.filter("reason is not null").select(body, "reason")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str, replace: bool) -> DataFrame:
    """Rows by key: those there stay and new keys come (insert or ignore), or the new ones win (replace); of new rows of one key the first, or the last, by `order`."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc() if replace else F.col(order)))
    fresh = new.withColumn("_n", n).filter("_n = 1").drop("_n")
    if replace:
        return fresh.unionByName(old.join(fresh.select(*keys), keys, "left_anti"))
    return old.unionByName(fresh.join(old.select(*keys), keys, "left_anti"))


def reimport(stored: DataFrame, incoming: DataFrame, key: str, digest: str) -> DataFrame:
    """What importing again would do to each incoming key: new, same (nothing), conflict (another content of a known key, or two of a new one)."""
    asked = incoming.groupBy(key).agg(F.count_distinct(digest).alias("kinds"), F.min(digest).alias("_new"))
    j = asked.join(stored.select(key, F.col(digest).alias("_old")), key, "left")
    same = (F.col("kinds") == 1) & (F.col("_new") == F.col("_old"))
    return j.select(key, F.when(F.col("kinds") > 1, "conflict").when(F.col("_old").isNull(), "new").when(same, "same").otherwise("conflict").alias("effect"))
