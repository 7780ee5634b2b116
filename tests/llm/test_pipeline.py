"""Every stage takes what its predecessor kept and its decisions hold."""

import corpus_pipeline as p


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(10**6, "12345 67890", None, None, 11), (10**6 + 1, None, None, "src1", 0)], docs.schema)
    docs = docs.unionByName(odd)
    seen = {}
    for name, stage in p.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "packed":
            assert out.schema.names == docs.schema.names
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
    ids = lambda n: {r.doc_id for r in seen[n].select("doc_id").collect()}
    assert not {10**6, 10**6 + 1} & ids("language")
    assert ids("near_duplicates") < ids("language") and ids("secret_scan") == ids("near_duplicates") and ids("mixture") <= ids("secret_scan")
    assert seen["secret_scan"].filter("text rlike '[0-9a-f]{24}'").count() == 0
    assert ids("packed") == ids("mixture")


def test_stages_keep_columns_ids_and_empty_tables(spark):
    text = "the quick brown fox jumps over the lazy dog and runs far away from the small red house near a river in spring"
    rows = [(1, text, "en", "a", 9, "x", 1.5), (1, text, "en", "a", 9, "x", 1.5), (1, text + " again it goes on with many other words than before and so it is not alike at all to it", "en", "b", 9, "y", 2.5), (None, text + " x", "en", "a", 9, "z", 3.5), (3, None, "en", "a", 0, "w", 4.5)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, spans string, score double"
    docs = spark.createDataFrame(rows, schema)
    kept = p.near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.spans) for r in kept if r.text) in ([(1, "x"), (1, "y")], [(0, "z"), (1, "y")]) and len(kept) == 3
    assert {r.score for r in p.mixture(spark, docs, "").collect()} <= {1.5, 2.5, 3.5, 4.5}
    assert sorted(r.spans for r in p.secret_scan(spark, docs, "").collect()) == sorted(r[5] for r in rows)
    assert [r.score for r in p.language(spark, docs, "").filter("spans = 'y'").collect()] in ([2.5], [])
    for _, stage in p.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
