"""The pipeline on the smallest tables: stages take effect and keep the documents' columns."""

from pyspark.sql import functions as F

import corpus_pipeline
from fraudlens.llm import bpe, line_dedup, line_quality, queries, simhash, winnowing

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    ids = [r.doc_id for r in docs.collect()]
    assert len(set(ids)) == len(ids)
    assert sorted(ids) == sorted(r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect())


def test_the_result_is_clean(spark):
    """What a stage removes is not there after it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    clean = winnowing.clean_documents(simhash.one_of_each(line_dedup.dedup_lines(docs)), items)
    assert winnowing.find_contamination(clean, items).where("size(spans) > 0").count() == 0
    classes = simhash.near_duplicates(clean)
    assert classes.where("doc_id <> component_id").count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.CHECKS) <= set(queries.QUERIES) and bpe and line_quality


def test_awkward_documents_pass_all_stages(spark, tmp_path):
    """Null and empty texts, a null and a shared id, repeated rows, columns named like the stages' own, an empty table."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    clash = {c: F.lit("own") for c in ("kept_text", "doc", "bits", "component_id", "spans", "kept", "h", "ids")}
    some = docs.limit(40).withColumns(clash)
    first = some.limit(1)
    odd = first.withColumn("text", F.lit(None).cast("string")).unionByName(first.withColumn("text", F.lit("")))
    odd = odd.unionByName(first).unionByName(first.withColumn("doc_id", F.lit(None).cast("long")))
    table = some.unionByName(odd)
    for rows in (table, table.limit(0)):
        kept, counts = rows, []
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{rows is table}")
            stage(spark, kept, SMALL).write.parquet(path)
            kept = spark.read.parquet(path)
            counts.append(kept.count())
            if name != "bpe_encoding":
                assert kept.columns == table.columns and kept.where("kept_text <> 'own'").count() == 0
        assert counts == sorted(counts, reverse=True)
        assert (counts[-1] > 0) == (rows is table)
