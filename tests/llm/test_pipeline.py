import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from custbehav.llm import quality, secrets, simhash
from custbehav.llm.common import stored


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf)))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns and kept[-1].count() > 0
    first, rules, dedup, scanned, mixed, pieces = kept
    passed = {r.doc_id for r in quality.quality_report(first).collect() if r.kept}
    assert sorted(r.doc_id for r in rules.collect()) == sorted(passed)
    groups = {r.component_id for r in simhash.near_duplicates(rules).collect()}
    assert sorted(r.doc_id for r in dedup.collect()) == sorted(groups)
    assert sorted(r.doc_id for r in scanned.collect()) == sorted(groups)
    weights = secrets.train(secrets.training_samples(dedup))
    assert secrets.scan(scanned, weights).filter("spans <> ''").count() == 0
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= groups and max(copies.values()) == 2
    packed = collections.Counter()
    for p in pieces.collect():
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(np.frombuffer(p.ids, "<u4")) == p.length
        packed[p.doc_id] += p.length
        packed[p.doc_id, "size"] = p.doc_tokens
    assert all(packed[i] == n * packed[i, "size"] for i, n in copies.items())


def test_queries_of_the_subpackage_are_registered():
    names = set(registry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()}


@pytest.mark.parametrize("number", range(4))
def test_stages_with_odd_rows_and_clashing_names(spark, sf, documents, number):
    """Nulls, blank, long and repeated rows; further columns keep their values whatever they are called."""
    stage = corpus_pipeline.STAGES[number][1]
    names = ("_q", "_c", "_t", "_s", "_mix", "_n", "_copy", "_mark", "_one", "mark", "size", "rate", "root", "fingerprint", "aside_0", "whole")
    more = [F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in names]
    tags = F.create_map(F.lit("of"), F.coalesce(F.col("doc_id"), F.lit(-1))).alias("_map")
    crowded = documents.select("*", *more, tags).repartition(5)
    found = stage(spark, crowded, sf)
    assert found.columns == crowded.columns
    rows = found.collect()
    known = ("doc_id", "text", "lang", "source", "n_chars")
    plain = collections.Counter(tuple(r) for r in stage(spark, documents, sf).collect())
    assert collections.Counter(tuple(r[c] for c in known) for r in rows) == plain and plain
    for row in rows:
        own = "none" if row["doc_id"] is None else str(row["doc_id"])
        assert all(row[name] == f"{name} {own}" for name in names)
        assert row["_map"] == {"of": -1 if row["doc_id"] is None else row["doc_id"]}


def test_a_text_is_judged_once(documents):
    """The filter of the verdict lies above the explode, and the judgement below it only."""
    plan = quality.clean(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") and plan.count("xxhash64") == quality.quality_report(documents)._jdf.queryExecution().executedPlan().toString().count("xxhash64")


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf))
        assert docs.count() == 0


def test_sql_of_the_subpackage(spark, sf):
    from custbehav.llm import oracle, queries
    from tests.compare import difference, duck

    connection = duck(sf)
    for name, sql in oracle.statements().items():
        assert difference(queries.queries()[name](spark, sf), connection, sql) is None
