"""Registered queries against their SQL, and the pipeline against its parts."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from lakeops.llm import queries

from ..compare import connect, differences
from . import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) == []


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) < set(entry.queries())


@pytest.mark.parametrize("name", ["op5_compression_bands", "op6_viterbi_counts", "op8_toxicity", "op10_pii_bootstrap"])
def test_other_queries_cover_every_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_stages_pass_on_what_they_keep(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "line_dedup":
            kept = brute.kept_lines(sorted(before.items()))
            assert after == {d: kept[d] for d in after}
        if name == "near_dedup":
            groups = brute.near_groups(sorted(before.items()), 5)
            assert set(after) == {d for d, (_, c) in groups.items() if c == d}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            hits = brute.contamination(sorted(before.items()), items)
            assert set(after) == {d for d in before if not hits[d][1]}
        if name != "mixing":
            assert docs.columns == columns
    assert docs.columns == [*columns, "mix_copy", "mix_key"]
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r["doc_id"], r["mix_copy"], r["text"]) for r in df.collect())
    assert key(whole) == key(docs)
