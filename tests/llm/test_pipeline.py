"""Registered queries against their SQL, and the pipeline stage by stage."""

import pytest

import cases
import corpus_pipeline
from check_oracle import duck, run
from wattspan.llm.frames import scratch
from wattspan.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    rows, difference = run(spark, duck(SF), SF, name, QUERIES, ORACLES)
    assert rows > 0 and difference is None, difference


def test_substrings_of_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_suffix_dedup"](spark, SF).collect()}
    assert got == cases.repeated_bytes(docs)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, lambda d: {r.doc_id: r.text for r in d.collect()}
    judged = {r.doc_id: r.kept for r in QUERIES["op5_quality_rules"](spark, SF).collect()}
    before = rows(docs)
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, SF), name)
        frames.append(docs)
    good, lines, near, clean, packed = frames
    assert all(f.columns == columns for f in frames[:-1])
    assert set(rows(good)) == {i for i, k in judged.items() if k}
    want = cases.deduped_lines(sorted(rows(good).items()))
    assert rows(lines) == {i: x[2] for i, x in want.items()}
    groups = cases.near_components(sorted(rows(lines).items()))
    assert set(rows(near)) == {i for i, (_, c) in groups.items() if i == c}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(t in x for x in rows(clean).values() for t in items)
    # What went held most of an item.
    for i in set(rows(near)) - set(rows(clean)):
        assert any(" ".join(t.split()[2:9]) in before[i] for t in items)
    assert {r.doc_id for r in packed.collect()} == set(rows(clean))
    ran = corpus_pipeline.run(spark, SF)
    assert ran.agg({"length": "sum"}).first()[0] == packed.agg({"length": "sum"}).first()[0]
