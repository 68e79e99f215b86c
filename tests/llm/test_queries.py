from __future__ import annotations

from collections import Counter

import __spark_entry__ as E
import duckdb
import pytest

import corpus_pipeline
from airledger.llm import decontaminate, pii_crf, quality_rules, queries
from airledger.llm.oracle import ORACLE

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(columns).collect())) == Counter(found.fetchall())


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in E.queries() if q.startswith("op")}
    assert "pipeline" in E.queries()


def test_pipeline_against_its_parts_by_hand(spark):
    from test_byte_bpe import expected, reference
    from test_decontaminate import brute as contaminated
    from test_simhash import brute as grouped

    docs, labels, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in quality_rules.quality_report(docs, labels).collect() if r["kept"]}
    rows = {k: t for k, t in rows.items() if k in kept}
    first = {r[2] for r in grouped(list(rows.items()))}
    rows = {k: t for k, t in rows.items() if k in first}
    clean = {r[0] for r in contaminated(list(rows.items()), [tuple(r) for r in items.collect()]) if not r[5]}
    crf = pii_crf.train(pii_crf.labelled_sentences())
    enc, want = reference(), []
    for k in clean:
        text = rows[k] or ""
        base = pii_crf.base_spans(text)
        want.append(expected(enc, k, pii_crf.masked(text, pii_crf.all_spans(text, base, pii_crf.Decoder(crf).label([text])[0]))))
    got = [tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)
    assert 0 < len(got) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark, edge_docs, no_docs):
    clash = edge_docs.withColumnRenamed("fingerprint", "__kept").withColumnRenamed("n_words", "n_tokens")
    for docs in (edge_docs, clash, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_pipeline_without_labels_and_benchmark(spark, scratch):
    """No cutoffs and no windows: only the base rule and copies take documents away."""
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{SMALL}/{t}.parquet")
        (df if t == "documents" else df.limit(0)).write.parquet(f"{scratch}/{t}.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sound = quality_rules.quality_report(docs, spark.read.parquet(f"{scratch}/labels.parquet")).where("not base_failed").count()
    assert 0 < corpus_pipeline.run(spark, scratch).count() <= sound


def test_masking_and_decontamination_leave_clean_text_alone(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    spans = {r["doc_id"]: r["spans"] for r in pii_crf.pii_report(docs).collect()}
    for r in pii_crf.mask_personal_data(docs).collect():
        assert (r["text"] == before[r["doc_id"]]) == (spans[r["doc_id"]] == "")
    left = decontaminate.decontaminate(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert all(before[r["doc_id"]] == r["text"] for r in left.collect())
