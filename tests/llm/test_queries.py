"""The registered queries: oracles on sf0.01, contract columns, and the pipeline's stages."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from carryover.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]
SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF01}/{table}.parquet')")
    wanted = con.execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    got = QUERIES[name](spark, SF01).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(wanted.fetchall())


CONTRACT = {
    "op2_inverted_multi_index": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op6_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op7_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op8_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_document_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op12_importance_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op13_tokenizer_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(spark, name):
    kinds = dict(QUERIES[name](spark, SF001).dtypes)
    assert {c: kinds.get(c) for c, _ in (x.split() for x in CONTRACT[name].split(", "))} == dict(x.split() for x in CONTRACT[name].split(", "))


def test_pipeline_stages_keep_the_documents_columns(spark):
    import corpus_pipeline

    first = docs = spark.read.parquet(f"{SF001}/documents.parquet").union(
        spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "1 2 3", "en", "x", 5)], spark.read.parquet(f"{SF001}/documents.parquet").schema)
    )
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF001), name)
        assert docs.columns == first.columns
        counts.append((docs.count(), docs.select("doc_id").distinct().count()))
    identified, deduped, private, mixed = counts
    assert identified == (first.count() - 2,) * 2  # the two without a letter go
    assert deduped[0] == deduped[1] <= identified[0] and private == deduped
    assert mixed[1] == private[1] and mixed[0] >= private[0]  # none is lost, some come twice
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert out.select("doc_id").distinct().count() == mixed[1]
    assert out.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()


def test_the_entry_works_without_this_subpackage():
    code = (
        "import sys\n"
        "sys.modules['carryover.llm'] = None\nsys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert names and not any(n.startswith('op') or n == 'pipeline' for n in names), names\n"
        "assert set(e.oracle_sql()) <= set(names)\n"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=100).returncode == 0
    code = "import __spark_entry__ as e; n = e.queries(); assert 'pipeline' in n and sum(x.startswith('op') for x in n) == 13"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, timeout=100).returncode == 0
