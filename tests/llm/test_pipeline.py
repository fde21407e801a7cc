"""The pipeline's stages against what each is to do, on the smallest table."""

import math
from collections import Counter

import pytest
from test_jaccard import brute as all_pairs
from test_linededup import brute as chunks
from test_mixing import brute as draws

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, out = tmp_path_factory.mktemp("pipeline"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        stage(spark, out[-1], SF).write.parquet(f"{root}/{name}")
        out.append(spark.read.parquet(f"{root}/{name}"))
    return [(d.columns, d.collect()) for d in out]


def test_names_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "sentencepiece"]
    for columns, rows in steps[1:-1]:
        assert columns == steps[0][0] and rows


def test_quality_keeps_whole_rows_and_most_good_documents(spark, steps):
    mark = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = set(steps[0][1]), set(steps[1][1])
    assert after < before
    good = [r for r in before if mark.get(r["doc_id"]) == 1]
    assert sum(r in after for r in good) > 0.95 * len(good)


def test_line_stage_equals_brute_force(steps):
    want = {i: k for i, k, _, gone in chunks([(r["doc_id"], r["text"]) for r in steps[1][1]]) if not gone or k.strip(" \t\n\r\v\f")}
    assert {r["doc_id"]: r["text"] for r in steps[2][1]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2][1])


def test_near_duplicate_stage_equals_all_pairs(steps):
    groups = all_pairs([(r["doc_id"], r["text"]) for r in steps[2][1]])
    assert {r["doc_id"] for r in steps[3][1]} == {c for _, _, c in groups}


def test_mixing_stage_equals_brute_force(steps):
    want = Counter(d[0] for d in draws([(r["doc_id"], r["source"], r["text"]) for r in steps[3][1]]))
    assert Counter(r["doc_id"] for r in steps[4][1]) == want


def test_last_stage_segments_every_row(steps):
    assert Counter(r["doc_id"] for r in steps[5][1]) == Counter(r["doc_id"] for r in steps[4][1])
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) and math.isfinite(r["score"]) for r in steps[5][1])


def test_run_gives_the_rows_of_the_stages(spark, steps):
    key = lambda r: (r["doc_id"], tuple(r["ids"]))
    assert sorted(map(key, P.run(spark, SF).collect())) == sorted(map(key, steps[5][1]))


def test_an_empty_table_passes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
