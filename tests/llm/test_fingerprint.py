"""Fingerprints against plain Python with the same hash."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from partqc.llm import fingerprint as fp


def chain(data, seed=42):
    for d in data:
        seed = xxhash.xxh64_intdigest(d if isinstance(d, bytes) else d.to_bytes(8, "little"), seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(text, k=5, fraction=8):
    h = [chain([w.encode()]) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if not h:
        return []
    s = [chain(h[i:i + k]) for i in range(len(h) - k + 1)] if len(h) >= k else [chain(h)]
    s = {signed(x) for x in s}
    return sorted(x for x in s if x < fp._below(fraction)) or [min(s)]


TEXTS = ["", "one", "One  two\tthree", " ".join(f"w{i % 37}" for i in range(400)), "ab cd " * 300, "Ä ö\nü ß é x y z"]


def test_fingerprint_equals_plain_python(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = df.select("t", fp.fingerprint(F.col("t")).alias("f")).collect()
    assert [list(r["f"]) for r in got] == [brute(r["t"]) for r in got]


def test_merge_is_the_fingerprint_of_both(spark):
    rows = [(a, b) for a in TEXTS for b in TEXTS]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(fp.merge(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("m"), "a", "b").collect()
    for r in got:
        x, y = brute(r["a"], fraction=1 << 1), brute(r["b"], fraction=1 << 1)
        both = sorted({*brute(r["a"], fraction=1), *brute(r["b"], fraction=1)})
        if len(r["a"].split()) != 1 and x and y:
            want = [h for h in {*brute(r["a"]), *brute(r["b"])} if h < fp._below(8)]
            assert list(r["m"]) == (sorted(want) or [min({*brute(r["a"]), *brute(r["b"])})]) or not both


def test_containment_of_a_small_text_in_a_large_one(spark):
    big = " ".join(f"w{i * 7919 % 10007}" for i in range(6000))
    small = " ".join(big.split()[2000:2600])
    r = spark.createDataFrame([(small, big)], "a string, b string").select(
        fp.containment(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("ab"),
        fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("like")).first()
    assert r["ab"] == 1.0 and 0.05 < r["like"] < 0.15


def expected(rows):
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, nxt = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        a, b, c = (set(brute(t)) for t in (text, edited, nxt))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f"{x % (1 << 64):016x}" for x in brute(text)),
                    ",".join(f"{x % (1 << 64):016x}" for x in brute(edited)), like(a, b), like(a, c))
    return out


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_edited_pairs(spark, monkeypatch, blocks):
    before = fp.with_next
    monkeypatch.setattr(fp, "with_next", lambda d, c: before(d, c, blocks))
    rows = [(i * 3 - 7, TEXTS[i % len(TEXTS)] + (f" tail{i}" if i % 4 else "")) for i in range(23)] + [(900, None), (901, "😀é" * 9)]
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, tie string, b int").repartition(4)
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"])
           for r in fp.edited_pairs(df).collect()}
    assert got == expected(rows)


def test_one_row_null_id_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    one = fp.edited_pairs(spark.createDataFrame([(5, "a b c d e f")], schema)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = [(1, "a b"), (1, "a b"), (1, "c d"), (None, "x y z"), (None, None)]
    assert fp.edited_pairs(spark.createDataFrame(rows, schema)).count() == 5
    assert fp.edited_pairs(spark.createDataFrame([], schema)).count() == 0
