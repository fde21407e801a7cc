"""Cross-parsing against plain string search, and held-out accuracy."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from partqc.llm import langid


def plain_phrases(sample, text, stretch):
    n = 0
    for at in range(0, len(text), stretch):
        part = text[at:at + stretch]
        i = 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in sample:
                j += 1
            i = max(i + 1, j - 1)
            n += 1
    return n


@pytest.mark.parametrize("stretch", [5, 64, 256])
def test_phrases_equal_longest_matches(stretch):
    rng = random.Random(2)
    for _ in range(20):
        sample = "".join(rng.choices("abc", k=rng.randint(1, 60)))
        texts = ["".join(rng.choices("abcd", k=rng.randint(0, 150))) for _ in range(6)]
        table = langid.automaton(np.array([ord(c) - 96 for c in sample]), 8)
        s = np.array([ord(c) - 96 for c in "".join(texts)], np.uint8)
        off = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        unknown_alone = [plain_phrases(sample, t, stretch) for t in texts]
        assert langid.phrases(table, s, off, stretch).tolist() == unknown_alone


def test_fold():
    symbol = np.zeros(0x110000, np.uint8)
    for c in "abAB":
        symbol[ord(c)] = 2 + (c in "bB")
    s, off, letters = langid.fold(symbol, *langid.code_points(pa.array([" a  b!", "", None, "--", "AB"])))
    assert s.tolist() == [2, 0, 3, 0, 2, 3] and off.tolist() == [0, 4, 4, 4, 4, 6] and letters.tolist() == [2, 0, 0, 0, 2]


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = {r["doc_id"]: r for r in langid.identify_language(df, sample_chars=30_000).collect()}
    rows = df.select("doc_id", "lang").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(got) == len(rows) and all(got[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_nulls_clashes_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, score double"
    texts = {"en": "the cat and the dog sat on the mat with a hat ", "fr": "le chat et le chien sont sur la table avec un chapeau "}
    rows = [(i, texts[x] * 3, x, 1.0) for i, x in enumerate(["en", "fr"] * 10)]
    rows += [(50, None, "en", 1.0), (51, "", None, 1.0), (52, "123 !?", "fr", 1.0), (None, "the dog", "en", 1.0), (53, "the dog and the hat", None, 1.0),
             (53, "le chien", None, 1.0), (54, "жук", None, None)]
    got = langid.identify_language(spark.createDataFrame(rows, schema)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert by[50] == by[51] == by[52] == ["und"] and sorted(by[53]) == ["en", "fr"] and by[None] == ["en"] and len(got) == len(rows)
    assert by[54] in (["en"], ["fr"])
    assert [r["lang_pred"] for r in langid.identify_language(spark.createDataFrame([(1, "text", None, 1.0)], schema)).collect()] == ["und"]
    assert langid.identify_language(spark.createDataFrame([], schema)).count() == 0


def trained(n, held=False):
    return [i for i in range(10 * n) if (zlib.crc32(str(i).encode()) % 4 == 2) == held][:n]


def test_long_texts_and_small_samples(spark):
    rng = random.Random(5)
    bag = {x: ["".join(rng.choices(a, k=rng.randint(3, 7))) for _ in range(60)] for x, a in (("aa", "abcdefghij"), ("bb", "fghijklmno"), ("cc", "klmnopqrst"))}
    say = lambda x, n: " ".join(rng.choices(bag[x], k=n))
    ids, held = trained(80), trained(30, held=True)
    rows = [(i, say("aa", 1000), "aa") for i in ids[:20]]  # each longer than a sample
    rows += [(i, say("bb", 20), "bb") for i in ids[20:60]] + [(i, say("bb", 30_000), "bb") for i in ids[60:62]]
    rows += [(i, say("cc", 20), "cc") for i in ids[62:79]] + [(ids[79], "ok", "zz")]
    rows += [(i, say("abc"[k % 3] * 2, 30), None) for k, i in enumerate(held)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    parser = langid.learn(df, "doc_id", "text", "lang", 4, 2, 2000)
    assert parser.names == ["aa", "bb", "cc", "zz"] and min(parser.sizes[:2]) >= 1900
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_language(df, sample_chars=2000).collect()}
    assert [got[i] for i in held] == ["abc"[k % 3] * 2 for k in range(len(held))]


def test_every_letter_of_a_sample_is_kept(spark):
    rng = random.Random(6)
    ids, held = trained(160), trained(20, held=True)
    han = [chr(0x4E00 + i) for i in range(400)]
    latin = [chr(97 + i) for i in range(26)] + list("àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþ")
    bag = {x: ["".join(rng.choices(a, k=3)) for _ in range(60)] for x, a in (("aa", latin), ("jj", han[:200]), ("kk", han[200:]))}
    say = lambda x, n: "".join(rng.choices(bag[x], k=n))
    rows = [(i, say(x, 2000 if x == "aa" else 40), x) for k, i in enumerate(ids) for x in [("aa", "aa", "jj", "kk")[k % 4]]]
    rows += [(i, say(("jj", "kk")[k % 2], 30), None) for k, i in enumerate(held)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify_language(df, sample_chars=80_000).collect()}
    assert [got[i] for i in held] == [("jj", "kk")[k % 2] for k in range(len(held))]


def test_sparse_tables_equal_dense_ones():
    rng = np.random.default_rng(1)
    sample, text = rng.integers(2, 30, 500), rng.integers(0, 32, 900)
    off = np.array([0, 0, 300, 900])
    dense, sparse = langid.automaton(sample, 32), langid.automaton(sample, 32, 0)
    assert langid.phrases(sparse, text, off).tolist() == langid.phrases(dense, text, off).tolist()


def test_what_the_driver_gets_is_bounded_by_the_sample(spark, monkeypatch):
    i = trained(1)[0]
    rows = spark.range(100_000).select(F.lit(i).alias("doc_id"), F.lit("en").alias("lang"), F.concat_ws(
        " ", F.lit("of one id"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    same = spark.range(100_000).select(F.lit(i).alias("doc_id"), F.lit("fr").alias("lang"), F.lit("le chat noir").alias("text"))
    got, before = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: got.append(before(self)) or got[-1])
    parser = langid.learn(rows.union(same), "doc_id", "text", "lang", 4, 2, 20_000)
    assert parser.names == ["en", "fr"] and parser.sizes[0] >= 19_900 and parser.sizes[1] == len("le chat noir ")
    assert max(map(len, got)) < 20_000 / 20 * 4


def test_tables_of_too_many_bytes_are_an_error(spark):
    df = spark.createDataFrame([(i, "the cat sat on the mat", "en") for i in trained(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="sample_chars"):
        langid.learn(df, "doc_id", "text", "lang", 4, 2, 2000, most_bytes=100)
