"""Model scores against plain counting."""

import math
import re
import string
from collections import Counter

import numpy as np

from partqc.llm import lm

ROWS = [(1, "Banana 42 bandana"), (2, "cabbage and bananas"), (3, ""), (4, None), (5, "ZZz éé"), (None, "banana"), (2, "a"), (7, "ab")]


def plain_words(rows, targets, weight):
    split = lambda t: re.findall("[\u4e00-\u9fff]|[^\\W_\u4e00-\u9fff]+|[^\\w\\s]|_", "".join(map(lm.folded, t or "")))
    docs = [(i, split(t)) for i, t in rows]
    kinds = len({w for _, ws in docs for w in ws})

    def model(texts):
        one, two, context = Counter(), Counter(), Counter()
        for ws in texts:
            one.update(ws)
            two.update(zip([None, *ws], ws))
            context.update([None, *ws][:len(ws)])
        n = one.total()
        return lambda v, w: (two[v, w] + weight * (one[w] + 1) / (n + kinds)) / (context[v] + weight)

    out = []
    for at, (i, ws) in enumerate(docs):  # both models without the document itself
        rest = [x for k, x in enumerate(docs) if k != at]
        back, front = model([x for _, x in rest]), model([x for j, x in rest if j in targets])
        x = [math.log2(back(v, w)) - math.log2(front(v, w)) for v, w in zip([None, *ws], ws)]
        out.append((i, len(ws), sum(x) / max(1, len(x))))
    return sorted(out, key=repr)


def test_words_equal_plain_counts_without_a_cut_vocabulary(spark):
    many = "".join(chr(0x4E00 + i) for i in range(300))
    rows = [*ROWS, (8, "жук и кот"), (9, "кот, жук; дом_и 42"), (10, many), (11, many[::-1] + " a\u0301 x"), (12, "Ωμέγα [x@y] = +j")]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, block int, id string").repartition(3)
    targets = spark.createDataFrame([(2,), (5,), (2,), (9,), (11,), (None,), (99,)], "doc_id long")
    plain_rows = [(i, t and t.replace("a\u0301", "\u00e1")) for i, t in rows]
    want = plain_words(plain_rows, {2, 5, 9, 11}, lm.WEIGHT)
    for block in (10, lm.BLOCK):
        got = sorted((tuple(r) for r in lm.word_difference(df, targets, block=block).collect()), key=repr)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=1e-9)


def test_the_query_tells_documents_of_a_minority_script_apart(spark, tmp_path):
    from partqc.llm import queries
    # Words of like length, and more than 47 characters that occur more often.
    rows = [(i, ("кот лежал под лампой " if i % 2 else "дом стоял над речкой ") * 4) for i in range(20)]
    rows += [(100 + i, f"the quick brown fox jumps over the lazy dog 0123456789 {string.punctuation} " * 20) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r["loss_difference"] for r in queries.op7_lm_scoring(spark, str(tmp_path)).collect()}
    assert len(got) == 80 and max(got[i] for i in range(1, 20, 2)) < min(got[i] for i in range(0, 20, 2))


def test_targets_score_lower(spark):
    rows = [(i, ("the cat sat on the mat " if i % 2 else "der hund lag auf dem sofa ") * 4) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    targets = spark.createDataFrame([(i,) for i in range(1, 20, 2)], "doc_id long")
    got = {r["doc_id"]: r["loss_difference"] for r in lm.word_difference(df, targets).collect()}
    assert max(got[i] for i in range(1, 40, 2)) < min(got[i] for i in range(0, 40, 2))
    # Being in the target is worth nothing of itself.
    inside, outside = (np.mean([got[i] for i in ids]) for ids in (range(1, 20, 2), range(21, 40, 2)))
    assert abs(inside - outside) < 0.2


def test_membership_is_no_advantage(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    good = labels.filter("quality = 1")
    targets = good.filter("crc32(cast(cast(doc_id AS string) AS binary)) % 2 = 0")
    scored = lm.word_difference(docs, targets).join(labels, "doc_id", "left").join(
        targets.selectExpr("doc_id", "true AS inside"), "doc_id", "left")
    mean = {(r["quality"], r["inside"]): r["m"] for r in scored.groupBy("quality", "inside").agg(
        {"loss_difference": "avg"}).toDF("quality", "inside", "m").collect()}
    assert abs(mean[1, True] - mean[1, None]) < 0.5
    assert max(mean[1, True], mean[1, None]) < mean[0, None]


def test_words_of_empty_tables_and_no_targets(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert lm.word_difference(df.limit(0), none).count() == 0
    assert sorted(r["n_tokens"] for r in lm.word_difference(df, none).collect()) == [0, 0, 2]
    assert [r["loss_difference"] for r in lm.word_difference(df.filter("doc_id < 3"), none).collect()] == [0, 0]
