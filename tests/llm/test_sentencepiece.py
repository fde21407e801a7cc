"""Segmentations against all paths of the lattice, and round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest

from partqc.llm import sentencepiece as S


def small(seed):
    rng = random.Random(seed)
    pieces = {S.MARK, "a", "b", "c", *("".join(rng.choices("abc", k=rng.randint(2, 4))) for _ in range(14)),
              *(S.MARK + "".join(rng.choices("abc", k=rng.randint(1, 3))) for _ in range(6)), S.MARK * 2}
    names = [None] * 256 + sorted(pieces)
    spelt = [bytes([i]) for i in range(256)] + [p.replace(S.MARK, " ").encode() for p in names[256:]]
    scores = np.array([0.0] * 256 + [-rng.uniform(1, 9) for _ in names[256:]])
    return S.Vocabulary(names, scores, list(range(256)), spelt)


def all_paths(lattice, unit):
    edges = lattice.edges(unit)
    out, todo = [], [(0, 0.0, ())]
    while todo:
        at, s, ids = todo.pop()
        if at == len(unit):
            out.append((s, ids))
        else:
            todo += [(j, s + x, ids + p) for j, p, x in edges[at]]
    return sorted(out, reverse=True)


@pytest.mark.parametrize("seed", range(6))
def test_nbest_and_batch_solution_equal_all_paths(seed):
    lattice, rng = S.Lattice(small(seed)), random.Random(seed + 100)
    units = [S.MARK * rng.randint(0, 2) + "".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(40)]
    for u in units + ["aéb", S.OTHER + "a"]:
        want = all_paths(lattice, u)
        got = lattice.nbest(u, 5)
        assert np.allclose([g[0] for g in got], [w[0] for w in want[:5]])
        assert all(any(tuple(ids) == w[1] and abs(s - w[0]) < 1e-9 for w in want) for s, ids in got)
        assert len({tuple(ids) for _, ids in got}) == len(got)
    count, ids, best, loss = lattice.solve(units)
    at = np.cumsum(count) - count
    for i, u in enumerate(units):
        want = all_paths(lattice, u)
        assert abs(best[i] - want[0][0]) < 1e-9
        assert any(tuple(ids[at[i]:at[i] + count[i]]) == w[1] and abs(w[0] - best[i]) < 1e-9 for w in want)
        assert abs(loss[i] - (want[0][0] - want[1][0])) < 1e-9 if len(want) > 1 else np.isinf(loss[i])


def applied(ids, edits):
    out, shift = list(ids), 0
    for e in edits:
        out[e["at"] + shift:e["at"] + shift + e["drop"]] = e["ids"]
        shift += len(e["ids"]) - e["drop"]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_text_nbest_equal_all_paths(seed):
    v, rng = small(seed), random.Random(seed)
    seg = S.Segmenter(v, 4)
    texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 3))) for _ in range(25)]
    got = seg.segment(pa.array(texts))
    for i, t in enumerate(texts):
        want = all_paths(seg.lattice, (" " + t).replace(" ", S.MARK))[:4]
        ids = got["ids"][got["off"][i]:got["off"][i + 1]].tolist()
        assert abs(got["score"][i] - want[0][0]) < 1e-9 and got["good"][i]
        losses = [x["loss"] for x in got["others"][i]]
        assert np.allclose(losses, [want[0][0] - w[0] for w in want[1:]])
        for x in got["others"][i]:
            other = applied(ids, x["edits"])
            assert other != ids and b"".join(v.spelt[p] for p in other).decode() == " " + t
            assert abs(sum(v.scores[p] for p in other) - (got["score"][i] - x["loss"])) < 1e-9


TEXTS = ["", "Hello world", "  two  blanks   end ", "\n", "a\n\n b\r\n\tc", "▁ mark ▁▁x", "😀é漢字\u0000​", "x" * 500, "12,345.67 €" * 20, " ", "\U0010ffff",
         "no-blank" * 40]


def test_round_trip_and_odd_rows(spark):
    rows = [(i, t, "n", i) for i, t in enumerate(TEXTS)] + [(99, None, "n", 1), (None, "null id", "n", 1), (0, "again", "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, row int")
    enc = S.encode(df)
    assert enc.columns == ["doc_id", "row", "ids", "score", "others", "round_trip"]
    got = enc.collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    back = S.decode(enc).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back) == sorted((i or -1 if i is None else i or 0, t or "") if i else (-1, t or "") for i, t, _, _ in rows)
    assert S.encode(df.limit(0)).count() == 0
    one = S.encode(df, n=1).collect()
    assert all(list(r["others"]) == [] for r in one)


def test_best_score_is_that_of_the_whole_lattice():
    v = S.read_vocabulary()
    seg = S.Segmenter(v, 3)
    text = "The quick brown fox\njumps over  the lazy dog's 42 barrels."
    got = seg.segment(pa.array([text]))
    whole = seg.lattice.nbest((" " + text).replace(" ", S.MARK), 3)
    assert abs(got["score"][0] - whole[0][0]) < 1e-6
    assert np.allclose([x["loss"] for x in got["others"][0]], [whole[0][0] - s for s, _ in whole[1:]], atol=1e-6)
