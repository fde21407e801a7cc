"""Components of the Jaccard join against all pairs."""

import itertools
import random

import pytest

from partqc.llm import common, jaccard


def brute(rows, k=5, percent=80):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {doc: doc for doc, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if None not in (rows[a][0], rows[b][0]) and x and y and 100 * len(x & y) >= percent * len(x | y):
            u, v = find(rows[a][0]), find(rows[b][0])
            root[max(u, v)] = min(u, v)
    return sorted(((doc, len(sets[i]), None if doc is None else find(doc)) for i, (doc, _) in enumerate(rows)), key=repr)


def corpus(seed, n):
    """Copies, chains of edits, a shared passage, junk and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = [word() for _ in range(25)]
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.45:
            w = rng.choice(out)[1].split()
            for _ in range(rng.choice((0, 1, 1, 2, 4))):
                if w:
                    w[rng.randrange(len(w))] = word()
        elif kind < 0.6:
            w = passage + [word() for _ in range(rng.randint(0, 12))]
        elif kind < 0.7:
            w = [word()] * rng.randint(1, 30)
        else:
            w = [word() for _ in range(rng.randint(0, 60))]
        out.append((i, " ".join(w)))
    rng.shuffle(out)
    return out


def result(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in jaccard.jaccard_components(df, **more).collect()), key=repr)


@pytest.mark.parametrize("seed,common_from", [(1, 24), (2, 3), (3, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, common_from):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 5)
    rows = corpus(seed, 160)
    assert result(spark, rows, common_from=common_from) == brute(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (2, text), (3, None), (4, ""), (5, " \n"), (None, text), (7, "x y"), (8, "X  y"), (9, "other"), (9, text)]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, n long, sig string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=repr)
    assert got == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_connected_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(500, 500)]
    rng.shuffle(edges)
    got = dict((r[0], r[1]) for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
