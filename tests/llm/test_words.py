"""Vectorised hashing against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from partqc.llm import words

TEXTS = ["", None, "a", "A b  c\td\n e", "  lead and trail \r\n", "x" * 50, "Ünï CODE ünï", "one two three four five six one two three four five",
         " nbsp is no blank", "a b c d"]


def plain_words(t):
    return (t or "").encode().lower().split() if t else []


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_word_hashes_tell_words_apart(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    h, counts = words.word_hashes(pa.array(TEXTS, pa.string()))
    want = [w for t in TEXTS for w in plain_words(t)]
    assert counts.tolist() == [len(plain_words(t)) for t in TEXTS]
    seen = {}
    for w, x in zip(want, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_pieces_do_not_change_hashes(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 40))) for _ in range(50)]
    want = words.word_hashes(pa.array(texts))[0].tolist()
    monkeypatch.setattr(words, "PIECE", 13)
    assert words.word_hashes(pa.array(texts))[0].tolist() == want
    assert words.word_hashes(pa.array(["x", *texts]).slice(1))[0].tolist() == want


def test_shingles():
    col = pa.array(TEXTS, pa.string())
    sets = words.shingles(*words.word_hashes(col), 5)
    for t, s in zip(TEXTS, sets):
        w = plain_words(t)
        want = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(s) == len(want) and (np.diff(s.astype(object)) > 0).all()


def test_code_points_and_gather():
    cps, off = words.code_points(pa.array(["aé", None, "😀b"]))
    assert [chr(c) for c in cps] == ["a", "é", "😀", "b"] and off.tolist() == [0, 2, 2, 4]
    assert words.gather(np.arange(10), np.array([3, 0, 7]), np.array([2, 0, 3])).tolist() == [3, 4, 7, 8, 9]


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * 10] * 9)], names=["id", "text"])
    parts = list(words.slices(batch, "text", 25, 4))
    assert [len(p) for p in parts] == [2, 2, 2, 2, 1]
    assert sum((p.column(0).to_pylist() for p in parts), []) == list(range(9))
