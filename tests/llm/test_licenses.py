"""License scan against plain matching of every block and template."""

import random
import re

import pytest

from partqc.llm import licenses

SCHEMA = "doc_id long, text string, id string, label string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def pairs(ws):
    return set(zip(ws, ws[1:]))


def plain(text, templates, phrases, threshold=80):
    ws = words_of(text)
    places = [(i, label) for phrase, label in phrases for i in range(len(ws))
              if ws[i:i + len(phrase.split())] == phrase.split()]
    half = max(len(words_of(t)) for _, t in templates)
    found, score = set(), 0.0
    for lo in range(0, len(ws), half):
        block = pairs(ws[lo:lo + 2 * half])
        for label, t in templates:
            want = pairs(words_of(t))
            if 100 * len(block & want) >= threshold * len(want):
                found.add(label)
                score = max(score, len(block & want) / len(want))
    at = [i for i, _ in places]
    base = {label for _, label in places}
    return (len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | found)), 1.0 if base else score)


def run(spark, texts, **more):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = licenses.scan_licenses(df, **more).drop("matches").orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in got]


def check(spark, texts, templates=None, phrases=None, threshold=80):
    got = run(spark, texts, templates=templates, phrases=phrases, threshold=threshold)
    assert got == [plain(t, templates or licenses.TEMPLATES, phrases or licenses.PHRASES, threshold) for t in texts]
    return got


def test_notices_and_phrases(spark):
    filler = "the of and to work under this any software or license version " * 20
    texts = [
        "Released under the MIT\nLicense.", "mit license mit license", "MITLicense", "mit-license and Apache_license",
        filler + " Licensed under CC BY-NC 4.0. " + filler, "licensed under the gnu general public license version 3",
        filler + licenses.TEMPLATES[0][1] + filler, licenses.TEMPLATES[-4][1].replace("free", "FREE").replace("charge", "cost"),
        "GENERAL PUBLIC\tLICENSE", "général public license", "license mit", "mit", "", None, "\n\n", "mit\x00license",
        "日本語 mit license 日本語 apache license", filler * 100, "x" * 300_000 + " mit license " + "y z " * 50_000,
        "mit license " * 3000,
    ]
    got = check(spark, texts)
    assert got[4][5] == "cc-by-nc" and got[0][5] == "mit" and got[13] == (0, 0, None, None, "", "", 0.0)
    assert got[7][5] == "mit" and 0.8 <= got[7][6] < 1


def test_random_texts_and_templates(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    templates = [(f"l{k}", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 9)))) for k in range(25)]
    texts = []
    for _ in range(150):
        t = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.5:
            t += " " + rng.choice(templates)[1] + " " + rng.choice(vocabulary)
        texts.append(t)
    for threshold in (50, 80, 100):
        check(spark, texts + [texts[3]] * 40, templates=templates, phrases=[("w1 w2 w1", "p"), ("w3", "q")], threshold=threshold)


def test_matches_name_the_block(spark):
    df = spark.createDataFrame([(1, "a " * 200 + "Released under the MIT License." + " b" * 200, "x", "y")], SCHEMA)
    m = licenses.scan_licenses(df).first()["matches"]
    assert {(x["label"], x["containment"]) for x in m} == {("mit", 1.0)}
    assert all(x["first_word"] <= 200 and x["end_word"] >= 205 for x in m)


def test_empty_table_and_bad_parameters(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, ["a"], threshold=0)
    with pytest.raises(ValueError):
        run(spark, ["a"], templates=[("x", "single")])
