"""Chunk removal against plain Python."""

import hashlib
import random
import re
from collections import Counter

from partqc.llm import linededup


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, divisor=3, alone=16):
    """rows: (id, text), ids distinct; returns (id, kept, lines, removed)."""
    first, texts, out = {}, set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        if t is None:
            out.append((i, None, 0, 0))
            continue
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        w = [len(WORD.findall(x)) for x in lines]
        at = [0] + [j for j in range(1, len(h)) if max(w[j - 1], w[j]) >= alone
                    or (h[j - 1] * 31 + (h[j - 2] if j > 1 else 0)) % divisor == 0] + [len(h)]
        chunks = [(a, b) for a, b in zip(at, at[1:]) if w[a] >= alone or (b - a > 1 and any(w[a:b]))]
        ends = [(0, 0), *chunks, (len(h), len(h))]
        gone = []
        for k, (a, b) in enumerate(chunks):
            c = "\n".join(lines[a:b])
            if c in first:
                gone.append((a, b, *first[c]))
            else:
                first[c] = (lines[ends[k][0]:a][::-1], lines[b:ends[k + 2][1]])
        cut = set(range(len(h))) if t in texts else set()
        texts.update([t] if any(w) else [])
        for k, (a, b, left, right) in enumerate(gone):
            cut.update(range(a, b))
            for j, x in zip(range(a - 1, gone[k - 1][1] - 1 if k else -1, -1), left):
                if lines[j] != x:
                    break
                cut.add(j)
            for j, x in zip(range(b, gone[k + 1][0] if k + 1 < len(gone) else len(h)), right):
                if lines[j] != x:
                    break
                cut.add(j)
        out.append((i, "\n".join(x for j, x in enumerate(lines) if j not in cut), len(h), len(cut)))
    return out


def result(spark, rows):
    df = spark.createDataFrame([(i, t, "k", 7) for i, t in rows], "doc_id long, text string, key string, s int")
    got = linededup.drop_repeated_chunks(df)
    assert got.columns == ["doc_id", "text", "key", "s", "kept_text", "n_lines", "n_removed_lines"]
    return [(r["doc_id"], r["kept_text"], r["n_lines"], r["n_removed_lines"]) for r in got.collect()]


def test_removal_equals_plain_python(spark):
    rng = random.Random(3)
    passages = [[f"line {p} {j}" for j in range(rng.randint(3, 9))] for p in range(6)]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(passages) if rng.random() < 0.6 else [f"own {i} {rng.random()}", "", "common"]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n\n\n"), (104, "é 😀\r\nx\n"), (105, "é 😀\r\nx\n")]
    rows.append((106, "\n".join(["same", "lines", "again"] * 40)))
    rng.shuffle(rows)
    got = result(spark, rows)
    assert sorted(got) == sorted(brute(rows))
    assert sum(r[3] for r in got) > 100


def test_boundaries_return_to_step_after_an_insertion(spark):
    passage = [f"passage line {j}" for j in range(60)]
    rows = [(1, "\n".join(passage)), (2, "\n".join(["new first line", *passage[:20], "inserted", *passage[20:]]))]
    got = dict((r[0], r) for r in result(spark, rows))
    assert got[1][3] == 0 and got[2][3] > 40


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "\n".join(f"l{j}" for j in range(30))
    same = result(spark, [(1, text), (1, text)])
    assert [r[3] for r in same] == [0, 0]
    rows = result(spark, [(None, text), (5, text)])
    assert sorted((r[0] is None, r[3] > 20) for r in rows) == [(False, True), (True, False)]
    assert result(spark, []) == []


def test_passages_and_copies_of_the_table_go(spark):
    """Without the recipe of chunks: what repeats is read off the lines themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null").select("doc_id", "text")
    got = {r["doc_id"]: r for r in linededup.drop_repeated_chunks(docs).collect()}
    seen, texts, spans = set(), set(), set()
    long_lines, copies, passages, fresh = [], [], [], 0
    for i in sorted(got):
        r = got[i]
        lines, kept = r["text"].split("\n"), Counter(r["kept_text"].split("\n"))
        if r["text"] in texts:
            copies.append(r["n_removed_lines"] == r["n_lines"])
        for j, x in enumerate(lines):
            if len(WORD.findall(x)) >= 50 and x in seen:
                long_lines.append(kept[x] == 0)
            three = tuple(lines[j:j + 3])
            if sum(len(WORD.findall(y)) for y in three) >= 50 and three in spans:
                passages.append(all(kept[y] == 0 for y in three if y.strip()))
        fresh += r["n_removed_lines"] and not any(x in seen for x in lines) and len(set(lines)) == len(lines)
        texts.add(r["text"])
        seen.update(lines)
        spans.update(tuple(lines[j:j + 3]) for j in range(len(lines) - 2))
    assert len(long_lines) > 50 and sum(long_lines) >= 0.95 * len(long_lines)
    assert len(copies) > 20 and all(copies)
    assert len(passages) > 50 and sum(passages) >= 0.9 * len(passages)
    assert fresh == 0  # texts without a repeated line lose nothing


def test_hot_chunks_and_long_texts(spark):
    hot = "\n".join(f"shared {j} " + "w " * 20 for j in range(3))
    rows = [(i, f"own {i}\n{hot}\nend {i}") for i in range(9000)]
    rows.append((9000, "\n".join(f"line {j % 700}" for j in range(40_000))))
    got = result(spark, rows)
    assert sorted(got) == sorted(brute(rows))


def test_conditions_on_the_result_stay_above_its_arrays(spark):
    rng = random.Random(5)
    shared = [f"shared {j} " + "w " * 20 for j in range(8)]
    rows = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.5 else f"own {i} {j}" for j in range(12))) for i in range(40)]
    kept = linededup.drop_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string"))
    some = kept.filter("n_removed_lines > 0 AND kept_text LIKE 'own%'")
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (kept, some)]
    assert plans[0].count("transform(") == plans[1].count("transform(") > 0
    want = [r for r in brute(rows) if r[3] > 0 and r[1].startswith("own")]
    assert want and sorted(tuple(r) for r in some.select("doc_id", "kept_text", "n_lines", "n_removed_lines").collect()) == sorted(want)
