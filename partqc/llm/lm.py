"""Cross-entropy difference of two n-gram models (target and background).

A word is a run of letters, marks
and digits (lower case, digits as 0); a sign, and a letter of a script written
without blanks, is a word of its own.  Words and pairs of neighbours are counted
over all documents (background) and over the target documents; nothing is cut or
merged: every word of the corpus is in the one vocabulary, so the tables grow
with it.  The probability of a word backs off from the pair to the word:

    p(w | v) = (c(vw) + m p(w)) / (c(v) + m),    p(w) = (c(w) + 1) / (N + V)

(v: the word before or the text's beginning, V: distinct words of all documents).
Documents are dealt into blocks of about ``BLOCK`` characters.  A block asks for
its distinct words, contexts and pairs (64-bit hashes, no table of strings) in
packs by range of hash; every range sums the packs of all blocks and answers each;
a block's documents are scored with its answers.  There are ``RANGES`` ranges for
the root of the number of blocks, so packs grow as the input to the power 1.5 and
their numbers in proportion.  Nothing is broadcast; the
driver gets N and V.  Blocks come from the hashes of id and text: rows that
repeat an id are spread over ``SPREAD`` blocks by text.

Every document is scored without itself: its own counts are taken out of the
background's, and out of the target's if it is a target document, before the
logarithms.  So a score says what the rest of the corpus says of a text, and
target documents and equally good ones left out score alike.  (V stays that of
all documents.)  The score is the mean over its words of the target's loss less
the background's, in bits: the lower, the closer to the target.

Nulls and oddities: a null or empty text has no tokens and score 0; without
target documents every score is 0 less what smoothing says; ids may repeat (a
target id marks all its rows); a null id is never a target; other columns pass
through unused; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.llm.common import materialize, scratch
from partqc.llm.words import R, U, _powers, code_points, mix, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHT = 4.0
BLOCK = 4_000_000
SPREAD = 16
#: Ranges of hash per root of the number of blocks.
RANGES = 16
#: Scripts written without blanks: first and last code points.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
#: Marks a target's id among the answers.
_TARGET = 9
_GOLD, _BEGIN, _CONTEXT, _PAIR = U(0x9E3779B97F4A7C15), U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179), U(0xA54FF53A5F1D36F1)


def folded(ch: str) -> str:
    low = ch.lower()
    return "0" if ch.isdigit() else low if len(low) == 1 else ch


def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the folded one, and 0 (blank), 1 (part of a word) or 2 (a
    word of its own)."""
    fold = np.fromiter((ord(folded(chr(i))) for i in range(0x110000)), np.uint32, 0x110000)
    kind = np.fromiter((1 if (c := unicodedata.category(chr(i)))[0] in "LMN" else 0 if c[0] in "ZC" else 2
                        for i in range(0x110000)), np.uint8, 0x110000)
    for lo, hi in UNSPACED:
        kind[lo:hi + 1][kind[lo:hi + 1] == 1] = 2
    return fold, kind


def words(tables: tuple, col) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, offsets of the rows in them)."""
    fold, kinds = tables
    cps, off = code_points(col)
    kind = kinds[cps]
    inner = np.zeros(len(cps) + 1, bool)  # the character goes on with the word before it
    inner[1:-1] = (kind[1:] == 1) & (kind[:-1] == 1)
    inner[off] = False
    start = np.flatnonzero((kind != 0) & ~inner[:-1])
    end = np.flatnonzero((kind != 0) & ~inner[1:]) + 1
    p, inv = _powers(len(cps))
    run = np.zeros(len(cps) + 1, U)
    np.cumsum((mix((fold[cps].astype(U) + U(1)) * _GOLD) | U(1)) * p[:len(cps)], out=run[1:])
    return mix((run[end] - run[start]) * inv[start] + (end - start).astype(U) * _GOLD), np.searchsorted(start, off)


def grams(tables: tuple, column) -> tuple[list, np.ndarray]:
    """(hashes of every word, its context and the pair of both; words per row)."""
    found, size = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    before = [np.zeros(0, U)]
    for part in slices(pa.RecordBatch.from_arrays([column], names=["text"]), "text", 1 << 20):
        h, off = words(tables, part.column(0))
        last = np.concatenate(([_BEGIN], h[:-1]))[:len(h)]
        last[off[:-1][off[:-1] < off[1:]]] = _BEGIN
        found.append(h)
        before.append(last)
        size.append(np.diff(off))
    h, last = np.concatenate(found), np.concatenate(before)
    return [h, mix(last ^ _CONTEXT), mix(last * U(R) + h * _PAIR)], np.concatenate(size)


def packed(x: np.ndarray) -> bytes:
    """The numbers' lowest bytes, then the next ones and so on, as many as the
    largest needs, after their number: small, and what is left compresses."""
    wide = max(1, -(-int(x.max()).bit_length() // 8))
    return bytes([wide]) + np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T[:wide]).tobytes()


def unpacked(x, kind) -> np.ndarray:
    raw = np.frombuffer(x.as_buffer(), np.uint8)
    out = np.zeros(((len(raw) - 1) // int(raw[0]), np.dtype(kind).itemsize), np.uint8)
    out[:, :raw[0]] = raw[1:].reshape(raw[0], -1).T
    return out.view(kind).ravel()


def _column(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name)
    return pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)


def word_difference(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    weight: float = WEIGHT, block: int = BLOCK) -> DataFrame:
    """(id, n_tokens, loss_difference) of every row; ``targets`` has the ids of
    the target documents."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chars = d.agg(F.sum(F.char_length("text"))).first()[0] or 0
    groups = -(-chars // (block * SPREAD)) or 1
    ranges = math.ceil(RANGES * math.sqrt(groups * SPREAD))
    place = lambda x: F.pmod(x, F.lit(groups)) * SPREAD
    d = d.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(SPREAD)) + F.when(
        F.col("id").isNull(), place(F.xxhash64("text", F.lit(1)))).otherwise(place(F.xxhash64("id"))))
    chosen = (targets.select(F.col(id_col).cast(d.schema["id"].dataType).alias("id")).filter("id IS NOT NULL").distinct()
              .withColumn("block", F.explode(F.sequence(place(F.xxhash64("id")), place(F.xxhash64("id")) + SPREAD - 1))))
    share = spark.sparkContext.broadcast(character_tables())
    pack = pa.schema([("kind", pa.int32()), ("range", pa.int64()), ("block", pa.int64()),
                      ("h", pa.binary()), ("n", pa.binary()), ("t", pa.binary())])
    answer = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int64()), ("n", pa.binary()),
                        ("t", pa.binary()), ("distinct", pa.int64()), ("n_all", pa.int64()), ("t_all", pa.int64())])

    def ask(key, rows: pa.Table, marked: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pack.empty_table()
        found, size = grams(share.value, _column(rows, "text"))
        mark = np.repeat(pc.is_in(_column(rows, "id"), value_set=_column(marked, "id")).to_numpy(zero_copy_only=False), size)
        out = []
        for kind in range(3):
            u, at, n = np.unique(found[kind], return_inverse=True, return_counts=True)
            found[kind] = None
            t = np.bincount(at[mark], minlength=len(u)).astype(np.int32)
            n = n.astype(np.int32)
            of = (u >> U(32)) * U(ranges) >> U(32)  # rises with u
            cut = np.flatnonzero(np.diff(of, prepend=of[:1] + U(1))) if len(u) else []
            for a, b in zip(cut, [*cut[1:], len(u)]):
                out.append((kind, int(of[a]), key[0].as_py(), packed(np.diff(u[a:b], prepend=U(0))),
                            packed(n[a:b]), packed(t[a:b])))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), pack)], schema=pack) if out else pack.empty_table()

    def add(rows: pa.Table) -> pa.Table:
        h = [np.cumsum(unpacked(x, U), dtype=U) for x in rows.column("h")]
        size, h = [len(x) for x in h], np.concatenate(h)
        n, t = (np.concatenate([unpacked(x, np.int32) for x in rows.column(c)]) for c in "nt")
        u, at = np.unique(h, return_inverse=True)
        n, t = (np.bincount(at, x, len(u)).astype(np.int64) for x in (n, t))
        end = np.cumsum(size)
        kind, part = rows.column("kind")[0].as_py(), rows.column("range")[0].as_py()
        out = [(-1, kind, part, None, None, len(u), int(n.sum()), int(t.sum()))]
        for b, lo, hi in zip(rows.column("block").to_pylist(), end - size, end):
            out.append((b, kind, part, packed(n[at[lo:hi]]), packed(t[at[lo:hi]]), 0, 0, 0))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), answer)], schema=answer)

    kind = d.schema["id"].dataType.simpleString()
    with scratch(spark) as tmp:
        asked = d.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(
            ask, "kind int, range long, block long, h binary, n binary, t binary")
        answers = tmp.keep(asked.groupBy("kind", "range").applyInArrow(
            add, "block long, kind int, range long, n binary, t binary, distinct long, n_all long, t_all long"))
        total = answers.filter("block = -1 AND kind = 0").agg(F.sum("distinct"), F.sum("n_all"), F.sum("t_all")).first()
        distinct, n_all, t_all = (x or 0 for x in total)

        def score(key, rows: pa.Table, told: pa.Table) -> pa.Table:
            found, size = grams(share.value, _column(rows, "text"))
            loss, at, own = np.zeros(int(size.sum())), [], []
            row = np.repeat(np.arange(len(size)), size)
            for k in range(3):  # from here on the place of every gram among the block's distinct ones
                at.append(np.unique(found[k], return_inverse=True)[1].astype(np.int32))
                found[k] = None
                # How often it stands in its own document.
                _, i, n = np.unique(row * (int(at[k].max(initial=0)) + 1) + at[k], return_inverse=True, return_counts=True)
                own.append(n[i].astype(np.int32))
            of = told.column("kind").to_numpy()
            marked = told.filter(pa.array(of == _TARGET)).column("id")
            marked = pc.is_in(_column(rows, "id"), value_set=marked.combine_chunks()).to_numpy(zero_copy_only=False)
            part = np.lexsort((told.column("range").to_numpy(), of))
            for column, whole, sign in (("n", n_all, 1), ("t", t_all, -1)) if len(loss) else ():
                without = marked if column == "t" else np.ones(len(size), bool)  # where the document was counted
                taken = without[row]
                w, v, vw = (np.concatenate([unpacked(told.column(column)[i], np.int64) for i in part[of[part] == k].tolist()])[at[k]]
                            - own[k] * taken for k in range(3))
                p = (w + 1) * (weight / (whole - size * without + max(1, distinct)))[row]
                p += vw
                p /= v + weight
                loss += sign * np.log2(p, out=p)
            loss = np.concatenate(([0.0], loss))
            run, end = np.cumsum(loss), np.cumsum(size)
            return pa.table([_column(rows, "id"), pa.array(size.astype(np.int64)),
                             pa.array((run[end] - run[end - size]) / np.maximum(size, 1))],
                            names=["id", "n_tokens", "loss_difference"])

        none = lambda t: F.lit(None).cast(t)
        told = answers.filter("block >= 0").select("block", "kind", "range", "n", "t", none(kind).alias("id")).unionByName(
            chosen.select("block", F.lit(_TARGET).alias("kind"), F.lit(0).cast("long").alias("range"),
                          none("binary").alias("n"), none("binary").alias("t"), "id"))
        out = materialize(d.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
            score, f"id {kind}, n_tokens long, loss_difference double"))
    return out.withColumnRenamed("id", id_col)
