"""Language identification by cross-parsing.

A suffix automaton per language holds all substrings of a sample of its labelled
text.  A text is parsed into phrases, each the longest match with the language's
sample from where the last phrase ended; a language that explains the text needs
few.  Phrases times log2 of the longest sample's length plus the alphabet, over
the text's length, estimate the cross entropy in bits per character, and the
language with the least wins (ties: the first in order of name).  A phrase and an
unknown letter cost the same in all languages, so a small sample gains nothing.

Texts are folded to letters and single blanks.  They are parsed in stretches of
``STRETCH`` symbols, each from the automaton's start, so that all stretches of a
batch advance together, one symbol per array operation, through the automaton's
transition table; a phrase is cut once per stretch at most.

Each sample holds up to ``sample_chars`` letters and blanks (a documented bound)
of different training documents in order of the hash of their id and text, short
or long: whole documents until it is full, of the last one the beginning that fits
(the driver gets about twice what the samples hold, whatever ids or rows repeat); the
tables are the only broadcast: states x letters x 4 bytes per language, or, with
more than ``CELLS`` cells (thousands of letters), the transitions alone, sorted.
With more than ``most_bytes`` of tables (hundreds of languages) ``learn`` raises an
error that asks for shorter samples, before any row is scored.
Every language's table has all the letters of its own sample.  All rows are
scored, whole.

Nulls and oddities: a text that is null or has no letter is ``und`` with score 0;
null languages and null ids are not learned from; letters that no sample has
match nothing; with no training text all is ``und``; rows that repeat an id are
scored each; other columns pass through unused; an empty table gives an empty
result.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.functions.hashing import seeded_u32
from partqc.llm.quality import in_fold
from partqc.llm.words import code_points, slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STRETCH = 256
CELLS = 1 << 24
SAMPLE_CHARS = 80_000
SHARPNESS = 8.0
MOST_BYTES = 1 << 30


@dataclass
class Parser:
    """What a task needs: symbol of every code point (0: no letter, 1: a letter
    that no sample has), and per language its name, sample length, its own
    symbol of every symbol (1: a letter that its sample has not) and table."""
    symbol: np.ndarray
    names: list
    sizes: list
    own: list
    tables: list

    def plain(self) -> dict:
        """The fields without classes of this package, so that workers need not have it."""
        return {**vars(self), "tables": [tuple(vars(t).values()) if isinstance(t, Sparse) else t for t in self.tables]}

    @staticmethod
    def of(fields: dict) -> Parser:
        return Parser(**{**fields, "tables": [Sparse(*t) if isinstance(t, tuple) else t for t in fields["tables"]]})


@dataclass
class Sparse:
    """A transition table as the sorted places of its cells and what they hold."""
    place: np.ndarray
    to: np.ndarray
    shape: tuple

    def __getitem__(self, cell: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.place, cell), len(self.place) - 1)
        return np.where(self.place[at] == cell, self.to[at], 0)

    def ravel(self) -> Sparse:
        return self

    @property
    def nbytes(self) -> int:
        return self.place.nbytes + self.to.nbytes


def fold(symbol: np.ndarray, cps: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols with runs of blanks as one and none at either end's start,
    offsets, letters per row)."""
    s = symbol[cps]
    before = np.concatenate(([0], s[:-1])) if len(s) else s
    before[off[:-1][off[:-1] < len(s)]] = 0
    keep = (s != 0) | (before != 0)
    run = np.concatenate(([0], np.cumsum(keep)))
    letters = np.concatenate(([0], np.cumsum(s != 0)))
    return s[keep], run[off], np.diff(letters[off])


def automaton(text: np.ndarray, symbols: int, cells: int = CELLS) -> np.ndarray | Sparse:
    """Transition table (states x symbols, 0: none) of the suffix automaton of a
    sequence of symbols; state 0 is the start."""
    nxt: list[dict] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text.tolist():
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    if len(nxt) * symbols > cells:
        pairs = sorted((i * symbols + c, to) for i, d in enumerate(nxt) for c, to in d.items())
        place, to = np.array(pairs, np.int64).reshape(-1, 2).T.copy()
        return Sparse(place, to.astype(np.int32), (len(nxt), symbols))
    table = np.zeros((len(nxt), symbols), np.int32)
    for i, d in enumerate(nxt):
        for c, to in d.items():
            table[i, c] = to
    return table


def phrases(table: np.ndarray, s: np.ndarray, off: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """Number of phrases of every row of ``s`` in a parse by the table."""
    size = np.diff(off)
    parts = -(-size // stretch)
    row = np.repeat(np.arange(len(size)), parts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = off[:-1][row] + at * stretch
    length = np.minimum(stretch, size[row] - at * stretch)
    order = np.argsort(-length, kind="stable")
    start, length = start[order], length[order]
    count = np.zeros(len(start), np.int64)
    state = np.zeros(len(start), np.int64)
    flat, width = table.ravel(), table.shape[1]
    for t in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -t, "left"))  # stretches longer than t
        c = s[start[:live] + t].astype(np.int64)
        to = flat[state[:live] * width + c]
        miss = to == 0
        count[:live] += miss & (state[:live] != 0)
        state[:live] = np.where(miss, flat[c], to)
        count[:live] += state[:live] == 0  # a symbol that the sample has not
    count += state != 0  # the phrase under way at the end
    return np.bincount(row[order], count, minlength=len(size)).astype(np.int64)


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held: int,
          sample_chars: int, seed: int = 8, most_bytes: int = MOST_BYTES) -> Parser | None:
    """The parser of the languages that training documents are marked with."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & ~in_fold(F.col("id"), folds, held))
    d = d.withColumn("h", seeded_u32(seed, [F.col("id"), F.xxhash64("text")]))
    # What a text can add: its first letters and single blanks.
    part = F.substring(F.trim(F.regexp_replace("text", r"\P{L}+", " ")), 1, sample_chars)
    d = d.withColumn("level", 32 - F.length(F.bin("h")))  # zeros that the hash begins with
    sums: dict[str, dict] = {}
    each = d.select("lang", "level", "h", F.char_length(part).alias("n")).distinct()
    for r in each.groupBy("lang", "level").agg(F.sum("n").alias("n")).collect():
        if r["n"]:
            sums.setdefault(r["lang"], {})[r["level"]] = r["n"]
    if not sums:
        return None
    # The fewest halvings of the hashes' range from its small end that fill the sample.
    least = []
    for lang, by in sums.items():
        n = 0
        for level in sorted(by, reverse=True):
            n += by[level]
            if n >= sample_chars:
                break
        least.append((lang, level))
    near = F.broadcast(docs.sparkSession.createDataFrame(least, "l string, least int"))
    picked = (d.join(near, d["lang"] == near["l"]).filter(F.col("level") >= F.col("least"))
              .select("lang", "h", part.alias("text")).distinct().collect())
    texts: dict[str, list] = {}
    for lang, _, text in sorted((r["lang"], r["h"], r["text"]) for r in picked):
        kept = texts.setdefault(lang, [])
        room = sample_chars - sum(map(len, kept))
        if room > 0 and text:
            kept.append(text[:room - 1] + " ")
    letters: dict[str, int] = {}
    for kept in texts.values():
        for text in kept:
            for ch in text:
                low = ch.lower() if len(ch.lower()) == 1 else ch
                if low.isalpha():
                    letters[low] = letters.get(low, 0) + 1
    known = sorted(letters, key=lambda c: (-letters[c], c))
    symbol = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.int32, 0x110000)
    for i, ch in enumerate(known):
        symbol[ord(ch)] = i + 2
        if len(ch.upper()) == 1:
            symbol[ord(ch.upper())] = i + 2
    out, held_bytes = Parser(symbol, [], [], [], []), 0
    for lang in sorted(texts):
        col = pa.array(texts[lang])
        s, off, _ = fold(symbol, *code_points(col))
        s = s[:sample_chars]
        has = np.unique(s[s > 1])
        own = np.minimum(np.arange(len(known) + 2), 1)
        own[has] = np.arange(len(has)) + 2
        out.names.append(lang)
        out.sizes.append(max(2, len(s)))
        out.own.append(own)
        out.tables.append(automaton(own[s], len(has) + 2))
        held_bytes += out.tables[-1].nbytes
        if held_bytes > most_bytes:
            raise ValueError(f"the tables of {len(out.names)} of {len(texts)} languages take {held_bytes} bytes, "
                             f"more than most_bytes={most_bytes}: lower sample_chars")
    return out


def identify(parser: Parser, col) -> tuple[list, np.ndarray]:
    """(language, score) of every text of an Arrow column."""
    s, off, letters = fold(parser.symbol, *code_points(col))
    size = np.maximum(np.diff(off), 1)
    cost = np.log2(max(parser.sizes) + len(parser.own[0]))
    bits = np.stack([phrases(t, own[s], off) * cost / size for own, t in zip(parser.own, parser.tables)])
    best = bits.argmin(0)
    score = 1 / np.exp2(-SHARPNESS * (bits - bits.min(0))).sum(0)
    some = letters > 0
    return [parser.names[b] if y else "und" for b, y in zip(best.tolist(), some.tolist())], np.where(some, score, 0.0)


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      folds: int = 4, held: int = 2, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row."""
    parser = learn(docs, id_col, text_col, lang_col, folds, held, sample_chars)
    share = docs.sparkSession.sparkContext.broadcast(parser and parser.plain())

    def run(batches):
        parser = share.value and Parser.of(share.value)
        for batch in batches:
            for piece in slices(batch, "text", 1 << 19):
                if parser is None:
                    lang, score = ["und"] * len(piece), np.zeros(len(piece))
                else:
                    lang, score = identify(parser, piece.column(1))
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                                 names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), in_fold(F.col("id"), folds, held).alias("held_out"),
                      "lang_pred", "score")
