"""License notices in texts: an exact containment join of text blocks and templates.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased;
tokens are pairs of consecutive words.  A text's blocks are windows of twice the
longest template's words, half overlapping, so a whole notice stands within one
block however its lines break.  A block holds a template of m tokens if it holds
at least ``ceil(THRESHOLD m / 100)`` of them.

All templates' tokens are put in one global order, rarest first, by their counts
over all texts.  Of a template that needs a of m tokens, a block must hold one of
the first m - a + 1 (prefix filter): only blocks with such a token are opened.
A block with fewer than a tokens cannot hold it (length filter).  With the first
shared token at place p of the template and q of the block, at most
1 + min(m - p - 1, size - q - 1) are shared (positional filter; a block's tokens
outside all templates cannot meet one and have no place).  The pairs left are
counted in full.  Every filter is a bound, so the join is exact.

Labels of phrases (words that stand consecutively) are added to those of
templates.  The templates are the small side, ``MOST_TOKENS`` tokens at most, and go to
every task with the code; texts are read twice (counts, join) and never moved; the
counts that reach the driver are one row per token.  Token equality is that of
64-bit hashes; phrases are compared byte by byte.

Nulls and oddities: null and empty texts have no word, no label and score 0; texts
of any length are read whole, their work and memory grow in proportion; repeated
rows and ids are rows each; places that overlap count each; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.llm import words

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(words)

#: Per cent of a template's tokens that a block must hold.
THRESHOLD = 80
MOST_TOKENS = 1 << 16

PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Notices of well-known public licenses.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0"):ord("9") + 1] = _IN_WORD[ord("a"):ord("z") + 1] = _IN_WORD[0x80:] = True
_C0, _C1 = words.SHINGLE_COEF[:2]


def split_words(col) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, word starts, word ends, first word of every row and
    the number of words) of a string column."""
    off, raw = words.buffers(col)
    low = np.where((raw >= 0x41) & (raw <= 0x5A), raw | 0x20, raw)
    word = np.zeros(len(low) + 2, bool)
    word[1:-1] = _IN_WORD[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
    ends = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
    return low, starts, ends, np.searchsorted(starts, off)


def pair_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, inside a row) of the pair that begins at every word but the last."""
    h = words.span_hashes(low, starts, ends)
    inside = np.ones(max(0, len(h) - 1), bool)
    cut = first[1:-1]
    inside[cut[(cut > 0) & (cut < len(h))] - 1] = False
    return words.mix(h[:-1] * _C0 + h[1:] * _C1), inside


def phrase_places(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, phrase: str) -> np.ndarray:
    """The words (numbered over all rows) at which the phrase stands."""
    tokens = phrase.encode().split()
    at = np.arange(max(0, len(starts) - len(tokens) + 1))
    if len(at):
        at = at[row[at] == row[at + len(tokens) - 1]]
    for k, t in enumerate(tokens):
        at = at[ends[at + k] - starts[at + k] == len(t)]
        for j, byte in enumerate(t):
            at = at[low[starts[at + k] + j] == byte]
    return at


class Index:
    """Templates over globally ordered tokens: sorted token hashes with their
    ranks, prefix postings, needs.  Plain arrays, so that tasks need no package."""

    def __init__(self, templates: list[tuple[str, str]], threshold: int, counts: dict[int, int]):
        sets = []
        for _, text in templates:
            got = split_words(pa.array([text]))
            h, _ = pair_hashes(*got)
            sets.append(np.unique(h))
            if not len(h):
                raise ValueError(f"a template needs two words: {text!r}")
        self.hashes = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        if len(self.hashes) > MOST_TOKENS:
            raise ValueError(f"templates of more than {MOST_TOKENS} tokens")
        n = np.array([counts.get(int(h.astype(np.int64)), 0) for h in self.hashes], np.int64)
        by = np.lexsort((self.hashes, n))  # rarest first
        self.rank = np.empty(len(by), np.int64)
        self.rank[by] = np.arange(len(by))
        self.tokens = [np.sort(self.rank[np.searchsorted(self.hashes, s)]) for s in sets]
        self.size = np.array([len(s) for s in sets], np.int64)
        self.need = -(-threshold * self.size // 100)
        keep = self.size - self.need + 1
        t = np.repeat(np.arange(len(sets)), keep)
        p = np.concatenate([np.arange(k) for k in keep]) if sets else np.zeros(0, np.int64)
        tok = np.concatenate([s[:k] for s, k in zip(self.tokens, keep)]) if sets else np.zeros(0, np.int64)
        order = np.argsort(tok, kind="stable")
        self.post_template, self.post_place = t[order], p[order]
        self.post_first = np.searchsorted(tok[order], np.arange(len(self.hashes) + 1))
        self.half = max([len(split_words(pa.array([text]))[1]) for _, text in templates], default=1)

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """Rank of every token hash, -1 for those in no template."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.rank[at], -1)


def join_blocks(block: np.ndarray, token: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, template, shared tokens) of all pairs that meet the need; the
    input are distinct (block, token rank), sorted."""
    if not len(block):
        return block, block, block
    new = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    size = np.diff(np.concatenate((new, [len(block)])))
    own = np.repeat(np.arange(len(new)), size)
    q = np.arange(len(block)) - new[own]
    width = index.post_first[token + 1] - index.post_first[token]  # prefix postings of each token
    hit = np.repeat(np.arange(len(block)), width)
    post = np.repeat(index.post_first[token] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    t, p = index.post_template[post], index.post_place[post]
    pair = own[hit] * len(index.size) + t
    _, once = np.unique(pair, return_index=True)  # the first shared token of every pair
    hit, t, p = hit[once], t[once], p[once]
    o, need = own[hit], index.need[t]
    bound = 1 + np.minimum(index.size[t] - p - 1, size[o] - q[hit] - 1)
    ok = (size[o] >= need) & (bound >= need)
    o, t = o[ok], t[ok]
    keys, base = own * len(index.hashes) + token, len(index.hashes)
    shared = np.zeros(len(o), np.int64)
    for k in np.unique(t).tolist():
        at = np.flatnonzero(t == k)
        want = (o[at, None] * base + index.tokens[k]).ravel()
        found = keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want
        shared[at] = found.reshape(len(at), -1).sum(1)
    ok = shared >= index.need[t]
    return block[new][o[ok]], t[ok], shared[ok]


def _count(texts, index: Index) -> np.ndarray:
    low, starts, ends, first = split_words(texts)
    h, inside = pair_hashes(low, starts, ends, first)
    r = index.ranks(h)
    return np.bincount(r[inside & (r >= 0)], minlength=len(index.hashes))


def _scan(texts, index: Index, phrases, labels: list[str]) -> dict[str, list]:
    low, starts, ends, first = split_words(texts)
    n = len(texts)
    row = np.repeat(np.arange(n), np.diff(first))
    places = np.zeros(n, np.int64)
    lowest, highest = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
    base: list[set] = [set() for _ in range(n)]
    for phrase, label in phrases:
        at = phrase_places(low, starts, ends, row, phrase)
        word = at - first[row[at]]
        np.add.at(places, row[at], 1)
        np.minimum.at(lowest, row[at], word)
        np.maximum.at(highest, row[at], word)
        for r in np.unique(row[at]).tolist():
            base[r].add(label)
    matches: list[list] = [[] for _ in range(n)]
    h, inside = pair_hashes(low, starts, ends, first)
    r = index.ranks(h)
    at = np.flatnonzero(inside & (r >= 0))
    if len(at):
        rank, owner = r[at], row[at]
        word = at - first[owner]
        # A block's number over all rows; its second half is the next one's first.
        blocks = -(-np.diff(first) // index.half)
        before = np.concatenate(([0], np.cumsum(blocks)))
        k = word // index.half
        earlier = (k > 0) & (word + 1 < (k + 1) * index.half)
        block = np.concatenate((before[owner] + k, (before[owner] + k - 1)[earlier]))
        rank = np.concatenate((rank, rank[earlier]))
        open_to = np.unique(block[index.post_first[rank + 1] > index.post_first[rank]])  # a prefix token each
        kept = np.isin(block, open_to)
        key = np.unique(block[kept] * len(index.hashes) + rank[kept])
        for b, t, shared in zip(*(x.tolist() for x in join_blocks(key // len(index.hashes), key % len(index.hashes), index))):
            own = int(np.searchsorted(before, b, "right")) - 1
            lo = (b - int(before[own])) * index.half
            hi = min(lo + 2 * index.half, int(first[own + 1] - first[own]))
            matches[own].append({"label": labels[t], "template": t, "first_word": lo, "end_word": hi,
                                 "containment": shared / int(index.size[t])})
    return {
        "n_words": np.diff(first).tolist(), "n_base": places.tolist(),
        "first_word": [int(x) if c else None for x, c in zip(lowest, places)],
        "last_word": [int(x) if c else None for x, c in zip(highest, places)],
        "base_labels": [",".join(sorted(b)) for b in base],
        "labels": [",".join(sorted(b | {x["label"] for x in m})) for b, m in zip(base, matches)],
        "score": [1.0 if b else max([x["containment"] for x in m], default=0.0) for b, m in zip(base, matches)],
        "matches": matches,
    }


_MATCH = "array<struct<label: string, template: int, first_word: long, end_word: long, containment: double>>"
_MATCH_ARROW = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                                   ("end_word", pa.int64()), ("containment", pa.float64())]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates: list[tuple[str, str]] | None = None, phrases: list[tuple[str, str]] | None = None,
                  threshold: int = THRESHOLD) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels,
    score, matches) of every row.  ``matches`` are the blocks that hold a template
    (its number, the block's words, the share held); ``score`` is 1 with a
    phrase, else the largest share."""
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    if not 1 <= threshold <= 100:
        raise ValueError("threshold must be 1 to 100")
    labels = [label for label, _ in templates]
    first = Index(templates, threshold, {})
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches):
        total = np.zeros(len(first.hashes), np.int64)
        for batch in batches:
            for part in words.slices(batch, "text"):
                by = _count(part.column(0), first)
                total += by[first.rank]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(first.hashes[used].astype(np.int64)), pa.array(total[used])], ["token", "n"])

    counts = (rows.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
              .collect())  # a row per template token at most
    index = Index(templates, threshold, {r["token"]: r["n"] for r in counts})

    def scan(batches):
        for batch in batches:
            for part in words.slices(batch, "text"):
                got = _scan(part.column(1), index, phrases, labels)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(got[c], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
                     *[pa.array(got[c], pa.string()) for c in ("base_labels", "labels")],
                     pa.array(got["score"], pa.float64()), pa.array(got["matches"], _MATCH_ARROW)],
                    ["id", *got])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {kind}, n_words long, n_base long, first_word long, last_word long, "
                           f"base_labels string, labels string, score double, matches {_MATCH}"
                           ).withColumnRenamed("id", id_col)
