"""N-gram Jaccard join over a token-group matrix.

Every link between documents whose sets of distinct k-word shingles have a
Jaccard similarity of ``percent`` % or more is found; the result is each
document's connected component.

1. *Sets.*  One pass over the texts gives each document the size and a 128-bit
   digest of its shingle set.  Equal sets are one class from here on.
2. *Groups.*  Similar classes are partitioned into groups: classes that agree in
   a pair of min-hashes are compared with the smallest of them, and links found
   so (confirmed on the texts) are contracted.  This only makes the groups
   tight; nothing is decided by a missed agreement.
3. *Token-group matrix.*  Of a set of n shingles, any partner shares
   ceil(p n) of them, so its first n - ceil(p n) + L shingles (in any order that
   all sets share) hold L of the partner's first ones.  The matrix stores, for
   each shingle, the groups whose members' first shingles contain it: the
   group's token union, one entry however many copies the group has.
4. *Bound.*  Counting a query's shingles in each group's union bounds its overlap
   with every member from above; groups below L cannot hold a partner.
5. *Open.*  Only qualifying groups are opened: the query meets the members that
   share L of the shingles themselves, and the pair is decided by the exact
   intersection and union of the two whole sets, computed from the texts.

The common order puts shingles that many documents share last, so most sets need
none of these among their first ones.  Sets that do (they consist of little else,
as the copies of one text do) are told apart in the same way, but as blocks: sets
of one group, or else of one min-hash over their common shingles, are dealt into
blocks of at most ``BLOCK_SETS`` sets and ``BLOCK_SHINGLES`` shingles; the matrix
holds the blocks' unions, and two blocks whose unions share L shingles are opened
together, as one matrix product in a task that returns a spanning forest of the
links.  A group of copies of any size so costs rows in proportion to its blocks,
and no task ever holds more than two of them.  The order steers the cost alone: any
order gives the same links.

Nulls and oddities: a null or empty text has an empty set and links with
nothing; a null id gets its size and a null component; rows that repeat an id
are one document, which has the links of all its texts; other columns of the
input are ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.llm.common import Scratch, components, materialize, scratch
from partqc.llm.words import U, mix, shingles, slices, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIGNATURES = 4
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 19
_SET_SCHEMA = "id long, n long, d1 long, d2 long, sig array<long>"


def _need(n, percent: int):
    """Shingles that a set of n shares with any partner."""
    return -(-n * percent // 100)


def _extra(n):
    """L of the bound for a set of n."""
    return 3 + n // 25


def _first_n(n: int, percent: int) -> int:
    return n - _need(n, percent) + _extra(n)


def _longs(parts: list[np.ndarray]) -> pa.Array:
    off = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64))).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ U(0x5851F42D4C957F2D)) >> U(32)).astype(np.uint32)


def _in_order(s: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set's shingles by hash, those not in ``common`` and those in it."""
    slot = _slot(s) & np.uint32(len(common) * 8 - 1)
    late = (common[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
    return s[late == 0], s[late == 1]


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """Size, digest and min-hashes of every document's set."""
    keys = mix(np.arange(7, 7 + SIGNATURES + 2, dtype=U) * U(0x2545F4914F6CDD1D))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(*word_hashes(part.column(1)), k)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                digest = np.zeros((SIGNATURES + 2, len(n)), U)
                if len(full):
                    flat = np.concatenate([sets[i] for i in full])
                    at = np.concatenate(([0], np.cumsum(n[full])[:-1]))
                    for j, key in enumerate(keys):
                        op = np.add if j < 2 else np.minimum
                        digest[j, full] = op.reduceat(mix(flat ^ key), at)
                digest = digest.view(np.int64)
                sig = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1, dtype=np.int32) * SIGNATURES),
                    pa.array(digest[2:].T.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(digest[0]), pa.array(digest[1]), sig],
                    names=["id", "n", "d1", "d2", "sig"])

    return docs.mapInArrow(run, _SET_SCHEMA)


def _slot_counts(docs: DataFrame, k: int) -> DataFrame:
    """(slot, n): in how many documents the shingles of a 32-bit slot are, counted
    in each piece of a task already."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(*word_hashes(part.column(1)), k)
                slot, n = np.unique(_slot(np.concatenate(sets)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int32)), pa.array(n.astype(np.int32))],
                                                 names=["slot", "n"])
    return docs.mapInArrow(run, "slot int, n int")


def _first_sets(docs: DataFrame, k: int, percent: int, share) -> DataFrame:
    """The first shingles of every document in the common order: ``rare`` ones,
    and as many ``common`` ones as are needed besides; ``key``: the min-hash of
    all common ones, for sets that need some."""
    turn = U(0xD6E8FEB86659FD93)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingles(*word_hashes(part.column(1)), k)
                rare, common, key = [], [], []
                for s in sets:
                    early, late = _in_order(s, share.value)
                    m = _first_n(len(s), percent)
                    rare.append(early[:m])
                    common.append(late[:max(0, m - len(early))])
                    key.append(int(mix(late ^ turn).min().view(np.int64)) if len(common[-1]) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), _longs(rare), _longs(common),
                     pa.array(key, pa.int64())], names=["id", "n", "rare", "common", "key"])
    return docs.mapInArrow(run, "id long, n long, rare array<long>, common array<long>, key long")


def _overlap(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "ta", 1 << 20):
                a = shingles(*word_hashes(part.column(2)), k)
                b = shingles(*word_hashes(part.column(3)), k)
                both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(both, pa.int64()),
                     pa.array([len(x) + len(y) - z for x, y, z in zip(a, b, both)], pa.int64())],
                    names=["u", "v", "shared", "total"])
    return run


def _spanning(sets: tuple[list, list], groups: tuple, ids: tuple, same: bool, percent: int) -> list[tuple[int, int]]:
    """Links between the sets of two blocks (or inside one), of those that join
    the same sets a spanning forest; sets of one group are joined already."""
    flat = [np.concatenate(s) if s else np.zeros(0, U) for s in sets]
    n = [np.array([len(x) for x in s], np.int64) for s in sets]
    if same:
        token, times = np.unique(flat[0], return_counts=True)
        token = token[times > 1]
    else:
        token = np.intersect1d(*(np.unique(f) for f in flat))
    row = [np.repeat(np.arange(len(s)), m) for s, m in zip(sets, n)]
    col = [np.searchsorted(token, f) for f in flat]
    known = [token[np.minimum(c, len(token) - 1)] == f if len(token) else np.zeros(len(f), bool) for c, f in zip(col, flat)]
    shared = np.zeros((len(n[0]), len(n[1])), np.float32)
    for at in range(0, len(token), 4096):
        part = []
        for side in (0, 1):
            hit = known[side] & (col[side] >= at) & (col[side] < at + 4096)
            m = np.zeros((len(n[side]), min(4096, len(token) - at)), np.float32)
            m[row[side][hit], col[side][hit] - at] = 1
            part.append(m)
        shared += part[0] @ part[1].T
    both = shared.astype(np.int64)
    link = both * 100 >= (n[0][:, None] + n[1][None, :] - both) * percent
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(link).tolist():
        a, b = find(groups[0][i]), find(groups[1][j])
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((ids[0][i], ids[1][j]))
    return out


def _open_blocks(k: int, percent: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        links = []
        if len(left) and len(right):
            sides = (left, right)
            sets = tuple(shingles(*word_hashes(t.column("text")), k) for t in sides)
            groups, ids = (tuple(t.column(c).to_pylist() for t in sides) for c in ("g", "rep"))
            links = _spanning(sets, groups, ids, key[0].as_py() == key[1].as_py(), percent)
        return pa.table([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                        names=["u", "v"])
    return run


def confirm(tmp: Scratch, docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) of ids that link, by their whole texts: (u, v, shared,
    total).  Only texts that are in a pair are brought to pairs."""
    wanted = pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct()
    texts = tmp.keep(docs.join(wanted, "id", "left_semi"))
    both = (pairs.join(texts.select(F.col("id").alias("v"), F.col("text").alias("tb")), "v")
            .join(texts.select(F.col("id").alias("u"), F.col("text").alias("ta")), "u")
            .select("u", "v", "ta", "tb"))
    return tmp.keep(both.mapInArrow(_overlap(k), "u long, v long, shared long, total long")
                    .filter(F.col("total") > 0).filter(F.col("shared") * 100 >= F.col("total") * percent))


def _size_ok(a, b, percent: int):
    """Sets whose sizes alone do not rule out a link."""
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _common_slots(tmp: Scratch, counts: DataFrame, at_least: int, most: int) -> np.ndarray:
    """A bit set of the slots that ``at_least`` documents have; if these are over
    ``most`` (the bound of what goes through the driver), of the most frequent."""
    # Tasks have summed already what they saw, so rows are dealt before the sum.
    slots = tmp.keep(counts.repartition("slot").groupBy("slot").agg(F.sum("n").alias("n")).filter(F.col("n") >= at_least))
    top = slots.orderBy(F.desc("n"), "slot").limit(most).select("slot")
    got = np.array([r[0] for r in top.collect()], np.int32).view(np.uint32)
    size = max(1 << 16, min(1 << 32, 1 << (16 * len(got)).bit_length()))
    bits = np.zeros(size // 8, np.uint8)
    slot = got & np.uint32(size - 1)
    np.bitwise_or.at(bits, slot >> 3, np.left_shift(np.uint8(1), (slot & 7).astype(np.uint8)))
    return bits


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80, common_from: int = 24, common_most: int = 1 << 19) -> DataFrame:
    """One row per input row: id, n_shingles (size of its set), component_id
    (smallest id reachable by links, itself included).

    ``common_from`` is the number of documents from which a shingle is put last in
    the common order, ``common_most`` how many of these are told to all tasks (a bit
    set of at most 32 bits each; 2 MB by default).  They steer the cost only.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = materialize(_sets(docs, k))
    named = sets.filter(F.col("id").isNotNull())
    classes = materialize(named.filter("n > 0").groupBy("d1", "d2", "n").agg(F.min("id").alias("rep")))
    with scratch(docs.sparkSession) as tmp:
        group = _groups(tmp, docs, named, classes, k, percent)
        far = _opened(tmp, docs, classes, group, k, percent, common_from, common_most)
        # Contract: links between groups, then class -> group -> component.
        for end in ("u", "v"):
            far = far.join(group.withColumnRenamed("node", end), end, "left").withColumn(
                end, F.coalesce("component", end)).drop("component")
        whole = components(far.select("u", "v")).select(F.col("node").alias("component"),
                                                        F.col("component").alias("c2"))
        final = group.join(whole, "component", "left").select(
            F.col("node").alias("rep"), F.coalesce("c2", "component").alias("c")).union(
            whole.join(group.select(F.col("node").alias("component")), "component", "left_anti")
            .select(F.col("component").alias("rep"), F.col("c2").alias("c")))
        final = materialize(final)
    return (sets.select("id", "n", "d1", "d2").join(classes, ["d1", "d2", "n"], "left")
            .join(final, "rep", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("c", "rep", "id")).alias("component_id")))


def _groups(tmp: Scratch, docs: DataFrame, named: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component): classes that are linked with the smallest of those
    that share a pair of min-hashes with them."""
    member = named.join(classes, ["d1", "d2", "n"]).select("id", "rep", "n", "sig")
    reps = member.filter("id = rep")
    # An id with several texts joins their classes.
    several = (member.groupBy("id").agg(F.min("rep").alias("u"), F.max("rep").alias("v"))
               .filter("u <> v").select("id"))
    several = member.join(several, "id", "left_semi").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    bands = [F.xxhash64(F.lit(i), F.col("sig")[i], F.col("sig")[(i + 1) % SIGNATURES]) for i in range(SIGNATURES)]
    banded = reps.select("rep", "n", F.explode(F.array(*bands)).alias("band"))
    lead = banded.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("l"))
    star = (banded.join(lead, "band").filter(F.col("l.rep") < F.col("rep"))
            .filter(_size_ok(F.col("n"), F.col("l.n"), percent))
            .select(F.col("l.rep").alias("u"), F.col("rep").alias("v")).distinct())
    near = confirm(tmp, docs, tmp.keep(star), k, percent).select("u", "v")
    return materialize(components(near.union(several)))


def _opened(tmp: Scratch, docs: DataFrame, classes: DataFrame, group: DataFrame, k: int, percent: int,
            common_from: int, common_most: int) -> DataFrame:
    """Links (u, v) between classes of different groups."""
    common = _common_slots(tmp, _slot_counts(docs, k), common_from, common_most)
    share = docs.sparkSession.sparkContext.broadcast(common)
    node = classes.select("rep", "n").distinct().join(group.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("rep").alias("id"), "n", F.coalesce("component", "rep").alias("g"), F.col("component").isNotNull().alias("linked"))
    first = tmp.keep(_first_sets(docs, k, percent, share).join(node, ["id", "n"])
                     .withColumnRenamed("id", "rep"))
    return _by_sets(tmp, docs, first, k, percent).union(_by_blocks(tmp, docs, first, k, percent))


def _by_sets(tmp: Scratch, docs: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """Links of which one side needs no common shingle among its first ones."""
    token = first.select("rep", "n", "g", F.col("key").isNotNull().alias("blocked"), F.explode("rare").alias("token"))
    shared = (token.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.bool_and("blocked").alias("all"))
              .filter("lo < hi AND NOT all").select("token"))
    token = tmp.keep(token.join(shared, "token"))

    # The matrix, the bound, the opened groups.
    def least(n):
        return F.least(3 + F.floor(n / 25), F.ceil(n * percent / 100))

    matrix = token.groupBy("token", "g").agg(F.min("n").alias("n0"), F.max("n").alias("n1")).select(
        "token", F.col("g").alias("h"), "n0", "n1")
    open_ = tmp.keep(
        token.join(matrix, "token").filter("g < h")
        .filter((F.col("n1") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("n0") * percent))
        .groupBy("rep", "n", "h").count().filter(F.col("count") >= least(F.floor(F.col("n") * percent / 100)))
        .select("rep", "n", "h"))
    asked = token.drop("g").join(open_, ["rep", "n"])
    pairs = tmp.keep(
        asked.join(token.select("token", F.col("g").alias("h"), F.col("rep").alias("v"), F.col("n").alias("m"),
                                F.col("blocked").alias("other")), ["token", "h"])
        .filter(_size_ok(F.col("n"), F.col("m"), percent) & ~(F.col("blocked") & F.col("other")))
        .groupBy(F.col("rep").alias("u"), "n", "v", "m").count()
        .filter(F.col("count") >= least(F.least("n", "m"))).select("u", "v").distinct())
    return confirm(tmp, docs, pairs, k, percent).select("u", "v")


def _by_blocks(tmp: Scratch, docs: DataFrame, first: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between sets that need common shingles among their first ones."""
    sets = first.filter("key IS NOT NULL").withColumn("key", F.when(F.col("linked"), F.col("g")).otherwise(F.col("key")))
    size = sets.groupBy("linked", "key").agg(F.ceil(F.greatest(
        F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    dealt = (sets.join(size, ["linked", "key"])
             .withColumn("b", F.xxhash64("linked", "key", F.pmod(F.xxhash64("rep"), "blocks"))))
    dealt = tmp.keep(dealt.select("b", "rep", "g", "linked", F.concat("rare", "common").alias("first")))
    # A block of linked sets is of one group; other blocks may hold links inside.
    union = dealt.select("b", F.when(F.col("linked"), F.col("g")).alias("one"), F.explode("first").alias("token")).distinct()
    union = tmp.keep(union)
    shared = union.groupBy("token").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).filter("lo < hi").select("token")
    union = union.join(shared, "token")
    other = union.select("token", F.col("b").alias("c"), F.col("one").alias("two"))
    opened = (union.join(other, "token").filter("b < c AND (one IS NULL OR two IS NULL OR one <> two)")
              .groupBy("b", "c").count().filter("count >= 3").select("b", "c"))
    inside = dealt.filter("NOT linked").groupBy("b").count().filter("count > 1").select("b", F.col("b").alias("c"))
    opened = tmp.keep(opened.union(inside))
    texts = tmp.keep(dealt.select("b", "rep", "g").join(docs.withColumnRenamed("id", "rep"), "rep"))
    left = opened.join(texts, "b").select("b", "c", "rep", "g", "text").toDF("b", "c", "rep", "g", "text")
    right = (opened.join(texts.withColumnRenamed("b", "c"), "c").select("b", "c", "rep", "g", "text")
             .toDF("b", "c", "rep", "g", "text"))
    return tmp.keep(left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(
        _open_blocks(k, percent), "u long, v long"))
