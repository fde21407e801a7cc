"""A Merkle manifest of a dataset as postorder append logs.

Rows become leaf digests, ordered within their group (one subtree a group); the
subtrees' roots, ordered by group, form the top tree.  Every two consecutive
nodes of a level become one node, a last single one is hashed alone.

Builders are aligned: builder b of a group takes the leaves ``[b B, (b + 1) B)``
(``B`` a power of two), so its subtree is whole and no two builders share a node.
It appends nodes to its log in the order in which they are complete: a leaf, then
every ancestor that the leaf closes; the ragged right edge is closed at the end.
That is postorder, so a node is addressed without an index.  Below node (level
l, index i) of n leaves lie

    size(l, i) = sum over j <= l of min(ceil(n / 2^j), (i + 1) 2^(l-j)) - i 2^(l-j)

nodes with its own, and it stands at ``2 i 2^l - popcount(i) + size(l, i) - 1``.
Proofs take each level's sibling from its position.  Builders' roots are the
leaves of the next tier, until one node per group is left.

Scale: texts are scanned once and hashed in the JVM; what is shuffled is narrow
(two digests, id and group).  Order comes from range partitions: a row's number
is its place in its sorted partition plus the counts of the partitions before,
one row per (partition, group).  A builder holds at most ``B`` rows whatever its
group's size, a tier has 1/B of the rows below, and a proof is joined to leaves
per builder.  Through the driver go the largest group's size and the root.

Nulls and oddities: a null field is ``-``, so an empty text differs from a null
one; rows with a null group are a group of their own, the first; null ids come
first in their group; rows that share group and id are ordered by digest (equal
rows are leaves each, in any order, which changes no digest); other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partqc.llm.common import Scratch, materialize, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Leaves per builder, a power of two.
BUILDER = 1024
_ROW = (1 << 33) - 1  # monotonically_increasing_id is partition * 2**33 + row


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*fields: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the postorder log of a tree of n leaves."""
    size = sum(min(-(-n >> j), (index + 1) << (level - j)) - (index << (level - j)) for j in range(level + 1))
    return (index << (level + 1)) - index.bit_count() + size - 1


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def append_log(leaves: list[str], height: int) -> list[str]:
    """The nodes of the tree of ``height`` levels over the leaves, in the order
    of their completion."""
    log: list[str] = []
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        done = i + 1
        level = 0
        while level < height and not done & 1:
            log.append(_h(log[-(1 << (level + 1))], log[-1]))  # the left sibling ends before the right one's subtree
            done >>= 1
            level += 1
    n = len(leaves)
    for level in range(height):
        if n & ((1 << (level + 1)) - 1):  # the last parent is not closed by a full run
            i = -(-n >> level) - 1
            last = [log[position(level, j, n)] for j in ([i - 1, i] if i & 1 else [i])]
            log.append(_h(*last))
    return log


def siblings(log: str, index: int, n: int, height: int) -> list[tuple[int, str]]:
    """(side, digest) of the sibling at every level from leaf ``index`` up: 1 it
    stands left, 2 right, 0 there is none.  ``log``: hex digests end to end."""
    out = []
    for level in range(height):
        other = index ^ 1
        if other < -(-n >> level):
            at = 64 * position(level, other, n)
            out.append((2 if other > index else 1, log[at:at + 64]))
        else:
            out.append((0, ""))
        index >>= 1
    return out


def fold(leaf: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for side, other in path:
        leaf = _h(leaf) if side == 0 else _h(other, leaf) if side == 1 else _h(leaf, other)
    return leaf


def pack(path: list[tuple[int, str]]) -> bytes:
    return b"".join(bytes([side]) + bytes.fromhex(d) for side, d in path)


def unpack(raw: bytes) -> list[tuple[int, str]]:
    out, at = [], 0
    while at < len(raw):
        side = raw[at]
        out.append((side, raw[at + 1:at + 33].hex() if side else ""))
        at += 33 if side else 1
    return out


def _height(n: int, total: int, builder: int) -> int:
    """Levels above the leaves: all of a group's only builder, a whole one of others."""
    return ((n if total <= builder else builder) - 1).bit_length()


def numbered(rows: DataFrame, order: list[str], tmp: Scratch) -> DataFrame:
    """``rows`` (with ``grp``, not null) with their 0-based ``idx`` within the
    group and the group's ``total``."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["grp", *order]
    dealt = tmp.keep(rows.repartitionByRange(n, *key).sortWithinPartitions(*key)
                     .withColumn("at", F.monotonically_increasing_id())
                     .select(*rows.columns, F.shiftright("at", 33).cast("int").alias("part"),
                             F.col("at").bitwiseAND(_ROW).alias("row")))
    w = Window.partitionBy("grp").orderBy("part")  # a row per partition
    runs = dealt.groupBy("grp", "part").agg(F.count("*").alias("n"), F.min("row").alias("first")).select(
        "grp", "part", (F.sum("n").over(w) - F.col("n") - F.col("first")).alias("before"),
        F.sum("n").over(Window.partitionBy("grp")).alias("total"))
    return dealt.join(runs, ["grp", "part"]).select(
        *rows.columns, (F.col("row") + F.col("before")).alias("idx"), "total")


_TIER = "grp string, b long, n long, total long, log binary"


@dataclass
class Tree:
    """``tiers`` from the leaves up (grp, b, n, total, log: binary digests end
    to end, a row per builder) and ``roots`` (grp, root)."""

    tiers: list[DataFrame]
    roots: DataFrame
    builder: int

    def log(self) -> DataFrame:
        """(grp, tier, b, pos, digest): every builder's nodes as written."""
        every = [t.select("grp", F.lit(k).alias("tier"), "b", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor(F.length("log") / 32).cast("int") - 1),
            lambda i: F.lower(F.hex(F.substring(F.col("log"), i * 32 + 1, F.lit(32)))))).alias("pos", "digest"))
            for k, t in enumerate(self.tiers)]
        out = every[0]
        for t in every[1:]:
            out = out.union(t)
        return out

    def opened(self, k: int, up: DataFrame) -> DataFrame:
        """``up`` (grp, b, path, and what else is carried: a row per builder of
        tier k) becomes a row per node of the level below it, numbered ``b``."""
        builder, carried = self.builder, up.columns

        def below(batches):
            for batch in batches:
                schema = batch.schema.empty_table().select(carried).schema
                for at in range(len(batch)):
                    row = batch.slice(at, 1).to_pylist()[0]
                    n, log = row["n"], row["log"].hex()
                    height = _height(n, row["total"], builder)
                    yield pa.RecordBatch.from_pylist(
                        [{**{c: row[c] for c in carried}, "b": row["b"] * builder + i,
                          "path": pack(siblings(log, i, n, height)) + row["path"]} for i in range(n)], schema=schema)

        return self.tiers[k].join(up, ["grp", "b"]).select(*carried, "n", "total", "log").mapInArrow(below, up.schema)

    def paths(self, above: DataFrame) -> DataFrame:
        """The siblings of every lowest builder's root up to the top as ``path``;
        ``above`` (grp, path, and what else is to be carried): those of the
        groups' roots."""
        up = above.withColumn("b", F.lit(0).cast("long"))
        for k in range(len(self.tiers) - 1, 0, -1):
            up = self.opened(k, up)
        return up


def build(nodes: DataFrame, tmp: Scratch, builder: int = BUILDER) -> Tree:
    """The logs over ``nodes`` (grp, idx, total, digest), tier after tier."""
    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        n, total = len(table), table.column("total")[0].as_py()
        log = append_log([d.hex() for d in table.column("digest").to_pylist()], _height(n, total, builder))
        return pa.table({"grp": table.column("grp")[:1], "b": [table.column("idx")[0].as_py() // builder], "n": [n],
                         "total": [total], "log": [bytes.fromhex("".join(log))]})

    most = nodes.agg(F.max("total")).first()[0] or 0
    tiers = []
    while True:
        tier = tmp.keep(nodes.select("grp", "idx", "total", "digest")
                        .groupBy("grp", F.shiftright("idx", builder.bit_length() - 1))
                        .applyInArrow(write, _TIER))
        tiers.append(tier)
        root = F.expr("substring(log, -32)")
        if most <= builder:
            return Tree(tiers, tier.select("grp", root.alias("root")), builder)
        nodes = tier.select("grp", F.col("b").alias("idx"), root.alias("digest"),
                            F.ceil(F.col("total") / builder).cast("long").alias("total"))
        most = -(-most // builder)


def prove(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
          fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          altered: dict[str, Column] | None = None, is_altered: Column | None = None,
          builder: int = BUILDER) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every row: its leaf, its subtree's root, the root, the hash of its proof, and
    what the proof gives for the row as it is now, with ``altered`` columns
    where ``is_altered`` holds.  Digests are lowercase hex."""
    if builder & (builder - 1):
        raise ValueError("builder must be a power of two")
    now = digest(*[(altered or {}).get(c, F.col(c)) for c in fields])
    changed = F.coalesce(is_altered, F.lit(False)) if is_altered is not None else F.lit(False)
    leaves = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
        digest(*[F.col(c) for c in fields]).alias("digest"), F.when(changed, now).alias("claim"),
        F.monotonically_increasing_id().alias("salt"))  # parts equal rows among ranges
    with scratch(docs.sparkSession) as tmp:
        rows = tmp.keep(numbered(tmp.keep(leaves), ["id", "digest", "salt"], tmp))
        tree = build(rows, tmp, builder)
        tops = tmp.keep(numbered(tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"),
                                                   F.col("root").alias("digest")), ["name"], tmp))
        top = build(tops, tmp, builder)
        first = top.roots.first()
        root = first["root"].hex() if first else None
        # What follows each subtree's root: its siblings in the top tree.
        down = top.opened(0, top.paths(top.roots.select("grp", F.lit(b"").alias("path"))))
        above = down.select(F.col("b").alias("idx"), "path").join(tops.select(
            "idx", F.col("name").alias("grp"), F.col("digest").alias("subroot")), "idx").select("grp", "path", "subroot")
        paths = tree.tiers[0].join(tree.paths(above), ["grp", "b"])

        def check(left: pa.Table, right: pa.Table) -> pa.Table:
            cols: dict[str, list] = {c: [] for c in ("leaf", "subroot", "proof_sha256", "folded_root")}
            rest = right.to_pylist()[0]
            log, n = rest["log"].hex(), rest["n"]
            height, upper = _height(n, rest["total"], builder), unpack(rest["path"])
            tail, subroot = "".join(d for _, d in upper), rest["subroot"].hex()
            for idx, leaf, claim in zip(*(left.column(c).to_pylist() for c in ("idx", "digest", "claim"))):
                path = siblings(log, idx % builder, n, height)
                cols["leaf"].append(leaf.hex())
                cols["subroot"].append(subroot)
                cols["proof_sha256"].append(_h(*[d for _, d in path], tail))
                cols["folded_root"].append(fold((claim or leaf).hex(), path + upper))
            return pa.table({"id": left.column("id"), **cols})

        b = F.shiftright("idx", builder.bit_length() - 1).alias("b")
        left = rows.select("grp", b, "idx", "id", "digest", "claim").groupBy("grp", "b")
        right = paths.select("grp", "b", "n", "total", "log", "path", "subroot").groupBy("grp", "b")
        kind = docs.schema[id_col].dataType.simpleString()
        out = left.cogroup(right).applyInArrow(
            check, f"id {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
        return materialize(out.select(
            F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256",
            "folded_root", (F.col("folded_root") == F.lit(root).cast("string")).alias("verified")))
