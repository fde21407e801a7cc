"""Threshold-scaled document fingerprints.

A fingerprint keeps every distinct shingle hash below a fixed fraction of the
hash range (and, where a text has none there, its smallest hash alone).  Its size
follows the text, so a small document inside a very large one is still seen:
the kept hashes of both are the same sample of one universe.  Hence

* ``merge``: the fingerprint of two texts' joint shingles is the union of their
  fingerprints (without a smallest hash that is no longer needed);
* ``containment``: the share of a's hashes that b keeps estimates how much of a
  is in b, ``likeness`` the Jaccard similarity.

Shingles are ``k`` lower-cased words; a shorter text is one shingle, a text
without words has an empty fingerprint.  Everything is a column expression.

Nulls and oddities: a null text counts as empty; two empty fingerprints have
likeness and containment 1, an empty one has 0 to any other; rows that repeat an
id follow each other in the order of their texts; a null id comes last in
descending order; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 8  # one hash in FRACTION is kept


def _below(fraction: int) -> int:
    """Signed 64-bit hashes below this are the least 1 / ``fraction`` of all."""
    return -(1 << 63) + (1 << 64) // fraction


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """Hashes of all k-word shingles, repeats included; null text as empty."""
    words = F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[\x20\x09-\x0D]+"),
                     lambda w: w != "")
    return F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), lambda h: (
        F.when(F.size(h) >= k, F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)])))
        .when(F.size(h) > 0, F.array(F.xxhash64(h)))
        .otherwise(F.array().cast("array<bigint>"))))[0]


def _kept(hashes: Column, fraction: int) -> Column:
    low = F.lit(_below(fraction))
    return F.transform(F.array(hashes), lambda h: F.transform(
        F.array(F.filter(h, lambda x: x < low)),
        lambda s: F.when((F.size(s) == 0) & (F.size(h) > 0), F.array(F.array_min(h)))
        .otherwise(F.array_sort(F.array_distinct(s))))[0])[0]


def fingerprint(text: Column, k: int = SHINGLE, fraction: int = FRACTION) -> Column:
    """Sorted distinct kept hashes (array<bigint>)."""
    return _kept(shingle_hashes(text, k), fraction)


def merge(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """The fingerprint of both texts' shingles together."""
    return _kept(F.array_union(a, b), fraction)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts' shingle sets."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(a: Column) -> Column:
    """16 hex digits a hash, comma-joined."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ",")


def _bounds(ids: DataFrame, blocks: int) -> list:
    """At most ``blocks`` - 1 rising cuts of the ids into parts of like size."""
    cuts = ids.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)], 10000)).first()[0] or []
    return sorted(set(cuts))


def _block_of(id_: Column, cuts: list) -> Column:
    """How many cuts lie above the id: 0 holds the largest.  Two levels, so the
    work per row is about twice the square root of the number of cuts."""
    if not cuts:
        return F.lit(0)
    falling = cuts[::-1]
    step = max(1, int(len(falling) ** 0.5))
    heads = F.array(*[F.lit(int(x)) for x in falling[::step]])
    every = F.array(*[F.lit(int(x)) for x in falling])
    head = F.size(F.filter(heads, lambda x: x > id_))
    inside = F.size(F.filter(F.slice(every, F.greatest((head - 1) * step, F.lit(0)) + 1, F.lit(step)), lambda x: x > id_))
    return F.when(head == 0, F.lit(0)).otherwise((head - 1) * step + inside)


def with_next(docs: DataFrame, columns: list[str], blocks: int | None = None) -> DataFrame:
    """Adds next_<column>: the values of the next row by descending id (column
    ``id``, ties by ``tie``); the last row's next is the first.

    Rows are dealt into blocks of the id range (their number is a parameter, by
    default four per shuffle partition) and put in order inside these.  The first
    row of each block is dealt to the block before, too, as a guest that ends its
    order: one shuffle, no task that sees all rows, no second pass over the texts.
    """
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _bounds(docs.filter("id IS NOT NULL").select("id"), blocks)
    block = F.coalesce(_block_of(F.col("id"), cuts), F.lit(len(cuts) + 1)).cast("int")
    # One row per block (their number is bounded above): the largest id of each.
    heads = sorted(docs.select(block.alias("b"), "id").groupBy("b").agg(F.max("id").alias("id")).collect())
    before = {b: heads[i - 1][0] for i, (b, _) in enumerate(heads)}
    host = F.lit(None).cast("int")
    if heads:
        to = F.create_map(*[F.lit(x) for b, h in before.items() for x in (b, h)])
        first = F.create_map(*[F.lit(x) for b, i in heads for x in (int(b), -(1 << 63) if i is None else int(i))])
        lead = F.coalesce(F.col("id"), F.lit(-(1 << 63))) == F.element_at(first, F.col("b"))
        host = F.when(lead, F.element_at(to, F.col("b")))
    own = F.struct(F.col("b").alias("b"), F.lit(False).alias("guest"))
    dealt = docs.withColumn("b", block).withColumn("host", host).withColumn("at", F.explode(
        F.when(F.col("host").isNull(), F.array(own)).otherwise(
            F.array(own, F.struct(F.col("host").alias("b"), F.lit(True).alias("guest"))))))
    w = Window.partitionBy("at.b").orderBy("at.guest", F.desc_nulls_last("id"), "tie")
    rows = dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return rows.filter(~F.col("at.guest")).drop("b", "host", "at")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                 fraction: int = FRACTION) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the last half of
    its code points replaced by as many first ones of the next document by
    descending id), and the likeness to it and to the next document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = (docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("tie", F.sha2("text", 256))
            .withColumn("a", fingerprint(F.col("text"), k, fraction)))
    rows = (with_next(base, ["text", "a"])
            .withColumn("n", F.char_length("text").cast("long"))
            .withColumn("half", F.floor(F.col("n") / 2).cast("int"))
            .withColumn("edited", F.concat(
                F.substring(F.col("text"), F.lit(1), (F.col("n") - F.col("half")).cast("int")),
                F.substring(F.col("next_text"), F.lit(1), F.col("half")))))
    rows = rows.select("id", "n", F.sha2("edited", 256).alias("edited_sha256"),
                       "a", fingerprint(F.col("edited"), k, fraction).alias("b"), F.col("next_a").alias("c"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_chars"), "edited_sha256",
                       as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
                       likeness(F.col("a"), F.col("b")).alias("near_edited"),
                       likeness(F.col("a"), F.col("c")).alias("near_next"),
                       containment(F.col("a"), F.col("b")).alias("contained_edited"))
