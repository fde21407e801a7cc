"""Removal of globally repeated chunks of lines.

Lines are the parts of a text between line feeds.  Each line gets a 32-bit hash;
a rolling hash over the last two line hashes ends a chunk after a line where it
is 0 modulo ``divisor``, so boundaries depend on the lines near them only and
return to step after any insertion or removal.  A line of ``alone`` or more words
is a chunk by itself, for boundaries of two equal long lines always agree.

Chunks that are looked for everywhere are those of two or more lines (one with a
visible character), lone lines of ``alone`` words, and whole texts (with a visible
character).  Of equal ones the first by (id, position) stays and the others go,
each after its bytes have been compared with the first one's: equal hashes alone
remove nothing.  A repeated passage seldom begins and ends at boundaries, so a
removed chunk grows over its edges, line by line, while the lines beside it equal
those beside the first one; it grows no further than the next chunk of these kinds
beside the first one, nor into the next removed chunk.  An exact copy of an earlier
text goes whole.

What still stays: a repeated passage that holds no such chunk (short lines without
a boundary at both ends), and lines that a passage shares with a later occurrence
of its chunk but not with the first.

Chunk keys (16 bytes) are counted with map-side combination, so a chunk that a
third of all documents share is a few rows; the places of such hot chunks are
dealt over salts.  Texts move twice: once where they hold the first of a repeated
chunk, once to be joined with their own removals.

Nulls and oddities: a null text stays null with 0 lines; an empty text has one
empty line; a null id sorts first; rows that repeat both id and text are one
occurrence and keep the same lines; repeats inside one document go too; columns
of the input other than the text are passed through unchanged, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partqc.functions.hashing import hash_u32
from partqc.llm.common import materialize, scratch

DIVISOR = 3
ALONE = 16
#: At most this many chunk keys are hot: each has over 1 / HOT of all places of repeated chunks.
HOT = 1024
_NL = "\n"
_SEEN = r"[^\x20\x09-\x0D]"


def _row_key(id_: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("null")), F.lit(":"), text)))


def _chunks(docs: DataFrame, divisor: int, alone: int) -> DataFrame:
    """One row per chunk that is looked for: key, whole (text), rk (row key), id,
    s, e, its bytes and the lines beside it up to the end of the next such chunk."""
    long_line = rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{alone - 1}}}[^\x20\x09-\x0D]"
    d = (docs.filter(F.col("text").rlike(_SEEN))
         .select("id", _row_key(F.col("id"), F.col("text")).alias("rk"), F.split("text", _NL, -1).alias("lines"))
         .withColumn("x", F.transform("lines", lambda x: F.struct(
             hash_u32(F.md5(x)).alias("h"), x.rlike(long_line).alias("alone"), x.rlike(_SEEN).alias("seen"))))
         .withColumn("cuts", F.expr(
             f"""filter(sequence(1, greatest(size(x) - 1, 1)), i -> i < size(x) AND (get(x, i - 1).alone OR get(x, i).alone
                 OR (get(x, i - 1).h * 31 + coalesce(get(x, i - 2).h, 0)) % {divisor} = 0))"""))
         .withColumn("z", F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("cuts")).alias("s"),
                                       F.concat(F.col("cuts"), F.array(F.size("lines"))).alias("e")))
         .withColumn("z", F.expr("""filter(z, c -> get(x, c.s).alone
             OR (c.e - c.s > 1 AND exists(slice(x, c.s + 1, c.e - c.s), y -> y.seen)))"""))
         .select("id", "rk", "lines", F.explode(F.expr(
             """concat(array(named_struct('whole', true, 's', 0, 'e', size(lines), 'lo', 0, 'hi', size(lines))),
                transform(z, (c, i) -> named_struct('whole', false, 's', c.s, 'e', c.e,
                    'lo', coalesce(get(z, i - 1).s, 0), 'hi', coalesce(get(z, i + 1).e, size(lines)))))""")).alias("z")))
    part = lambda a, b: F.slice("lines", F.col(a) + 1, F.col(b) - F.col(a))
    d = (d.select("id", "rk", "lines", "z.*")
         .withColumn("chunk", F.array_join(part("s", "e"), _NL)))
    return d.select("id", "rk", "whole", "s", "e", "chunk", part("lo", "s").alias("left"), part("e", "hi").alias("right"),
                    F.unhex(F.md5(F.concat(F.when(F.col("whole"), "w").otherwise("c"), F.col("chunk")))).alias("key"))


def _grown(side: str, at: str) -> str:
    """SQL of the number of lines of ``side``, nearest first, that follow ``at``."""
    return (f"aggregate({side}, named_struct('n', 0, 'on', true), (a, x) -> if(a.on AND get(lines, {at}) <=> x,"
            f" named_struct('n', a.n + 1, 'on', true), named_struct('n', a.n, 'on', false)), a -> a.n)")


def drop_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         divisor: int = DIVISOR, out_col: str = "kept_text", alone: int = ALONE) -> DataFrame:
    """The input with three more columns: ``out_col`` (the lines that stay),
    n_lines and n_removed_lines."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = row.select("row", F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").cast("string").alias("text"))
    with scratch(docs.sparkSession) as tmp:
        places = tmp.keep(_chunks(base, divisor, alone).select("key", "whole", "id", "rk", "s", "e").distinct())
        again = tmp.keep(places.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("id", "rk", "s")).alias("first"))
                         .filter("n > 1"))
        # Hot keys' places are dealt over salts; fewer than HOT keys can pass the bound.
        most = max((again.agg(F.sum("n")).first()[0] or 0) // HOT, 4096)
        hot = F.broadcast(again.filter(F.col("n") > most).select("key", F.ceil(F.col("n") / most).alias("salts")))

        def dealt(d: DataFrame) -> DataFrame:
            return (d.join(hot, "key", "left").drop("salt")
                    .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("rk", "s"), "salts"), F.lit(0))).drop("salts"))

        def copied(d: DataFrame) -> DataFrame:
            return (d.join(hot, "key", "left")
                    .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)) - 1)))
                    .drop("salts"))

        rest = tmp.keep(dealt(places).join(copied(again.select("key", "first")), ["key", "salt"])
                        .filter(~(F.col("rk").eqNullSafe(F.col("first.rk")) & (F.col("s") == F.col("first.s"))))
                        .select("key", "salt", "whole", "rk", "s", "e"))
        # An exact copy goes whole: its chunks need no bytes.
        rest = tmp.keep(rest.filter("NOT whole").join(rest.filter("whole").select("rk").distinct(), "rk", "left_anti")
                        .select("key", "salt", "rk", "s", "e")
                        .unionByName(rest.filter("whole").select("key", "salt", "rk", "s", "e")))
        holders = tmp.keep(again.join(rest.select("key").distinct(), "key", "left_semi")
                           .select("key", F.col("first.rk").alias("rk"), F.col("first.s").alias("s")))
        first = (base.select("id", "text", _row_key(F.col("id"), F.col("text")).alias("hk"))
                 .join(holders.select(F.col("rk").alias("hk")).distinct().hint("merge"), "hk", "left_semi")
                 .dropDuplicates(["hk"]))
        # One plan at all sizes; a holder's key is one row, so bytes need no further step.
        bytes_ = tmp.keep(_chunks(first, divisor, alone).join(holders.hint("merge"), ["key", "rk", "s"], "left_semi")
                          .select("key", "chunk", "left", "right"))
        out = materialize(rest.join(copied(bytes_), ["key", "salt"]).groupBy("rk")
                          .agg(F.sort_array(F.collect_list(F.struct("s", "e", "chunk", "left", "right"))).alias("out")))
    lines = (base.select("row", _row_key(F.col("id"), F.col("text")).alias("rk"))
             .join(out, "rk", "left").withColumn("text", F.col(f"row.`{text_col}`").cast("string"))
             .select("row", "text", F.split("text", _NL, -1).alias("lines"), "out")
             .withColumn("out", F.expr(
                 f"filter(out, z -> array_join(slice(lines, z.s + 1, z.e - z.s), '{_NL}') = z.chunk)"))
             .withColumn("out", F.expr(
                 f"""transform(out, z -> named_struct('s', z.s - {_grown('reverse(z.left)', 'z.s - 1 - a.n')},
                     'e', z.e + {_grown('z.right', 'z.e + a.n')}, 's0', z.s, 'e0', z.e))""")))
    # What stays are the stretches between removed chunks, in order; a chunk grows into no other.
    lines = lines.withColumn("stay", F.expr("""filter(transform(sequence(0, size(out)), i -> named_struct(
        'a', if(i = 0, 0, least(get(out, i - 1).e, coalesce(get(out, i).s0, size(lines)))),
        'b', if(i = size(out), size(lines), greatest(get(out, i).s, coalesce(get(out, i - 1).e0, 0))))), z -> z.a < z.b)"""))
    stay = F.expr(f"array_join(transform(stay, z -> array_join(slice(lines, z.a + 1, z.b - z.a), '{_NL}')), '{_NL}')")
    some = F.coalesce(F.size("out"), F.lit(0)) > 0
    kept = [c for c in docs.columns if c not in (out_col, "n_lines", "n_removed_lines")]
    # One row out of an array of one: a condition on the result stays above this step. In a plain
    # projection it would move below the join with all the arrays it reads, copied into every lambda.
    done = lines.select("row", F.explode(F.array(F.struct(
        F.when(some, stay).otherwise(F.col("text")).alias("kept"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(some, F.size("lines") - F.expr("aggregate(stay, 0, (a, z) -> a + z.b - z.a)"))
        .otherwise(F.lit(0)).cast("long").alias("n_removed_lines")))).alias("done"))
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], F.col("done.kept").alias(out_col),
                       "done.n_lines", "done.n_removed_lines")
