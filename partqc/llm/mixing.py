"""Temperature mixing of sources under a token budget.

Source weights are the token shares raised to an exponent and normalised.  At 1
they are the natural shares, at 0 all sources weigh the same.  Bisection (each pass
cuts the interval into ``POINTS`` by one aggregation over the sources) finds the largest exponent whose weights reach ``target_entropy`` (a fraction of the
most that these sources allow), then, if a source would be repeated more than
``max_repeats`` times, the smallest larger exponent that respects the limit
(where even the natural shares exceed it, 1).

The weights are realised as block permutations: a source's documents are dealt
into blocks of about ``block_rows`` rows by a hash of id and text; every pass over
the source orders the blocks anew, and the rows of a block anew inside it.  As
many whole passes are taken as the source's share of the budget holds, then the
first rows of one more whose tokens fit the rest.

Only block totals are put in order by a window (one row per ``block_rows``
documents); rows are ranked only in the one block of a source where the budget
ends, and rows that repeat id and text are one row with a count there.  No source,
hot or not, is gathered in a task, and neither are the sources: the driver gets two
sums for each exponent tried.

Nulls and oddities: a null source is a source of its own; null and empty texts
have no tokens and are never drawn, nor are sources without tokens; rows that
repeat an id are drawn alike, the budget's last ones in the order of their token
counts and texts; rows that repeat id and text are alike, so of a group that fits
the budget's rest in part any may stand for it; a null id is dealt like an id; columns of the input pass
through unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partqc.functions.hashing import seeded_hash, seeded_u32
from partqc.llm.common import WORD, materialize, tokens_of

POINTS, PASSES = 1024, 5  # 1024 ** 5 = 2 ** 50 places between 0 and 1


def _grid(totals: DataFrame, total: int, ends: list[tuple[float, float]], points: int) -> list[dict]:
    """For every interval (lo, hi) of ``ends``, by place i of ``points`` on it: the
    exponent, and over all sources the sums z of share ** m and s of share ** m * ln(share)."""
    share = F.col("tokens") / F.lit(float(total))
    interval = F.floor(F.col("g") / points)
    lo = F.element_at(F.array(*[F.lit(a) for a, _ in ends]), (interval + 1).cast("int"))
    step = F.element_at(F.array(*[F.lit((b - a) / points) for a, b in ends]), (interval + 1).cast("int"))
    rows = (totals.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(points * len(ends) - 1))))
            .withColumn("m", lo + step * (F.col("g") % points))
            .withColumn("x", F.col("k") * F.pow(share, F.col("m")))
            .groupBy("g").agg(F.first("m").alias("m"), F.sum("x").alias("z"), F.sum(F.col("x") * F.log(share)).alias("s")).collect())
    out: list[dict] = [{} for _ in ends]
    for r in rows:
        out[r["g"] // points][r["g"] % points] = r
    return out


def find_exponent(totals: DataFrame, total: int, sources: int, least: int, target_entropy: float,
                  max_repeats: float, budget: float) -> float:
    """The exponent from (tokens, k): k sources have as many tokens.  Every pass
    tries ``POINTS`` exponents of both borders' intervals in one aggregation; the
    driver gets two sums of each, however many sources there are."""
    goal, p0 = target_entropy * math.log(sources), least / total
    holds = {  # whether a border lies above an exponent or at it
        "entropy": lambda r: math.log(r["z"]) - r["m"] * r["s"] / r["z"] >= goal,
        # The most repeated source is the smallest: its weight over its share, times the budget.
        "repeats": lambda r: budget * p0 ** r["m"] / r["z"] / p0 > max_repeats,
    }
    ends = {"entropy": (0.0, 1.0)}
    if budget / sources / p0 > max_repeats:
        ends["repeats"] = (0.0, 1.0)
    for _ in range(PASSES):
        for name, by in zip(ends, _grid(totals, total, list(ends.values()), POINTS)):
            lo, hi = ends[name]
            step, at = (hi - lo) / POINTS, 0
            while at + 1 < POINTS and holds[name](by[at + 1]):
                at += 1
            ends[name] = (lo + at * step, lo + (at + 1) * step)
    return max(ends["entropy"][0], ends["repeats"][1] if "repeats" in ends else 0.0)


def source_weights(sources: DataFrame, target_entropy: float, max_repeats: float, budget: float) -> DataFrame:
    """Adds exponent, weight and quota to rows with ``source`` and ``tokens`` (those
    without tokens go); quota is the source's tokens of a budget that is ``budget``
    times all tokens, rounded to thousandths, then down to a whole one."""
    some = sources.filter("tokens > 0")
    totals = materialize(some.groupBy("tokens").agg(F.count("*").alias("k")))
    all_ = totals.agg(F.sum(F.col("tokens") * F.col("k")).alias("total"), F.sum("k").alias("n"),
                      F.min("tokens").alias("least")).first()
    e, z, total = 0.0, 1.0, all_["total"] or 1
    if all_["n"]:
        e = find_exponent(totals, total, all_["n"], all_["least"], float(target_entropy), float(max_repeats), float(budget))
        z = _grid(totals, total, [(e, e)], 1)[0][0]["z"]
    weight = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(e)) / F.lit(z)
    return (some.withColumn("exponent", F.lit(e)).withColumn("weight", weight)
            .withColumn("quota", F.floor(F.round(F.col("weight") * (float(budget) * total), 3)).cast("long")))


def _block(seed: int, id_: Column, tie: Column, blocks: Column) -> Column:
    return seeded_u32(seed, [id_, tie]) % blocks


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                target_entropy: float = 0.95, max_repeats: float = 4.0, budget: float = 1.0,
                block_rows: int = 4096, seed: int = 5) -> DataFrame:
    """One row per draw: the input's columns and n_tokens, epoch (pass over the
    source, from 0), block_rank (place of the row's block in that pass, from 1)."""
    id_ = F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit("null"))
    text = F.col(f"row.`{text_col}`")
    # Rows with words; counted where they are needed, as counting is what costs.
    base = (docs.filter(F.col(f"`{text_col}`").rlike(WORD))
            .select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .withColumn("key", id_)
            .withColumn("source", F.col(f"row.`{source_col}`"))
            .withColumn("tie", F.conv(F.substring(F.md5(text.cast("string")), 1, 15), 16, 10).cast("long")))
    counted = base.withColumn("n_tokens", tokens_of(text))
    narrow = materialize(counted.groupBy("key", "source", "n_tokens", "tie").agg(F.count("*").alias("c")))
    size = materialize(narrow.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("c")).alias("tokens"), F.sum("c").alias("n")))
    plan = (source_weights(size, target_entropy, max_repeats, budget)
            .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("long"))
            .withColumn("whole", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
            .withColumn("rest", F.col("quota") - F.col("whole") * F.col("tokens")))
    plan = materialize(plan.select("source", "blocks", "whole", "rest"))

    def with_plan(d: DataFrame) -> DataFrame:
        p = plan.select(F.col("source").alias("ps"), "blocks", "whole", "rest")
        return (d.join(p, F.col("source").eqNullSafe(F.col("ps"))).drop("ps")
                .withColumn("block", _block(seed, F.col("key"), F.col("tie"), F.col("blocks"))))

    # Block totals, permuted once per pass.
    total = with_plan(narrow).groupBy("source", "block", "whole", "rest").agg(F.sum(F.col("n_tokens") * F.col("c")).alias("t"))
    passes = total.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    passes = passes.withColumn("order", seeded_hash(seed, [F.col("epoch"), F.lit("block"), F.col("block")]))
    in_pass = Window.partitionBy("source", "epoch").orderBy("order", "block")
    passes = (passes.withColumn("block_rank", F.row_number().over(in_pass).cast("long"))
              .withColumn("before", F.sum("t").over(in_pass) - F.col("t")))
    # state: 2 the whole block, 1 as much as fits.
    passes = materialize(
        passes.withColumn("state", F.when(F.col("epoch") < F.col("whole"), 2)
                          .when(F.col("before") + F.col("t") <= F.col("rest"), 2)
                          .when(F.col("before") < F.col("rest"), 1))
        .filter("state IS NOT NULL")
        .select(F.col("source").alias("ps"), F.col("block").alias("pb"), "epoch", "block_rank", "state",
                (F.col("rest") - F.col("before")).alias("room")))
    # Rows of the block where a source's budget ends.
    same = F.col("source").eqNullSafe(F.col("ps")) & (F.col("block") == F.col("pb"))
    ends = passes.filter("state = 1")
    last = with_plan(narrow).select("key", "source", "block", "n_tokens", "tie", "c").join(ends, same)
    in_block = (Window.partitionBy("source", "block")
                .orderBy(seeded_hash(seed, [F.col("epoch"), F.lit("row"), F.col("key")]), "n_tokens", "tie")
                .rowsBetween(Window.unboundedPreceding, 0))
    of_like = F.col("n_tokens") * F.col("c")  # rows that repeat id and text
    last = (last.withColumn("left", F.col("room") - F.sum(of_like).over(in_block) + of_like)
            .withColumn("fit", F.least(F.col("c"), F.floor(F.col("left") / F.col("n_tokens")))).filter("fit > 0")
            .select(F.col("key").alias("lk"), F.col("source").alias("ls"), F.col("n_tokens").alias("ln"),
                    F.col("tie").alias("lt"), "c", "fit"))
    full = with_plan(counted).join(passes.filter("state = 2"), same)
    # Their counts come with ``last``: texts are not counted, nor moved for it.
    part = (with_plan(base).join(ends, same)
            .join(last, (F.col("key") == F.col("lk")) & F.col("source").eqNullSafe(F.col("ls")) & (F.col("tie") == F.col("lt")))
            .withColumnRenamed("ln", "n_tokens"))
    # At most one group of like rows per source fits in part.
    nth = F.row_number().over(Window.partitionBy("key", "source", "n_tokens", "tie").orderBy("epoch"))
    some = part.filter("fit < c").withColumn("nth", nth).filter("nth <= fit").drop("nth")
    part = part.filter("fit = c").unionByName(some)
    out = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("n_tokens", "epoch", "block_rank")]
    return full.select(*out, "n_tokens", "epoch", "block_rank").unionByName(
        part.select(*out, "n_tokens", "epoch", "block_rank"))
