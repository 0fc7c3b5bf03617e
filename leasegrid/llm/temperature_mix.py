"""Temperature mixing of sources, realised as budgeted block permutations.

Token shares p are sharpened or flattened to w = p^t / sum p^t. The exponent t
is bisected until the weights reach a target entropy or keep every source
within a repetition limit. Each source then spends its part of the token budget
on whole passes over its documents, each pass a permutation of hash blocks, and
on the head of one more permutation. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leasegrid.llm.common import broadcast_if_small, fresh
from leasegrid.session import cut_lineage

#: Halvings of one pass over the sources, and passes: an exponent to 2^-30.
HALVINGS, PASSES = 5, 6
#: Hex digits of the order key that name a block; two levels of blocks are summed before any row is ranked.
BLOCK_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """Sources as a DataFrame (source, docs, tokens, weight, budget, epochs, rest) and the exponent found."""

    sources: DataFrame
    exponent: float


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in the permutation of one pass: a hex digest; a null id counts as empty text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _holds(shares: DataFrame, exponents: list[float], entropy: float | None, repetition: float | None, budget_ratio: float | None) -> list[bool]:
    """For every exponent: does it meet the target (entropy at least, or repetition at most)?"""
    aggs = []
    for i, t in enumerate(exponents):
        aggs += [F.sum(F.exp(t * F.col("lp"))).alias(f"z{i}"), F.sum(F.exp(t * F.col("lp")) * F.col("lp")).alias(f"s{i}")]
    r = shares.agg(F.min("lp").alias("low"), F.max("lp").alias("high"), *aggs).first()
    met = []
    for i, t in enumerate(exponents):
        if entropy is not None:
            met.append(math.log(r[f"z{i}"]) - t * r[f"s{i}"] / r[f"z{i}"] >= entropy)
        elif budget_ratio is None:
            met.append((1 - t) * (r["high"] - r["low"]) <= math.log(repetition))
        else:
            met.append(math.log(budget_ratio) + (t - 1) * r["low"] - math.log(r[f"z{i}"]) <= math.log(repetition))
    return met


def plan_mix(
    counted: DataFrame,
    entropy_ratio: float | None = None,
    max_repetition: float | None = None,
    budget_ratio: float | None = 1.0,
) -> Mix:
    """Weights and budgets per source from frozen rows ``(source, tokens)``.

    Give one target: ``entropy_ratio`` takes the largest exponent in [0, 1] whose
    weights have that share of the greatest possible entropy; ``max_repetition``
    the smallest exponent at which no source is read more often than that. A
    target the exponent 1 cannot meet keeps 1. ``budget_ratio`` is the budget as
    a multiple of all tokens; None takes the smallest budget that reads every
    document at least once. Sources without tokens have no weight and one pass.
    """
    if (entropy_ratio is None) == (max_repetition is None):
        raise ValueError("give one of entropy_ratio and max_repetition")
    sources = cut_lineage(counted.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")))
    total, live = sources.agg(F.sum("tokens"), F.count(F.when(F.col("tokens") > 0, 1))).first()
    shares = sources.where("tokens > 0").withColumn("lp", F.log(F.col("tokens") / F.lit(float(total or 1))))
    low, high = 0.0, 1.0
    if live:
        entropy = None if entropy_ratio is None else entropy_ratio * math.log(live)

        def met(points: list[float]) -> list[bool]:
            return _holds(shares, points, entropy, max_repetition, budget_ratio)

        at0, at1 = met([0.0, 1.0])
        if (entropy is not None and at1) or not (at0 or at1):
            low = high = 1.0
        elif entropy is None and at0:
            low = high = 0.0
        for _ in range(PASSES if low < high else 0):
            # the interior points of HALVINGS halvings, judged in one pass over the sources
            step = (high - low) / 2**HALVINGS
            points = [low + step * i for i in range(1, 2**HALVINGS)]
            good = met(points)
            if entropy is not None:  # met below the answer
                n = sum(good)
                low, high = low + step * n, low + step * (n + 1)
            else:  # met above the answer
                n = len(good) - sum(good)
                low, high = low + step * n, low + step * (n + 1)
    exponent = low if entropy_ratio is not None else high
    z, spread = (shares.agg(F.sum(F.exp(exponent * F.col("lp"))), F.max((1 - exponent) * F.col("lp"))).first() if live else (1.0, 0.0))
    if budget_ratio is None:
        budget = float(total or 0) * z * math.exp(spread)
    else:
        budget = float(total or 0) * budget_ratio
    tokens = F.col("tokens")
    weight = F.when(tokens > 0, F.exp(exponent * F.log(tokens / F.lit(float(total or 1)))) / F.lit(z))
    epochs = F.when(tokens > 0, F.floor(F.col("budget") / tokens + 1e-9)).otherwise(1).cast("long")
    planned = sources.withColumn("weight", weight).withColumn("budget", weight * F.lit(budget)).withColumn("epochs", epochs)
    rest = F.when(tokens > 0, F.greatest(F.lit(0.0), F.col("budget") - F.col("epochs") * tokens)).otherwise(0.0)
    return Mix(cut_lineage(planned.withColumn("rest", rest)), exponent)


def _cuts(counted: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Rows (source, epochs, cut): the last order key the partial pass still affords, null if none.

    Keys are summed by block, the block that crosses the rest is split into finer
    blocks, and only the crossing fine block is ranked key by key: no window
    holds more than the blocks of a source or the keys of one fine block.
    """
    part = counted.join(broadcast_if_small(cut_lineage(sources.select(F.col("source").alias("of"), "epochs", "rest"))),
                        F.col("source").eqNullSafe(F.col("of")))
    keyed = cut_lineage(part.where("rest > 0").groupBy(
        "source", "rest", order_key(seed, F.col("epochs"), F.col("doc_id")).alias("key")).agg(F.sum("tokens").alias("tokens")))
    block = [F.substring("key", 1, BLOCK_DIGITS), F.substring("key", 1, 2 * BLOCK_DIGITS), F.col("key")]
    found = None
    for level, name in enumerate(block):
        rows = keyed.withColumn("block", name)
        if level:
            rows = rows.join(
                broadcast_if_small(found.select(F.col("source").alias("of"), F.col("next"), F.col("spent"))),
                F.col("source").eqNullSafe(F.col("of")) & (block[level - 1] == F.col("next")),
            )
        else:
            rows = rows.withColumn("spent", F.lit(0).cast("long"))
        sums = rows.groupBy("source", "rest", "spent", "block").agg(F.sum("tokens").alias("tokens"))
        upto = F.col("spent") + F.sum("tokens").over(W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, 0))
        sums = sums.withColumn("upto", upto)
        fits = F.col("upto") <= F.col("rest")
        best = sums.groupBy("source").agg(
            F.max(F.when(fits, F.col("block"))).alias("whole"), F.max(F.when(fits, F.col("upto"))).alias("sum"),
            F.min(F.when(~fits, F.col("block"))).alias("next"), F.first("spent").alias("spent0"),
        ).withColumn("spent", F.coalesce("sum", "spent0"))
        if found is None:
            found = best.select("source", "whole", "next", "spent")
        else:
            finer = best.select(F.col("source").alias("of"), F.col("whole").alias("whole2"), F.col("next").alias("next2"), F.col("spent").alias("spent2"))
            found = found.join(finer, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source", F.coalesce("whole2", "whole").alias("whole"), F.col("next2").alias("next"), F.coalesce("spent2", "spent").alias("spent"))
        found = cut_lineage(found)
    return found.select("source", F.concat("whole", F.lit("~")).alias("cut"))  # all keys that start with the block sort before "~"


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    entropy_ratio: float | None = None,
    max_repetition: float | None = None,
    budget_ratio: float | None = 1.0,
    seed: int = 17,
    tokens: Column | None = None,
) -> DataFrame:
    """The mixed corpus: every column of ``docs`` plus ``epoch`` (from 0), one row per reading of a document.

    A source gets ``epochs`` whole passes and the head of one more, in the order
    of the keys of that pass, never beyond its budget. A null source is a source
    of its own; null and empty texts have no tokens and follow their source's
    passes. Rows that repeat an id share its place in the permutation and are in
    or out together. Clashing names are kept; ``epoch`` then gets an underscore.
    """
    count = word_count(F.col(text_col)) if tokens is None else tokens
    counted = cut_lineage(docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), count.alias("tokens")))
    mix = plan_mix(counted, entropy_ratio, max_repetition, budget_ratio)
    cuts = _cuts(counted, mix.sources, seed).withColumnRenamed("source", "of")
    plan = mix.sources.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    names, epochs, cut = (fresh(docs.columns, n) for n in ("__source", "__epochs", "__cut"))
    plan = cut_lineage(plan.select(F.col("source").alias(names), F.col("epochs").alias(epochs), F.col("cut").alias(cut)))
    joined = docs.join(broadcast_if_small(plan), F.col(source_col).eqNullSafe(F.col(names)))
    key = order_key(seed, F.col(epochs), F.col(id_col))
    times = F.col(epochs) + F.when(key <= F.col(cut), 1).otherwise(0)
    epoch = fresh(docs.columns, "epoch")
    ladder = F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))
    return joined.withColumn(epoch, F.explode(ladder)).drop(names, epochs, cut)
