"""Fuzzy name matching without comparing all pairs.

Two texts within edit distance D keep all but D of any disjoint segments of one
of them intact, at nearly the same position. Each text on the indexed side is
cut into more than D+1 segments and indexed under its D+1 rarest ones only, so
a segment that most texts share ("https://", " primary school") does not pair
them all up. The probing side lists the substrings that could equal a segment;
an equi-join on (length, segment number, segment text) yields the candidates,
and only those are compared. Distinct texts are matched, so copies collapse first.

Where a low threshold or a common build leaves segments that most texts share,
the index would list a pair many times. All pairs are fewer then: they meet in
tiles, once each, and two bitset tests decide most of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.similarity import edit_similarity, edits
from leasegrid.operators.ordering import _as_col, running_totals, top_per_key
from leasegrid.session import cut_lineage, exchanged

_SLACK = 1e-9


def _allowed(a: Column, b: Column, threshold: float) -> Column:
    """Largest edit distance compatible with the threshold for two lengths."""
    return F.floor(F.greatest(a, b) * F.lit(1 - threshold) + F.lit(_SLACK)).cast("int")


def _needed(length: Column, threshold: float) -> Column:
    """Segments an indexed text needs: one more than the most edits any partner allows."""
    return _allowed(F.floor(length / threshold + F.lit(_SLACK)).cast("int"), length, threshold) + 1


def _segments(length: Column, needed: Column) -> Column:
    """Segments to cut: up to twice the needed number while they stay four characters long."""
    return F.least(needed * 2, F.greatest(needed, F.floor(length / 4))).cast("int")


def _pair_bits(text: Column) -> Column:
    """256-bit set of the text's character pairs, as four longs.

    One edit removes at most two pairs, so texts within D edits miss at most
    2 D of each other's bits: a cheap test before the exact comparison.
    """
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))),
        lambda i: F.pmod(F.hash(F.substring(text, i, F.lit(2))), F.lit(256)),
    )

    def word(k: int) -> Column:
        mine = F.filter(pairs, lambda x: F.shiftright(x, 6) == k)
        return F.aggregate(
            mine, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x % 64))
        )

    return F.struct(*[word(k).alias(f"b{k}") for k in range(4)])


def _missing(a: str, b: str) -> Column:
    out = F.lit(0)
    for k in range(4):
        out = out + F.bit_count(F.col(f"{a}.b{k}").bitwiseAND(F.bitwise_not(F.col(f"{b}.b{k}"))))
    return out


def _start(j: Column, length: Column, parts: Column) -> Column:
    return F.floor(j * length / parts).cast("int")


def _index(texts: DataFrame, threshold: float, by: Sequence[str], text: str) -> DataFrame:
    """Rows of ``texts`` under their rarest segments: keys ``__n, __j, __seg`` and pair bits ``__bm``.

    Texts are distinct within ``by``.
    """
    n, j = F.col("__n"), F.col("__j")
    needed = _needed(n, threshold)
    # Texts too short to cut are met by length alone.
    numbers = F.when(needed > n, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("__s") - 1))
    p = _start(j, n, F.col("__s"))
    q = _start(j + 1, n, F.col("__s")) - p
    cut = texts.withColumn("__bm", _pair_bits(F.col(text))).withColumn("__n", F.length(text)).withColumn("__s", _segments(n, needed))
    cut = cut.withColumn("__j", F.explode(numbers))
    cut = cut.withColumn("__seg", F.when(j < 0, F.lit("")).otherwise(F.substring(text, p + 1, q))).drop("__s")
    key = [*by, "__n", "__j", "__seg"]
    common = cut.groupBy(*key).agg(F.count("*").alias("__f"))
    rarest = Window.partitionBy(*by, text).orderBy("__f", "__j")  # a text's own segments
    return cut.join(exchanged(common), key).withColumn("__r", F.row_number().over(rarest)).where(F.col("__r") <= needed).drop("__r", "__f")


def _probes(texts: DataFrame, threshold: float, text: str) -> DataFrame:
    """Rows of ``texts`` under every substring that could equal a partner's segment; pair bits ``__bt``."""
    n, j = F.col("__n"), F.col("__j")
    needed = _needed(n, threshold)
    numbers = F.when(needed > n, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("__s") - 1))
    p = _start(j, n, F.col("__s"))
    q = _start(j + 1, n, F.col("__s")) - p
    la = F.col("__m")
    low = F.greatest(F.floor(la * threshold - F.lit(_SLACK)).cast("int"), F.lit(1))
    high = F.ceil(la / threshold).cast("int")
    edits = _allowed(la, n, threshold)
    shift = la - n
    probe = texts.withColumn("__bt", _pair_bits(F.col(text))).withColumn("__m", F.length(text)).withColumn("__n", F.explode(F.sequence(low, high)))
    probe = probe.where(F.abs(shift) <= edits).withColumn("__d", edits)
    probe = probe.withColumn("__s", _segments(n, needed)).withColumn("__j", F.explode(numbers))
    probe = probe.withColumn("__p", p).withColumn("__q", q)
    # A segment moved by s costs |s| edits before it and |shift - s| after it.
    first = F.greatest(F.col("__p") + F.ceil((shift - F.col("__d")) / 2).cast("int"), F.lit(0))
    last = F.least(F.col("__p") + F.floor((shift + F.col("__d")) / 2).cast("int"), la - F.col("__q"))
    spots = F.when(first <= last, F.sequence(first, last))
    # a substring that stands at several places is probed once
    found = F.array_distinct(F.transform(spots, lambda a: F.substring(F.col(text), a + 1, F.col("__q"))))
    seg = F.explode(F.when(j < 0, F.array(F.lit(""))).otherwise(found))
    return probe.withColumn("__seg", seg).drop("__m", "__d", "__s", "__p", "__q")


def _near(text: str, match: str, threshold: float) -> Column:
    """The pair bits allow the threshold, and the edit distance (given up beyond the allowed one) meets it."""
    within = _allowed(F.length(text), F.length(match), threshold)
    bits = (_missing("__bt", "__bm") <= within * 2) & (_missing("__bm", "__bt") <= within * 2)
    edits = F.call_function("levenshtein", F.col(text), F.col(match), within)
    return bits & (edits >= 0) & (1 - edits / F.greatest(F.length(text), F.length(match)) >= threshold)


#: Rows of one side that meet in a tile, at most about; tiles a task gets at least.
_TILE_ROWS, _TILES_PER_TASK = 2048, 16
#: Pairs that are met in tiles without asking what the index would list; texts asked for that; what a probe and a listed pair cost, in pairs of a tile.
_FEW_PAIRS, _ASKED, _PROBE_COST, _LISTED_COST = 1_000_000, 200, 8, 2
#: Signs are counted in so many classes, up to so many times: four longs.
_CLASSES, _TIMES = 32, 8


def _sign_counts(text: Column) -> Column:
    """How often each class of signs occurs, in unary, as four longs.

    One edit adds at most one sign and removes at most one, so of texts within
    D edits neither has more than D of these bits that the other has not.
    """
    signs = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.pmod(F.hash(F.substring(text, i, F.lit(1))), F.lit(_CLASSES)))
    share = _CLASSES // 4

    def word(k: int) -> Column:
        def bits(c: Column) -> Column:
            times = F.least(F.size(F.filter(signs, lambda x: x == c + k * share)), F.lit(_TIMES))
            return F.call_function("shiftleft", F.call_function("shiftleft", F.lit(1).cast("bigint"), times) - 1, c * _TIMES)

        return F.aggregate(F.sequence(F.lit(0), F.lit(share - 1)), F.lit(0).cast("bigint"), lambda acc, c: acc.bitwiseOR(bits(c)))

    return F.struct(*[word(k).alias(f"b{k}") for k in range(4)])


def _tiled(texts: DataFrame, text: str, own: str, blocks: int, other: str, others: int, length: str, bits: str, counts: str) -> DataFrame:
    """Rows with their length, bitsets and block ``own``, once for every block ``other`` of the other side."""
    texts = texts.withColumn(bits, _pair_bits(F.col(text))).withColumn(counts, _sign_counts(F.col(text)))
    texts = texts.withColumn(length, F.length(text)).withColumn(own, F.pmod(F.xxhash64(text), F.lit(blocks)).cast("int"))
    return texts.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _pairs_in_tiles(a: DataFrame, b: DataFrame, sizes: tuple[int, int], threshold: float, by: list[str], text: str, mirrored: bool) -> DataFrame:
    """(by, text, match, similarity) of the similar ones among all pairs, each met once. ``mirrored``: both sides are the same texts, and one order of a pair answers for both."""
    spread = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = math.ceil(math.sqrt(_TILES_PER_TASK * spread))
    rows, columns = (max(least, math.ceil(n / _TILE_ROWS)) for n in sizes)
    # the bitsets cost far more than the few bytes of a text tell, so small inputs are spread over all tasks first
    left = _tiled(a.repartition(spread), text, "__row", rows, "__column", columns, "__m", "__bt", "__ct")
    right = _tiled(b.repartition(spread), "match", "__column", columns, "__row", rows, "__n", "__bm", "__cm")
    if mirrored:
        left, right = (side.where(F.col("__row") <= F.col("__column")) for side in (left, right))
    tile = [*by, "__row", "__column"]
    left, right = (side.repartition(spread, *tile) for side in (left, right))  # few bytes make many pairs
    within = _allowed(F.col("__m"), F.col("__n"), threshold)
    fits = (F.abs(F.col("__m") - F.col("__n")) <= within) & (_missing("__ct", "__cm") <= within) & (_missing("__cm", "__ct") <= within)
    fits = fits & (_missing("__bt", "__bm") <= within * 2) & (_missing("__bm", "__bt") <= within * 2)
    if mirrored:
        fits = fits & ((F.col("__row") < F.col("__column")) | (F.col(text) <= F.col("match")))
    likeness = 1 - edits(F.col(text), F.col("match")) / F.greatest("__m", "__n")
    near = left.join(exchanged(right), tile).where(fits).select(*by, text, "match", likeness.alias("similarity")).where(F.col("similarity") >= threshold)
    if mirrored:
        turned = F.explode(F.when(F.col(text) == F.col("match"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
        near = near.withColumn("__turned", turned)
        side = lambda x, y: F.when(F.col("__turned"), F.col(y)).otherwise(F.col(x)).alias(x)
        near = near.select(*by, side(text, "match"), side("match", text), "similarity")
    return near


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, by: Sequence[str] = (), text: str = "text") -> DataFrame:
    """All (by, text, match, similarity) with edit similarity >= threshold, over distinct texts.

    A few probing texts tell how many pairs the segment index would list. Both
    ways give the same rows; the cheaper one is taken.
    """
    by = list(by)
    a = left.select(*by, F.col(text)).where(F.length(text) > 0).distinct()
    b = right.select(*by, F.col(text).alias("match")).where(F.length("match") > 0).distinct()
    same = left is right or left.sameSemantics(right)
    texts_a = a.count()
    texts_b = texts_a if same else b.count()
    tiles = lambda: _pairs_in_tiles(a, b, (texts_a, texts_b), threshold, by, text, same)
    groups = a.groupBy(*by).agg(F.count("*").alias("__a")), b.groupBy(*by).agg(F.count("*").alias("__b"))
    pairs = texts_a * texts_b if not by else groups[0].join(exchanged(groups[1]), by).agg(F.sum(F.col("__a") * F.col("__b"))).first()[0] or 0
    if pairs <= _FEW_PAIRS:
        return tiles()
    # Cutting multiplies rows, so small inputs are spread over all tasks first.
    spread = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = cut_lineage(_index(b.repartition(spread), threshold, by, "match"))
    key = [*by, "__n", "__j", "__seg"]
    asked = a.where(F.pmod(F.xxhash64(text), F.lit(math.ceil(texts_a / _ASKED))) == 0)
    listed = _probes(asked.repartition(spread), threshold, text).join(exchanged(index.groupBy(*key).agg(F.count("*").alias("__f"))), key, "left")
    probes, met, n = listed.agg(F.count("*"), F.sum("__f"), F.count_distinct(*by, text)).first()
    if n and pairs <= (_PROBE_COST * probes + _LISTED_COST * (met or 0)) * texts_a / n * (2 if same else 1):
        return tiles()
    # Compared inside the join stage; only true matches are deduplicated.
    probe = _probes(a.repartition(spread), threshold, text)
    near = probe.join(exchanged(index), key).where(_near(text, "match", threshold)).select(*by, text, "match")
    return near.distinct().withColumn("similarity", edit_similarity(F.col(text), F.col("match")))


#: Index entries of a segment met in the first round; each round meets four times as many as the one before.
_FIRST_ROUND, _GROWTH = 16, 4


def fuzzy_dedup(df: DataFrame, name: str, block: Sequence[str], order: Sequence[Column | str], threshold: float = 0.99) -> DataFrame:
    """Drop a row if an earlier row of the same block has a similar enough name.

    Only the first row of each (block, name) can survive, and it does so unless
    a similar name in the block starts earlier. Rows with a NULL name or block
    value never match and stay.

    One earlier similar name is enough, so pairs are not listed. The names under
    a segment are numbered by their start. Every name meets the earliest ones
    first; names that are decided leave, and the others meet the next, four
    times as many, until no candidate is left. A pile of near-identical names is
    thus decided by its first few.
    """
    block = list(block)
    usable = F.col(name).isNotNull()
    for c in block:
        usable = usable & F.col(c).isNotNull()
    rank = F.struct(*[_as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    rows = df.where(usable).withColumn("__o", rank)
    first = cut_lineage(top_per_key(rows, [*block, name], ["__o"], largest=False))
    keys = [f"__k{i}" for i in range(len(block))]
    starts = first.where(F.length(name) > 0).select(*[F.col(c).alias(k) for c, k in zip(block, keys)], F.col(name).alias("__text"), "__o")
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = starts.repartition(spread)
    segment = [*keys, "__n", "__j", "__seg"]
    index = _index(starts, threshold, keys, "__text").withColumnsRenamed({"__text": "__match", "__o": "__e"}).withColumn("__one", F.lit(1))
    index = cut_lineage(running_totals(index, ["__e"], "__one", segment, "__place").drop("__one"))
    longest = index.agg(F.max("__place")).first()[0] or 0
    probe = cut_lineage(_probes(starts, threshold, "__text"))
    found, low, size = [], 0, _FIRST_ROUND
    while low < longest:
        batch = index.where(F.col("__place").between(low + 1, low + size))
        met = probe.join(exchanged(batch), segment).where((F.col("__e") < F.col("__o")) & _near("__text", "__match", threshold))
        found.append(cut_lineage(met.select(*keys, "__text").distinct()))
        low, size = low + size, size * _GROWTH
        if low < longest:
            open_segments = index.where(F.col("__place") == low + 1).select(*segment, F.col("__e").alias("__next"))
            probe = probe.join(exchanged(found[-1]), [*keys, "__text"], "left_anti").join(exchanged(open_segments), segment)
            probe = cut_lineage(probe.where(F.col("__next") < F.col("__o")).drop("__next"))
    for part in found:
        gone = part.select(*[F.col(k).alias(c) for c, k in zip(block, keys)], F.col("__text").alias(name))
        first = first.join(exchanged(gone), [*block, name], "left_anti")
    return first.select(*df.columns).unionByName(df.where(~usable))


def match_names(
    df: DataFrame,
    names: DataFrame,
    column: str,
    name: str,
    payload: str,
    cutoff: float = 0.85,
    order: str | None = None,
) -> DataFrame:
    """Exact match on ``column`` = ``name``, else the most similar name >= cutoff.

    Duplicate names keep the payload with the largest ``order`` (default: the
    payload itself). Equal similarity goes to the larger name.
    """
    table = names.groupBy(F.col(name).alias("__name")).agg(F.max_by(payload, order or payload).alias("__v"))
    asked = df.select(F.col(column).alias("text")).where(F.col("text").isNotNull()).distinct()
    exact = asked.join(exchanged(table), asked["text"] == table["__name"]).select("text", "__v")
    rest = asked.join(exchanged(table), asked["text"] == table["__name"], "left_anti")
    pairs = similar_pairs(rest, table.select(F.col("__name").alias("text")), cutoff)
    best = pairs.groupBy("text").agg(F.max_by("match", F.struct("similarity", "match")).alias("__name"))
    fuzzy = best.join(exchanged(table), "__name").select("text", "__v")
    found = exact.unionByName(fuzzy).withColumnsRenamed({"text": column, "__v": payload})
    return df.join(exchanged(found), column, "left")


def rank_schools(schools: DataFrame, ranks: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """vic_secondary_rank by name; unmatched secondary schools take the rank after the last."""
    from leasegrid.functions.text import normalise_name

    table = (
        ranks.withColumn("vic_secondary_rank", F.col("vic_secondary_rank").cast("string").try_cast("int"))
        .where(F.col("vic_secondary_rank").isNotNull())
        .withColumn("name_norm", normalise_name(F.trim("school_name")))
    )
    asked = schools.withColumn("__norm", normalise_name(F.col("school_name")))
    matched = match_names(asked, table, "__norm", "name_norm", "vic_secondary_rank", cutoff)
    secondary = F.lower(F.trim("school_type")).isin("secondary", "pri/sec")
    rank = F.coalesce("vic_secondary_rank", F.when(secondary, F.lit(C.UNRANKED_SECONDARY_RANK)))
    return matched.withColumn("vic_secondary_rank", rank).drop("__norm")
