"""Projection, filters, imputation, dedup, sampling, set operations, sort and limit."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.operators.ordering import _as_col, top_per_key
from leasegrid.operators.quantiles import exact_quantiles
from leasegrid.session import cut_lineage, exchanged

#: Groups up to which a table with one narrow row per group is broadcast.
FEW_GROUPS = 10_000

# --- columns ------------------------------------------------------------------


def snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in have])


def drop_present(df: DataFrame, names: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    gone = [c for c in df.columns if c in set(names) or c.startswith(tuple(prefixes))]
    return df.drop(*gone)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def quarter_keys(df: DataFrame, year: str = "year", quarter: str = "quarter") -> DataFrame:
    """quarter_year '3_2024' and quarter_id '2024Q3'."""
    y, q = F.col(year).cast("string"), F.col(quarter).cast("string")
    return df.withColumn("quarter_year", F.concat_ws("_", q, y)).withColumn(
        "quarter_id", F.concat(y, F.lit("Q"), q)
    )


def spatial_unit(df: DataFrame, suburb: str = "suburb", kind: str = "property_type") -> DataFrame:
    tail = F.replace(F.col(kind), F.lit(" "), F.lit("_"))
    return df.withColumn("spatial_unit", F.concat(F.col(suburb), F.lit("_"), tail))


def drop_sparse_columns(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Keep columns that are non-null in at least ``min_share`` of the rows (one pass)."""
    counts = df.agg(
        F.count("*").alias("__n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    ).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] >= min_share * counts["__n"]])


# --- filters ------------------------------------------------------------------


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset else None)


def keep_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def drop_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Null-safe deny list: NULLs stay."""
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def keep_large_groups(df: DataFrame, key: str, more_than: int = 10) -> DataFrame:
    """Rows whose key occurs more than ``more_than`` times (count, then semi join)."""
    big = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > more_than)
    return df.join(big.select(key), key, "left_semi")


def clip_quantiles(
    df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99, inclusive: bool = True
) -> DataFrame:
    """Both cuts computed on the same input, bounds kept by default."""
    bounds = exact_quantiles(df, column, [lower, upper], names=["lo", "hi"])
    b = bounds.select(F.struct("lo", "hi").alias("b")).scalar()
    v = F.col(column)
    if inclusive:
        return df.where((v >= b["lo"]) & (v <= b["hi"]))
    return df.where((v > b["lo"]) & (v < b["hi"]))


def clip_quantiles_in_turn(
    df: DataFrame, column: str, lower: float = 0.01, upper: float = 0.99
) -> DataFrame:
    """Strictly below the upper quantile, then strictly above the lower quantile of the rest."""
    top = exact_quantiles(df, column, [upper], names=["hi"]).scalar()
    rest = df.where(F.col(column) < top)
    bottom = exact_quantiles(rest, column, [lower], names=["lo"]).scalar()
    return rest.where(F.col(column) > bottom)


def filter_target(
    df: DataFrame,
    column: str,
    method: str | None = None,
    bounds: tuple[float, float] = (100, 3000),
    quantiles: tuple[float, float] = (0.01, 0.99),
) -> DataFrame:
    """Optional target filter: None, 'fixed' or 'quantile'."""
    if method is None:
        return df
    if method == "fixed":
        return df.where(F.col(column).between(*bounds))
    if method == "quantile":
        return clip_quantiles(df, column, *quantiles)
    raise ValueError(f"unknown method {method!r}")


def reliability_weights(
    df: DataFrame, year: str = "year", span: tuple[int, int] = (2020, 2021), low: float = 0.1
) -> DataFrame:
    unreliable = F.col(year).between(*span)
    return df.withColumn("weights", F.when(unreliable, low).otherwise(1.0)).withColumn(
        "is_unreliable", unreliable
    )


def split_at(df: DataFrame, column: str, boundary) -> tuple[DataFrame, DataFrame]:
    at = F.lit(boundary)
    return df.where(F.col(column) < at), df.where(F.col(column) >= at)


# --- imputation ----------------------------------------------------------------


def group_mode(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, ties to the smallest.

    Two partial aggregations (count per value, then best count), so a hot
    group's rows are reduced before they meet.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(column).alias("v")))
    return counts.groupBy(*by).agg(best.alias("__b")).select(*by, F.col("__b.v").alias(name))


def beside_groups(df: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """Left join of ``groups``, a table with one narrow row per value of ``by``.

    An exchange of all rows by few values fills few tasks, and adaptive
    execution keeps it where most partitions are empty; so the counted rows of
    few groups are broadcast. Many groups are exchanged by key, hot ones split.
    """
    frozen = cut_lineage(groups)
    few = frozen.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS
    return df.join(F.broadcast(frozen) if few else exchanged(frozen), by, "left")


def impute_mode(
    df: DataFrame, column: str, by: str, name: str | None = None, overall: bool = True
) -> DataFrame:
    """Fill NULLs with the group's mode, then (optionally) with the overall mode."""
    modes = group_mode(df, column, [by], "__mode")
    fills = [F.col(column), F.col("__mode")]
    if overall:
        fills.append(group_mode(df, column, name="__m").scalar())
    filled = F.coalesce(*fills)
    return beside_groups(df, modes, by).withColumn(name or column, filled).drop("__mode")


def impute_modes(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """``impute_mode`` of several like-typed columns at once: one long-form count serves
    every column, per group and overall."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns]))
    long = df.select(by, pairs.alias("p")).select(by, "p.c", "p.v").where(F.col("v").isNotNull())
    counts = cut_lineage(long.groupBy(by, "c", "v").agg(F.count("*").alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"]

    def wide(modes: DataFrame, *keys: str) -> DataFrame:
        return modes.groupBy(*keys).agg(*[F.max(F.when(F.col("c") == c, F.col("m"))).alias(f"__{c}") for c in columns])

    own = wide(counts.groupBy(by, "c").agg(best.alias("m")), by)
    whole = counts.groupBy("c", "v").agg(F.sum("n").alias("n")).groupBy("c").agg(best.alias("m"))
    any_type = wide(whole).select(F.struct(*[f"__{c}" for c in columns]).alias("s")).scalar()
    joined = beside_groups(df, own, by).withColumn("__any", any_type)
    filled = {c: F.coalesce(c, f"__{c}", f"__any.__{c}") for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def impute_overall_mode(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(
        column, F.coalesce(F.col(column), group_mode(df, column, name="__m").scalar())
    )


def coalesce_imputed(columns: Collection[str], base: str, suffix: str = "_imputed") -> Column | None:
    """Raw column first, imputed column second; None when the table has neither."""
    have = [F.col(f"`{c}`") for c in (base, base + suffix) if c in columns]
    return F.coalesce(*have) if have else None


def fill_counts(df: DataFrame, prefix: str = "count_") -> DataFrame:
    """0-fill count columns that contain NULLs and mark them ``_imputed``."""
    names = [c for c in df.columns if c.startswith(prefix)]
    gaps = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names]).first()
    holed = [c for c in names if gaps[c] > 0]
    filled = df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in holed})
    return filled.withColumnsRenamed({c: c + "_imputed" for c in holed})


def pending_rows(df: DataFrame, features: Sequence[str], mode: str = "any") -> DataFrame:
    """Rows still lacking features: 'any' or 'all' of the columns NULL."""
    nulls = [F.col(f"`{c}`").isNull() for c in features]
    op = (lambda a, b: a | b) if mode == "any" else (lambda a, b: a & b)
    return df.where(reduce(op, nulls))


# --- dedup and sampling ---------------------------------------------------------


def keep_latest(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the largest ``order`` tuple. End it in a unique column."""
    return top_per_key(df, [key] if isinstance(key, str) else list(key), order, largest=True)


def keep_earliest(df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return top_per_key(df, [key] if isinstance(key, str) else list(key), order, largest=False)


def drop_repeated_names(
    df: DataFrame, name: str, group: Sequence[str], order: Sequence[Column | str], more_than: int = 1
) -> DataFrame:
    """Drop every row of a name whose repeats (rows after the first) share ``group`` more than once.

    The first row per name is found by aggregation and subtracted from the
    group counts, so no per-name window is needed.
    """
    groups = [name, *[g for g in group if g != name]]
    # NULL group values never form a group.
    full = df.where(reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in groups]))
    first = top_per_key(
        df.where(F.col(name).isNotNull()).select(
            *groups, *[_as_col(c).alias(f"__o{i}") for i, c in enumerate(order)]
        ),
        [name],
        [f"__o{i}" for i in range(len(order))],
        largest=False,
    ).select(*groups, F.lit(1).alias("__first"))
    counts = full.groupBy(*groups).agg(F.count("*").alias("__n"))
    repeats = counts.join(first, groups, "left").where(
        F.col("__n") - F.coalesce(F.col("__first"), F.lit(0)) > more_than
    )
    return df.join(repeats.select(name).distinct(), name, "left_anti")


def stratified_sample(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    fraction: float = 0.5,
    seed: int = 42,
    score: Column | None = None,
    score_bits: int = 64,
    bucket_rows: int = 100_000,
) -> DataFrame:
    """Exactly round-half-even(fraction * size) rows per stratum; single rows always kept.

    Rows are ranked by a pseudo-random integer ``score`` of ``score_bits``
    bits. Large strata are first cut into score buckets: whole buckets below
    the threshold pass without sorting, and only the one bucket that holds the
    threshold is ranked. A stratum of any size therefore needs no task larger
    than about ``bucket_rows``.
    """
    strata = list(strata)
    if score is None:
        score, score_bits = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 1), 63
    scored = df.withColumn("__s", score)
    for c in strata:
        scored = scored.withColumn(f"__k_{c}", F.coalesce(F.col(c).cast("string"), F.lit("\0")))
    keys = [f"__k_{c}" for c in strata]
    sizes = scored.groupBy(*keys).agg(F.count("*").alias("__n"))
    want = F.when(F.col("__n") > 1, F.bround(F.col("__n") * F.lit(fraction))).otherwise(F.col("__n"))
    bits = F.least(
        F.ceil(F.log2(F.greatest(F.col("__n") / bucket_rows, F.lit(1.0)))), F.lit(30)
    ).cast("int")
    sizes = sizes.withColumn("__want", want.cast("long")).withColumn("__bits", bits)
    bucket = F.expr(f"shiftright(__s, {score_bits} - 30)")
    bucket = F.floor(bucket / F.pow(F.lit(2.0), 30 - F.col("__bits"))).cast("long")
    placed = scored.join(sizes, keys).withColumn("__b", bucket)
    per_bucket = placed.groupBy(*keys, "__b").agg(
        F.count("*").alias("__bn"), F.first("__want").alias("__w")
    )
    upto = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    quota = per_bucket.withColumn(
        "__q", F.col("__w") - F.coalesce(F.sum("__bn").over(upto), F.lit(0))
    ).where(F.col("__q") > 0)
    chosen = placed.join(quota.select(*keys, "__b", "__bn", "__q"), [*keys, "__b"])
    whole = chosen.where(F.col("__q") >= F.col("__bn"))
    rank = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy("__s", key))
    partial = chosen.where(F.col("__q") < F.col("__bn")).withColumn("__r", rank)
    partial = partial.where(F.col("__r") <= F.col("__q"))
    return whole.select(*df.columns).unionByName(partial.select(*df.columns))


def hash_split(
    df: DataFrame, key: str, fractions: Mapping[str, float], seed: int = 42, name: str = "split"
) -> DataFrame:
    """Label rows by a stable hash of ``key`` (the first 32 bits of the MD5 of 'seed:key'); ``fractions`` must sum to 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    edge, label = 0.0, None
    items = list(fractions.items())
    for part, share in items[:-1]:
        edge += share
        label = F.when(point < edge, part) if label is None else label.when(point < edge, part)
    last = F.lit(items[-1][0])
    return df.withColumn(name, last if label is None else label.otherwise(last))


# --- set operations, sort, limit -------------------------------------------------


def union_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION ALL over the columns both sides share (order of the first)."""
    common = [c for c in a.columns if c in set(b.columns)]
    return a.select(*common).unionByName(b.select(*common))


def union_padded(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_intersection(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def key_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def ranked_rows(
    df: DataFrame, n: int, column: Column | str, tie: Sequence[str], largest: bool = True
) -> DataFrame:
    """nlargest / nsmallest with an explicit tie break (TakeOrderedAndProject)."""
    c = _as_col(column)
    return df.where(c.isNotNull()).orderBy(c.desc() if largest else c.asc(), *tie).limit(n)


def group_mean_ranked(
    df: DataFrame, key: str, value: str, n: int, largest: bool = True, name: str = "mean"
) -> DataFrame:
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(name))
    return ranked_rows(means, n, name, [key], largest)


def by_magnitude(df: DataFrame, column: str, tie: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.abs(F.col(column)).desc(), *tie)
