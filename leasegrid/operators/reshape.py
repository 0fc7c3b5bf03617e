"""Cell-grid reshaping, pivots, unpivots, nearest snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.dates import month_name_quarter, stamp14
from leasegrid.operators.ordering import row_numbers, top_per_key

SHEET = ["file", "sheet"]
# A sheet is a bounded group: the file format stops at 1,048,576 rows, so a
# window partitioned by sheet is safe.


def _cells(grid: DataFrame, columns: Mapping[int, str], keys: Sequence[str]) -> DataFrame:
    """Pivot grid cells to named columns by column number."""
    aggs = [F.max(F.when(F.col("col") == i, F.col("value"))).alias(n) for i, n in columns.items()]
    return grid.where(F.col("col").isin(list(columns))).groupBy(*keys).agg(*aggs)


def stack_blocks(
    grid: DataFrame,
    blocks: Sequence[Sequence[int]],
    names: Sequence[str],
    after: str | None = None,
    required: Sequence[str] | None = None,
) -> DataFrame:
    """Side-by-side column blocks stacked to one table.

    ``blocks`` lists the column numbers of each block in ``names`` order;
    ``after`` keeps only rows below the first column-0 cell containing it.
    """
    if after is not None:
        anchor = grid.where((F.col("col") == 0) & F.contains(F.col("value"), F.lit(after)))
        anchor = anchor.groupBy(*SHEET).agg(F.min("row").alias("__from"))
        grid = grid.join(anchor, SHEET).where(F.col("row") > F.col("__from"))
    position = {c: (b, i) for b, cols in enumerate(blocks) for i, c in enumerate(cols)}
    block = F.create_map(*[F.lit(x) for c, (b, _) in position.items() for x in (c, b)])
    slot = F.create_map(*[F.lit(x) for c, (_, i) in position.items() for x in (c, i)])
    placed = grid.where(F.col("col").isin(list(position))).select(
        *SHEET,
        "row",
        block[F.col("col")].alias("block"),
        slot[F.col("col")].alias("col"),
        "value",
    )
    wide = _cells(placed, dict(enumerate(names)), [*SHEET, "row", "block"])
    return wide.na.drop("any", subset=list(required or names))


def slice_between(
    grid: DataFrame,
    start: tuple[int, str],
    end: tuple[int, str],
    names: Sequence[str],
    skip: int = 2,
    stop_before: int = 1,
    drop_positions: Sequence[int] = (),
) -> DataFrame:
    """Rows between two marker texts, as named columns.

    ``start``/``end`` are (column, text); the slice begins ``skip`` rows after
    the first start marker and ends before ``stop_before`` rows ahead of the
    first end marker. ``drop_positions`` are 0-based positions among the rows kept.
    """

    def first_row(marker: tuple[int, str]) -> Column:
        col, text = marker
        return F.min(F.when((F.col("col") == col) & F.contains(F.col("value"), F.lit(text)), F.col("row")))

    marks = grid.groupBy(*SHEET).agg(first_row(start).alias("__a"), first_row(end).alias("__b"))
    inside = grid.join(marks, SHEET).where(
        (F.col("row") >= F.col("__a") + skip) & (F.col("row") < F.col("__b") - stop_before)
    )
    rows = _cells(inside, dict(enumerate(names)), [*SHEET, "row"]).na.drop(subset=[names[0]])
    if drop_positions:
        position = F.row_number().over(Window.partitionBy(*SHEET).orderBy("row")) - 1
        rows = rows.withColumn("__p", position).where(~F.col("__p").isin(list(drop_positions))).drop("__p")
    return rows


def section_labels(
    rows: DataFrame,
    label: str,
    keys: Sequence[str] = tuple(SHEET),
    order: str = "row",
    totals: Sequence[str] = tuple(C.DWELLING_TOTALS),
) -> DataFrame:
    """'Section:' rows open a section; later labels become 'Section - label'; totals reset it."""
    c = F.col(label)
    header = c.endswith(":")
    token = F.when(header, F.replace(c, F.lit(":"), F.lit(""))).when(c.isin(list(totals)), F.lit(""))
    seen = Window.partitionBy(*keys).orderBy(order)
    section = F.last(token, ignorenulls=True).over(seen)
    named = (
        F.when(c == "Total", F.concat(F.coalesce(F.nullif("__section", F.lit("")), F.lit("None")), F.lit(" - Total")))
        .when(F.coalesce(F.col("__section"), F.lit("")) != "", F.concat(F.col("__section"), F.lit(" - "), c))
        .otherwise(c)
    )
    marked = rows.where(c.isNotNull()).withColumn("__section", section)
    return marked.where(~header).withColumn(label, named).drop("__section")


def rent_series(grid: DataFrame, sheets: Sequence[str] = tuple(C.RENT_SHEETS)) -> DataFrame:
    """(suburb, property_type, quarter, year, median_rent) from Count/Median column pairs.

    Row 1 holds 'Mon YYYY' over each Count column; the median sits one column
    to its right. Data rows start at the first column-0 text that is not a title.
    """
    titles = ["Moving annual median rent by suburb", *C.RENT_SHEETS]
    grid = grid.where(F.col("sheet").isin(list(sheets)))
    col, row, value = F.col("col"), F.col("row"), F.col("value")
    starts = grid.groupBy(*SHEET).agg(
        F.min(F.when((col == 0) & value.isNotNull() & ~value.isin(titles), row)).alias("__start")
    )
    headers = grid.where((row == 1) & (col >= 2)).select(
        *SHEET,
        (col + 1).alias("col"),
        month_name_quarter(F.regexp_extract(value, r"^\s*(\S+)\s+\S+\s*$", 1)).alias("quarter"),
        F.regexp_extract(value, r"^\s*\S+\s+(\d+)\s*$", 1).try_cast("int").alias("year"),
    )
    headers = headers.where(F.col("quarter").isNotNull() & F.col("year").isNotNull())
    body = grid.join(starts, SHEET).where(row >= F.col("__start"))
    names = body.where((col == 1) & value.isNotNull()).select(
        *SHEET, "row", F.lower(value).alias("suburb")
    )
    names = names.where(~F.contains(F.col("suburb"), F.lit("group total")))
    return (
        body.where((col >= 3) & value.isNotNull() & (value != "-"))
        .select(*SHEET, "row", "col", value.try_cast("double").alias("median_rent"))
        .where(F.col("median_rent").isNotNull())
        .join(headers, [*SHEET, "col"])
        .join(names, [*SHEET, "row"])
        .select("suburb", F.col("sheet").alias("property_type"), "quarter", "year", "median_rent")
    )


def flatten_headers(top: Column, bottom: Column, group_label: str) -> Column:
    """Name of a two-level header cell; placeholder texts count as blank."""

    def clean(c: Column) -> Column:
        text = F.trim(F.coalesce(c, F.lit("")))
        return F.when(text.rlike("^(Unnamed|Missing value)"), "").otherwise(text)

    a, b = clean(top), clean(bottom)
    return F.when(a == group_label, b).when(a != "", a).otherwise(b)


def melt_quarters(df: DataFrame, ids: Sequence[str], name: str = "quarter_year", value: str = "median_rent") -> DataFrame:
    """Wide period columns to long rows, non-numeric cells dropped."""
    cols = [c for c in df.columns if c not in set(ids)]
    text = df.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = text.unpivot(list(ids), [F.col(f"`{c}`") for c in cols], name, value)
    return long.withColumn(value, F.col(value).try_cast("double")).where(F.col(value).isNotNull())


def pivot_first(
    df: DataFrame, keys: Sequence[str], column: str, value: str, values: Sequence, order: str
) -> DataFrame:
    """Wide table with the first non-null ``value`` (by ``order``) per cell."""
    first = F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    return df.groupBy(*keys).pivot(column, list(values)).agg(first)


def pivot_mean_top(
    df: DataFrame, row: str, column: str, value: str, values: Sequence, top_n: int
) -> DataFrame:
    """Mean per row x column over the ``top_n`` rows with the highest overall mean."""
    best = df.groupBy(row).agg(F.avg(value).alias("__m")).orderBy(F.desc("__m"), row).limit(top_n)
    kept = df.join(best.select(row), row, "left_semi")
    return kept.groupBy(row).pivot(column, list(values)).agg(F.avg(value))


def one_hot(df: DataFrame, column: str, levels: Sequence[str], prefix: str, drop_first: bool = False) -> DataFrame:
    """0/1 double columns for known ``levels`` (sorted); NULL matches none."""
    chosen = sorted(levels)[1:] if drop_first else sorted(levels)
    hits = {f"{prefix}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("double") for v in chosen}
    return df.withColumns(hits)


def levels_of(df: DataFrame, column: str) -> list:
    """Sorted distinct levels of a column whose levels are to become columns."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def one_hot_vector(train: DataFrame, column: str, output: str) -> PipelineModel:
    """Encoder for a column with any number of levels: one sparse vector per row, levels in order of their text.

    Fitted on ``train``; a NULL or a level not met there gives the zero vector.
    """
    number = f"__{output}"
    stages = [
        StringIndexer(inputCol=column, outputCol=number, handleInvalid="keep", stringOrderType="alphabetAsc"),
        # the slot of unknown levels is the last one, which dropLast encodes as zeros
        OneHotEncoder(inputCol=number, outputCol=output, dropLast=True),
    ]
    return Pipeline(stages=stages).fit(train)


# --- snapshots -------------------------------------------------------------------


def quarter_targets(first_year: int = 2022, last_year: int = 2025) -> dict[str, date]:
    return {
        f"{y}_Q{m // 3}": date(y, m, 15) for y in range(first_year, last_year + 1) for m in (3, 6, 9, 12)
    }


def nearest_snapshots(
    df: DataFrame,
    keys: Sequence[str],
    stamp: Column,
    payload: str,
    targets: Mapping[str, date],
    max_days: int = 45,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Long form (keys, period, payload): nearest row to each target within ``max_days``.

    The targets are a short constant list, so each row is exploded to the few
    targets in reach and reduced with ``min_by``: no range join, no per-key window.
    """
    items = F.array(
        *[F.struct(F.lit(n).alias("period"), F.lit(d).alias("day")) for n, d in targets.items()]
    )
    day = F.to_date(stamp)
    reach = F.filter(items, lambda t: F.abs(F.datediff(day, t.day)) <= max_days)
    hits = df.withColumn("__day", day).withColumn("__t", F.explode(reach))
    rank = F.struct(
        F.abs(F.datediff("__day", F.col("__t.day"))).alias("d"), *[F.col(c) for c in (tie or [payload])]
    )
    return hits.groupBy(*keys, F.col("__t.period").alias("period")).agg(
        F.min_by(payload, rank).alias(payload)
    )


def quarterly_snapshots(df: DataFrame, keys: Sequence[str] = ("suburb", "postcode"), timestamp: str = "timestamp") -> DataFrame:
    """One column per target quarter holding the nearest snapshot's timestamp text."""
    targets = quarter_targets()
    parsed = df.withColumn("__ts", stamp14(F.col(timestamp))).where(F.col("__ts").isNotNull())
    near = nearest_snapshots(parsed, keys, F.col("__ts"), timestamp, targets)
    wide = near.groupBy(*keys).pivot("period", list(targets)).agg(F.first(timestamp))
    return parsed.select(*keys).distinct().join(wide, list(keys), "left")


def first_per_month(
    df: DataFrame, keys: Sequence[str], stamp: str, months: Sequence[int] | None = None, tie: Sequence[str] = ()
) -> DataFrame:
    """Earliest row per key and month, among the target months."""
    ts = F.col(stamp)
    if months:
        df = df.where(F.month(ts).isin(list(months)))
    marked = df.withColumn("year_month", F.date_format(ts, "yyyyMM"))
    return top_per_key(marked, [*keys, "year_month"], [stamp, *tie], largest=False)


def rank_by_position(df: DataFrame, ordinal: str, name: str = "rank") -> DataFrame:
    """1..n in source order."""
    return row_numbers(df, [ordinal], name)
