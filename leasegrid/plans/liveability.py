"""Affordability and liveability rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid.operators import clean, joins, score
from leasegrid.session import cut_lineage


def census_ratio(listings: DataFrame, medians: DataFrame) -> DataFrame:
    """Attach census household income, rent and their ratio to each listing's suburb."""
    out, units = listings, listings.select("suburb").distinct()
    for text, name in (
        ("Median total household income ($/weekly)", "median_household_income"),
        ("Median rent ($/weekly)(a)", "median_rent_census"),
    ):
        values = medians.where(F.col("Statistic") == text).select(F.col("Suburb").alias("suburb"), F.col("Value").alias(name))
        out = joins.merge_on_combo(out, values, name, units=units)
    return out.withColumn("income_rent_ratio", F.try_divide("median_rent_census", "median_household_income"))


def suburb_scores(
    listings: DataFrame, aliases: DataFrame, valid: DataFrame | None = None, wanted: Sequence[str] | None = None
) -> DataFrame:
    """Suburb table with pillar scores and livability_score (unsorted)."""
    df = clean.select_present(listings, wanted) if wanted else listings
    # The roll-up reads these rows once per kind of rule.
    df = cut_lineage(joins.map_aliases(df, "suburb", aliases))
    suburbs = score.suburb_rollup(df)
    if valid is not None:
        suburbs = joins.semi(suburbs, valid, "suburb")
    return score.livability(score.pillar_scores(suburbs))


def top_suburbs(scores: DataFrame, n: int = 6) -> DataFrame:
    """Best suburbs with display names."""
    best = clean.ranked_rows(scores, n, "livability_score", ["suburb"])
    return best.withColumn("suburb", F.initcap(F.replace(F.col("suburb"), F.lit("-"), F.lit(" "))))
