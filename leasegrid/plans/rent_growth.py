"""Quarterly panel: economics and census joins, selection, spatial features, fit, forecast, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.text import is_age_summary
from leasegrid.operators import clean, joins, linear, model
from leasegrid.operators.forecast import rent_growth, spatial_forecast, var_forecast
from leasegrid.operators.ordering import dense_ids
from leasegrid.operators.panel import time_lags
from leasegrid.operators.reshape import levels_of, one_hot
from leasegrid.operators.spatial import combo_weights, neighbour_weights, row_stochastic
from leasegrid.session import cut_lineage

INDICATORS = list(C.INDICATOR_NAMES.values())


def economic_series(frames: Sequence[DataFrame]) -> DataFrame:
    """Full outer chain of the quarterly series on (year, quarter), short indicator names."""
    first, *rest = frames
    rest = [f.drop("date") for f in rest]
    out = joins.outer_chain(["year", "quarter"], first, *rest)
    return clean.quarter_keys(out.withColumnsRenamed(C.INDICATOR_NAMES)).drop("quarter_year")


def panel(rents: DataFrame, economy: DataFrame, population: DataFrame, medians: DataFrame) -> DataFrame:
    """Rent x economics, then population, income and age by combo-key averages."""
    out = joins.outer_chain(["year", "quarter"], rents, economy)
    out = cut_lineage(out.where(F.col("suburb").isNotNull()))
    units = out.select("suburb").distinct()
    people = population.where(is_age_summary(F.col("Age group")) & (F.col("Age group") == "Total"))
    people = people.select(F.lower("Suburb").alias("suburb"), F.col("Persons").alias("population_size"))
    out = joins.merge_on_combo(out, people, "population_size", units=units)
    for text, name in (
        ("Median total personal income ($/weekly)", "median_personal_income"),
        ("Median age of persons", "median_age"),
    ):
        values = medians.where(F.col("Statistic") == text).select(F.col("Suburb").alias("suburb"), F.col("Value").alias(name))
        out = joins.merge_on_combo(out, values, name, units=units)
    return out


def indexed(panel: DataFrame) -> DataFrame:
    """Rows with a gsp value, plus spatial_unit, time_index and spatial_index."""
    out = cut_lineage(clean.spatial_unit(panel.where(F.col("gsp").isNotNull())))
    out = dense_ids(out, ["date"], "time_index")
    return dense_ids(out, ["spatial_unit"], "spatial_index")


def spatial_edges(places: DataFrame, panel: DataFrame, k: int = 15) -> DataFrame:
    """Row-stochastic edges between panel suburbs from the k nearest localities."""
    named = places.withColumn("locality", F.lower("locality"))
    return row_stochastic(combo_weights(neighbour_weights(named, k=k), named, panel))


def featured(panel: DataFrame, edges: DataFrame) -> DataFrame:
    """Lags 1-4, spatial lag, reliability weights; rows without a full history dropped."""
    out = time_lags(cut_lineage(panel), ["spatial_unit"], "date", "median_rent")
    out = joins.spatial_lag(out, edges, "date", "median_rent")
    out = clean.reliability_weights(out)
    return out.na.drop(subset=["median_rent", *[f"rent_lag_{k}" for k in range(1, 5)], "spatial_lag"])


def fit_log_model(
    features: DataFrame, indicators: Sequence[str], income: str = "median_personal_income", split: date = date(2024, 1, 1), weighted: bool = True
) -> tuple[linear.LinearFit, DataFrame]:
    """Weighted log-linear fit on rows before ``split``, and metrics on both sides in rent units."""
    lags = [f"rent_lag_{k}" for k in range(1, 5)]
    logged = cut_lineage(model.log_features(features, "median_rent", lags))
    levels = levels_of(logged, "property_type")
    logged = one_hot(logged, "property_type", levels, "property")
    names = [*[f"log_{c}" for c in lags], "log_spatial_lag", *indicators, income, *[f"property_{v}" for v in levels]]
    train, test = clean.split_at(logged, "date", split)
    fit = linear.least_squares(train, names, "log_median_rent", "weights" if weighted else None)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    scored = both.withColumn("predicted", F.exp(fit.predict()))
    return fit, model.regression_metrics(scored, "median_rent", "predicted", "split")


def forecast_growth(
    features: DataFrame, edges: DataFrame, coefficients: Mapping[str, float], indicators: Sequence[str], quarters: int = 20
) -> tuple[DataFrame, DataFrame]:
    """(forecast, growth): indicators by VAR, rents by the recursive spatial model."""
    features = cut_lineage(features)
    economy = var_forecast(features, list(indicators), steps=quarters)
    out = spatial_forecast(features, edges, coefficients, economy, indicators, quarters)
    return out, rent_growth(out, features, quarters, quarters / 4)
