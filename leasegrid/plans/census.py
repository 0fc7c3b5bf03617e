"""Census sheets (cell grid) to seven flat tables, all files in one pass each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasegrid import constants as C
from leasegrid.functions.text import extract, suburb_from_code
from leasegrid.operators.reshape import SHEET, section_labels, slice_between, stack_blocks


def suburb_names(grid: DataFrame) -> DataFrame:
    """(file, suburb, sal_code): name from cell (1, 0) of the first sheet, code from the file name."""
    cell = grid.where((F.col("sheet") == "G02") & (F.col("row") == 1) & (F.col("col") == 0))
    return cell.select("file", suburb_from_code(F.col("value")).alias("Suburb"), extract(F.col("file"), r"(SAL\d+)").alias("sal_code"))


def census_tables(grid: DataFrame) -> dict[str, DataFrame]:
    """Flat tables keyed by dataset name; integer bands are BIGINT, ``Suburb`` is attached."""
    names = suburb_names(grid)
    sheet = lambda s: grid.where(F.col("sheet") == s)

    def finish(df: DataFrame, numbers: list[str], kind: str = "bigint") -> DataFrame:
        typed = df.withColumns({c: F.col(f"`{c}`").try_cast("double").cast(kind) for c in numbers})
        return typed.join(names, "file", "left").drop(*SHEET, "row", "block")

    medians = stack_blocks(sheet("G02"), [[0, 1], [3, 4]], ["Statistic", "Value"])
    people = stack_blocks(
        sheet("G04"),
        [[0, 1, 2, 3], [5, 6, 7, 8], [10, 11, 12, 13]],
        ["Age group", "Males", "Females", "Persons"],
        after="Age",
        required=["Age group", "Persons"],
    ).drop("Males", "Females")
    income = slice_between(sheet("G17"), (1, "PERSONS"), (0, "This table"), ["Price Range", *C.INCOME_BANDS])
    household = slice_between(sheet("G33"), (0, "Negative"), (0, "Total"), ["Income", *C.HOUSEHOLD_BANDS], stop_before=-1)
    dwelling = slice_between(
        sheet("G36"),
        (0, "Occupied private dwellings"),
        (0, "Total private dwellings"),
        ["Dwelling Type", "Dwellings", "Persons"],
        skip=0,
        stop_before=-1,
    ).where(F.col("Dwelling Type") != "Occupied private dwellings:")
    dwelling = section_labels(dwelling, "Dwelling Type")
    education = slice_between(
        sheet("G49"), (1, "PERSONS"), (0, "This table"), ["Highest Education Level", *C.EDUCATION_BANDS], drop_positions=[4, 8]
    )
    jobs = slice_between(sheet("G60"), (1, "PERSONS"), (0, "This table"), ["Age", *C.JOB_BANDS])
    return {
        "median_stats": finish(medians, ["Value"], "double"),
        "population_breakdown": finish(people, ["Persons"]),
        "personal_income": finish(income, C.INCOME_BANDS),
        "household_income": finish(household, C.HOUSEHOLD_BANDS),
        "dwelling_structure": finish(dwelling, ["Dwellings", "Persons"]),
        "education_level": finish(education, C.EDUCATION_BANDS),
        "job_type": finish(jobs, C.JOB_BANDS),
    }
