"""File sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from leasegrid import constants as C
from leasegrid.functions.dates import reporting_quarter
from leasegrid.functions.text import extract
from leasegrid.operators.ordering import row_numbers
from leasegrid.session import cut_lineage


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header. A missing path raises; give a schema to avoid inference."""
    settings = {"header": True, "mode": "PERMISSIVE", "multiLine": False, "escape": '"', **options}
    reader = spark.read.options(**settings)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def file_stem(path: Column | None = None) -> Column:
    name = F.col("_metadata.file_name") if path is None else path
    return F.regexp_replace(name, r"\.[^.]*$", "")


def available_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, file_name, length) of the matching files; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")


def csv_cells(line: Column, sep: str = ",") -> Column:
    """Cells of one CSV record: quotes are respected and doubled quotes undone; an empty unquoted cell is NULL."""
    mark = re.escape(sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{mark}("[^"]*+(?:""[^"]*+)*+"|[^{mark}]*)'), F.lit(1))
    quoted = lambda c: F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda c: F.when(c == "", F.lit(None)).when(F.startswith(c, F.lit('"')), quoted(c)).otherwise(c))


def merge_batches(
    spark: SparkSession, folder: str, pattern: str = "*.csv", schema: StructType | str | None = None, sep: str = ",", **options
) -> DataFrame:
    """Union of all matching files by column name.

    With a schema this is one scan. Without one, the first record of each file
    is parsed on the executors, and one scan of all lines finds each column by
    its place in the file's own header; all columns are strings and missing ones
    NULL. Only the distinct headers reach the driver. Records are lines.
    Unreadable files are skipped; no match raises.
    """
    if schema is not None:
        df = read_csv(spark, folder, schema, ignoreCorruptFiles=True, pathGlobFilter=pattern, sep=sep, **options)
        if not df.inputFiles():
            raise FileNotFoundError(f"no {pattern} in {folder}")
        return df
    lines = spark.read.options(ignoreCorruptFiles=True, pathGlobFilter=pattern, **options).text(folder)
    lines = lines.select(
        F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"), "value",
    )
    top = lines.where("__start = 0").groupBy("__path").agg(F.min_by("value", "__id").alias("__top"), F.min("__id").alias("__first"))
    name = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "^\ufeff", ""))
    headers = cut_lineage(top.select("__path", "__first", F.transform(csv_cells(F.regexp_replace("__top", "^\ufeff", ""), sep), name).alias("__names")))
    kinds = sorted(r[0] for r in headers.select("__names").distinct().collect())
    if not kinds:
        raise FileNotFoundError(f"no {pattern} in {folder}")
    columns = list(dict.fromkeys(c for names in kinds for c in names))
    body = lines.where(F.col("value") != "").join(headers, "__path").where((F.col("__start") > 0) | (F.col("__id") > F.col("__first")))
    cells = body.select("__names", csv_cells(F.col("value"), sep).alias("__cells"))
    place = lambda c: F.array_position("__names", F.lit(c)).cast("int") - 1
    return cells.select(*[F.get("__cells", place(c)).alias(c) for c in columns])


def read_keyed(
    spark: SparkSession, folder: str, schema: StructType | str, pattern: str = "*.csv", limit: int | None = None, key: str = "file_key"
) -> DataFrame:
    """Directory scan with the file stem as a key column; ``limit`` keeps the first files by name."""
    if limit is None:
        return read_csv(spark, folder, schema, pathGlobFilter=pattern).withColumn(key, file_stem())
    first = [r["path"] for r in available_files(spark, folder, pattern).orderBy("path").limit(limit).collect()]
    return read_csv(spark, first, schema).withColumn(key, file_stem())


def with_file_period(df: DataFrame, name: Column | None = None) -> DataFrame:
    """year and quarter from '..._YYYY_MM.csv' (quarter NULL for other months)."""
    c = F.col("_metadata.file_name") if name is None else name
    pattern = r"_(\d{4})_(\d{2})\.[^.]*$"
    month = extract(c, pattern, 2).try_cast("int")
    return df.withColumns({"year": extract(c, pattern, 1).try_cast("int"), "quarter": reporting_quarter(month)})


def file_year(name: Column) -> Column:
    """Year suffix of '..._YYYY.csv'."""
    return extract(name, r"_(\d{4})\.[^.]*$").try_cast("int")


def archive_file_name(year: Column, month: Column) -> Column:
    return F.format_string("rental_listings_%04d_%02d.csv", year, month)


def read_csv_any_encoding(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """UTF-8 per file where the bytes are valid UTF-8, Latin-1 otherwise.

    Latin-1 maps bytes one to one, so a single scan keeps them all; a file is
    re-read as UTF-8 only as an expression, never as a second scan of bytes.
    """
    raw = read_csv(spark, path, schema, encoding="ISO-8859-1", **options)
    names = [f.name for f in raw.schema if isinstance(f.dataType, StringType)]
    raw = raw.withColumn("__file", F.col("_metadata.file_path"))
    ok = F.lit(True)
    for c in names:
        ok = ok & F.coalesce(F.is_valid_utf8(F.encode(F.col(f"`{c}`"), "ISO-8859-1").cast("string")), F.lit(True))
    files = raw.groupBy("__file").agg(F.bool_and(ok).alias("__utf8"))
    joined = raw.join(files, "__file")
    fixed = {
        c: F.when(F.col("__utf8"), F.decode(F.encode(F.col(f"`{c}`"), "ISO-8859-1"), "UTF-8")).otherwise(F.col(f"`{c}`"))
        for c in names
    }
    return joined.withColumns(fixed).drop("__file", "__utf8")


def harmonise(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str]) -> DataFrame:
    """Rename variants, add missing columns as NULL, fix the order."""
    df = df.withColumnsRenamed(dict(renames))
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def standardise_schools(df: DataFrame, year: Column | int) -> DataFrame:
    """Common school columns plus establishment_year (a value or a column of ``df``)."""
    at = year if isinstance(year, Column) else F.lit(year)
    tagged = df.withColumn("establishment_year", at.cast("int"))
    return harmonise(tagged, [*C.SCHOOL_COLUMNS, "establishment_year"], C.SCHOOL_RENAMES)


def write_parquet(df: DataFrame, path: str, files: int | None = None, partition_by: Sequence[str] = (), max_records: int | None = None) -> None:
    """Overwrite parquet. ``files`` coalesces (small outputs only); large outputs
    are sized by ``max_records`` per file instead."""
    out = df.coalesce(files) if files else df
    writer = out.write.mode("overwrite")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def assign_batches(df: DataFrame, order: Sequence[str], size: int, name: str = "batch") -> DataFrame:
    """'batch_0001', ... labels of exactly ``size`` rows in ``order`` (unique)."""
    numbered = row_numbers(df, list(order), "__i")
    return numbered.withColumn(name, F.format_string("batch_%04d", F.ceil(F.col("__i") / size).cast("long"))).drop("__i")


def write_batches(df: DataFrame, order: Sequence[str], size: int, path: str) -> None:
    assign_batches(df, order, size).write.mode("overwrite").partitionBy("batch").option("header", True).csv(path)


def write_if_absent(df: DataFrame, path: str, fmt: str = "csv") -> None:
    df.write.mode("ignore").format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """CSV or JSON report."""
    writer = df.write.mode("overwrite")
    if fmt == "json":
        writer.json(path)
    else:
        writer.option("header", True).csv(path)


def load_available(loaders: Mapping[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(frames, skipped): datasets whose path exists, and the reasons for the rest."""
    frames, skipped = {}, {}
    for name, load in loaders.items():
        try:
            frames[name] = load()
        except (AnalysisException, FileNotFoundError) as err:
            skipped[name] = str(err).splitlines()[0]
    return frames, skipped
