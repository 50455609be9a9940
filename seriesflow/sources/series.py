"""Readers: CSV files and tables to the canonical series table."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from seriesflow.config import KEY, T as TIME, TIE, Y

CORRUPT = "_corrupt_record"
_WHOLE_FILE = 1 << 50


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, header) of the CSV files under a path; files without a line are left out.

    Each file is one task that reads no further than its first line with text.
    """
    own = spark.newSession()
    # A file weighs as much as the largest partition, so that none is cut or shared.
    own.conf.set("spark.sql.files.maxPartitionBytes", str(_WHOLE_FILE))
    own.conf.set("spark.sql.files.openCostInBytes", str(_WHOLE_FILE))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first_line(batches):
        for batch in batches:
            for file, line in zip(*(c.to_pylist() for c in batch.columns)):
                if line.strip():
                    yield pa.RecordBatch.from_pydict({"file": [file], "header": [line]})
                    return

    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.mapInArrow(first_line, "file string, header string")


def by_header(spark: SparkSession, path: str, names: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(header, paths) of the files under a path, one entry for each different header.

    Every header must have all of the names once. A single header keeps the path as it is.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in csv_headers(spark, path).collect():
        header = tuple(next(csv.reader([line])))
        missing = [c for c in names if c not in header]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in {file}")
        twice = [c for c in names if header.count(c) > 1]
        if twice:
            raise ValueError(f"more than one column {', '.join(twice)} in {file}")
        found.setdefault(header, []).append(unquote(file))
    if len(found) == 1:
        return [(list(*found), [path])]
    return [(list(header), files) for header, files in sorted(found.items())]


def _fields(header: list[str], kinds: dict[str, T.DataType]) -> list[T.StructField]:
    """One field per column of a file; those not asked for get names of their own."""
    prefix = "_other"
    while any(c.lower().startswith(prefix) for c in kinds):
        prefix += "_"
    return [T.StructField(c if c in kinds else f"{prefix}{i}", kinds.get(c, T.StringType()))
            for i, c in enumerate(header)]


def read_series_csv(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = False,
    allow_empty: bool = False,
) -> DataFrame:
    """Read the columns of a schema from a CSV file or a folder of them, by the names in
    the header of each file.

    Files may order their columns differently: those of one header are scanned together.
    Types are never inferred: that reads the file once more and lets one bad
    row change the type of a column. Further columns are left out; a file that lacks
    one is an error. By default a bad row keeps its text in ``_corrupt_record``;
    ``strict`` fails on it instead, and on an empty value unless ``allow_empty``,
    as in reports whose columns do not apply to every row.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    tables = []
    for header, files in by_header(spark, path, schema.names):
        fields = _fields(header, kinds)
        reader = spark.read.option("header", True)
        if strict:
            table = reader.option("mode", "FAILFAST").schema(T.StructType(fields)).csv(files)
            if allow_empty:
                tables.append(table.select(*schema.names))
                continue
            tables.append(table.select(*[
                F.when(F.col(c).isNull(), F.raise_error(F.lit(f"empty value in column {c}")))
                .otherwise(F.col(c)).cast(kinds[c]).alias(c) for c in schema.names
            ]))
            continue
        fields.append(T.StructField(CORRUPT, T.StringType()))
        tables.append(
            reader.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .schema(T.StructType(fields))
            .csv(files)
            .select(*schema.names, CORRUPT)
        )
    if not tables:  # no file has a line
        extra = [] if strict else [T.StructField(CORRUPT, T.StringType())]
        return spark.createDataFrame([], T.StructType([*schema.fields, *extra]))
    return reduce(DataFrame.unionByName, tables)


def read_texts(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The named columns of a CSV file or a folder of them as texts, found as in ``read_series_csv``."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return read_series_csv(spark, path, schema).drop(CORRUPT)


def load_series(
    table: DataFrame,
    key: Column,
    time: Column,
    value: Column,
    tiebreak: Column | None = None,
) -> DataFrame:
    """Give the columns of any table the series roles.

    Rows of one series with equal time need a tiebreak, as a table has no row
    order to fall back on. Rows without a key form a series of their own.
    """
    columns = [key.alias(KEY), time.alias(TIME), value.alias(Y)]
    if tiebreak is not None:
        columns.append(tiebreak.alias(TIE))
    return table.select(*columns)


def load_monthly(
    table: DataFrame, key: Column, time: Column, value: Column, places: int = 2
) -> DataFrame:
    """Sum a measure of ``places`` decimal places per key and calendar month.

    Summed as a decimal, the result does not depend on the order of the rows.
    At most one row per key and month remains, whatever the table's size.
    """
    total = F.sum(value.cast(f"decimal(28,{places})"))
    return table.groupBy(key.alias(KEY), F.trunc(time, "month").alias(TIME)).agg(
        total.cast("double").alias(Y)
    )
