"""Readers and writers for files and databases. Schemas are given, never inferred."""

from __future__ import annotations

import csv
import json
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.quality import nan_to_null, require_columns
from riskweave.operators.scan import positions


def csv_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by the column names in their first line that isn't blank, whatever their number in one scan.

    Empty files have no header and are left out. What reaches the driver is a row per distinct header with its files,
    whose names the driver holds anyway once it reads them.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # the part of a file that starts it lies in one task, in order
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).withColumn("n", F.monotonically_increasing_id()).groupBy(
        "file").agg(F.min_by("value", "n").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        names = tuple(next(csv.reader([row["header"].removeprefix("\ufeff").rstrip("\r")])))
        found.setdefault(names, []).extend(unquote(f) for f in row["files"])
    return dict(sorted(found.items()))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, required: list[str] | None = None,
             header: list[str] | None = None) -> DataFrame:
    """CSV in any column order; columns outside the schema are ignored, missing ones raise.

    Files of a folder may differ in their columns and the order of them: one scan finds the header of every file, and
    files with the same header are read as one source, in as many jobs as there are distinct headers. Who knows that all
    files have one ``header`` gives it and saves that scan; a file with another one fails the read.
    """
    groups = {tuple(header): [path] if isinstance(path, str) else path} if header else csv_headers(spark, path)
    parts = [_with_header(spark, list(names), files, schema) for names, files in groups.items()]
    df = parts[0] if parts else spark.createDataFrame([], schema)
    for part in parts[1:]:
        df = df.unionByName(part, allowMissingColumns=True)
    return require_columns(nan_to_null(df), required if required is not None else schema.fieldNames())


def _with_header(spark: SparkSession, names: list[str], files: list[str], schema: T.StructType) -> DataFrame:
    """A header that turns out not to be the file's own fails the read."""
    known = {f.name.lower(): f for f in schema.fields}
    found = T.StructType([
        T.StructField(known[n.lower()].name, known[n.lower()].dataType) if n.lower() in known
        else T.StructField(n, T.StringType()) for n in names
    ])
    df = spark.read.schema(found).option("header", True).option("enforceSchema", False).csv(files)
    return df.select(*[F.col(f"`{f.name}`") for f in found.fields if f.name.lower() in known])


def read_optional_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV source, or an empty table of the same schema when the path does not exist."""
    try:
        return read_csv(spark, path, schema, required=[])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_first_json(spark: SparkSession, candidates: list[str], schema: T.StructType) -> DataFrame:
    """First of the candidate paths that exists."""
    for path in candidates:
        try:
            return spark.read.schema(schema).option("multiLine", True).json(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError("None of the candidate paths exists: " + ", ".join(candidates))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
              partitions: int, **properties: str) -> DataFrame:
    """Database table in parallel key ranges; filters and columns are pushed to the database."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties)


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and sum of row hashes: equal for equal contents in any order and partitioning.

    A row's hash is the number in the first eight digits of the MD5 of its values as text, joined by a line break.
    Meant for text, whole numbers and dates, whose text form is the same everywhere.
    """
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in columns]
    number = F.conv(F.substring(F.md5(F.concat_ws("\n", *values)), 1, 8), 16, 10).cast("long")
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(number), F.lit(0)).alias("hash_sum"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Columnar sink; partition transactions by date so later date filters prune files."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Nested report, one JSON document per row."""
    df.write.mode("overwrite").json(path)


def document_lines(sections: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(section, place, line): the lines of one JSON document of any size, an array of objects per section.

    A section is its rows and the columns that order them, nulls first; rows equal in these take any order. Each row is
    a line, numbered over a distributed sort; place 0 opens the section and closes the one before. Null values are
    written, an empty section is an empty array, and without sections the document is an empty object.
    """
    parts, before = [], "{"
    for n, (name, (df, order)) in enumerate(sections.items()):
        spark = df.sparkSession
        parts.append(spark.range(1).select(F.lit(n).alias("section"), F.lit(0).cast("long").alias("place"),
                                           F.lit(f"{before}{json.dumps(name, ensure_ascii=False)}:[").alias("line")))
        before = "],"
        keys = [F.col(f"`{c}`").alias(f"_order{i}") for i, c in enumerate(order)]
        whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("_line")
        rows = positions(df.select(*keys, whole), [], [f"_order{i}" for i in range(len(order))], "_place")
        comma = F.when(F.col("_place") == 0, "").otherwise(",")
        parts.append(rows.select(F.lit(n).alias("section"), (F.col("_place") + 1).alias("place"), F.concat(comma, "_line").alias("line")))
    spark = parts[0].sparkSession if parts else SparkSession.active()
    parts.append(spark.range(1).select(F.lit(len(sections)).alias("section"), F.lit(0).cast("long").alias("place"),
                                       F.lit("]}" if sections else "{}").alias("line")))
    return reduce(DataFrame.union, parts)


def write_document(sections: dict[str, tuple[DataFrame, list[str]]], path: str, files: int = 1) -> None:
    """The JSON document of `document_lines` in ``files`` part files, which in the order of their names make it up.

    One task writes a file as its sorted lines come, so memory is bounded by a line; with one file that is the document
    as it is, with more the writing is spread and readers concatenate.
    """
    lines = document_lines(sections)
    dealt = lines.repartitionByRange(files, "section", "place").sortWithinPartitions("section", "place")
    dealt.select("line").write.mode("overwrite").text(path)


def report_document(sections: dict[str, DataFrame]) -> DataFrame:
    """One nested document, a row, from small report tables; `write_document` takes sections of any size."""
    document = None
    for name, df in sections.items():
        array = df.agg(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(name)).scalar()
        document = (document if document is not None else df.sparkSession.range(1)).withColumn(name, array)
    return document.drop("id")
