"""Delimited-text readers and writers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kitchenlight.functions import digits_only
from kitchenlight.sources.quoted import line_order, quoted_records


_EXTRACT_OPTIONS = {
    "escape": '"',
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


class SchemaError(ValueError):
    """A source lacks the columns it must have."""


def require_columns(df: DataFrame, needed: Iterable[str], what: str) -> DataFrame:
    """Return ``df`` unchanged, or fail naming the columns it lacks."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise SchemaError(f"{what} lacks required columns {missing}")
    return df


def lacking_columns(sources: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The columns that sources lack, as rows ``(source, row_count, column_name)``: the report behind ``require_columns``.

    ``sources`` maps a name to a frame and the columns it must have. ``row_count`` tells what would be refused with it.
    """

    def lacking(name: str, df: DataFrame, needed: Sequence[str]) -> DataFrame:
        missing = F.array(*[F.lit(column) for column in sorted(set(needed) - set(df.columns))]).cast("array<string>")
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        return counted.select(F.lit(name).alias("source"), "row_count", F.explode(missing).alias("column_name"))

    return reduce(DataFrame.unionByName, [lacking(name, *source) for name, source in sources.items()])


def read_extract(spark: SparkSession, path: str, required: Sequence[str] = (), multi_line: bool = False) -> DataFrame:
    """CSV with a header row; every column is text, malformed rows fail the job.

    By default a record is one line, so one huge file is read by many tasks; a quoted line break then breaks the
    record, and the job fails. With ``multi_line`` quoted line breaks are read, each file by one task and in its order;
    ``read_broken_extract`` reads them by many tasks.
    """
    return require_columns(spark.read.csv(path, header=True, multiLine=multi_line, **_EXTRACT_OPTIONS), required, path)


def read_broken_extract(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """The rows of ``read_extract`` with ``multi_line``, in any order, each file read by many tasks.

    It costs one shuffle of the lines. The header must be one line.
    """
    names = spark.read.csv(path, header=True, **_EXTRACT_OPTIONS).columns
    layout = ", ".join("`{}` string".format(name.replace("`", "``")) for name in names)
    parsed = F.from_csv("record", layout, _EXTRACT_OPTIONS | {"multiLine": "true"}).alias("fields")
    return require_columns(quoted_records(spark, path).select(parsed).select("fields.*"), required, path)


def write_csv(df: DataFrame, path: str, order_by: Sequence[Column | str] = (), single_file: bool = False) -> None:
    """CSV with a header. With ``order_by`` the part files are in global order.

    ``single_file`` is for small reports only: it writes through one task.
    """
    if order_by:
        df = df.orderBy(*order_by)
    if single_file:
        df = df.coalesce(1) if not order_by else df.repartition(1).sortWithinPartitions(*order_by)
    df.write.mode("overwrite").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def normalise_seed(lines: DataFrame, exactly_five: bool = False) -> DataFrame:
    """Distinct five-digit codes from free-form seed lines (column ``zip``).

    Non-digits are dropped. Lines with more than five digits give their first five, or, with
    ``exactly_five``, are dropped like the shorter ones.
    """
    digits = digits_only(F.col("zip"))
    wanted = F.length(digits) == 5 if exactly_five else F.length(digits) >= 5
    return lines.filter(wanted).select(F.substring(digits, 1, 5).alias("zip")).distinct()


def read_seed(spark: SparkSession, path: str, exactly_five: bool = False) -> DataFrame:
    """Seed list with the single header ``zip``; fails when no code is left.

    Lines are free text: commas and quotes are dropped like any other character that is no digit.
    """
    lines = spark.read.text(path).toDF("zip")
    header = lines.first()
    if header is None or header.zip.strip().lower() != "zip":
        raise SchemaError(f"{path} must have the single header 'zip'")
    seed = normalise_seed(lines, exactly_five)
    if seed.isEmpty():
        raise SchemaError(f"{path} holds no five-digit code")
    return seed


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Override rules ``zip, method, neighbors`` with ``line_no``, their order in the file."""
    rules = require_columns(read_extract(spark, path), ("zip", "method", "neighbors"), path)
    return rules.select("zip", "method", "neighbors", line_order().alias("line_no"))


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    """ZIP centroids from a CSV with the header ``zip,lat,lon``."""
    raw = require_columns(spark.read.csv(path, header=True, mode="FAILFAST"), ("zip", "lat", "lon"), path)
    return raw.select(*_centroid_columns())


def read_centroid_lines(spark: SparkSession, path: str) -> DataFrame:
    """``read_centroids`` with ``line_no``, the place of each row in the files."""
    raw = require_columns(spark.read.csv(path, header=True, mode="FAILFAST"), ("zip", "lat", "lon"), path)
    return raw.select(*_centroid_columns(), line_order().alias("line_no"))


def _centroid_columns() -> list[Column]:
    return [
        F.col("zip").cast("string").alias("zip"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
    ]


def _read_tsv(spark: SparkSession, path: str, **options: object) -> DataFrame:
    return spark.read.csv(
        path, sep="\t", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options
    )


def read_gazetteer(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Primary centroids (``zip, lat, lon`` as text) for the wanted codes.

    Tab-separated with a header whose cells may be padded. Of several rows for a code the last one counts.
    """
    raw = _read_tsv(spark, path, header=True)
    raw = raw.select("*", line_order().alias("line_order"))
    raw = raw.toDF(*[name.strip() for name in raw.columns])
    require_columns(raw, ("GEOID", "INTPTLAT", "INTPTLONG"), path)
    point = F.struct(
        F.coalesce(F.trim("INTPTLAT"), F.lit("")).alias("lat"), F.coalesce(F.trim("INTPTLONG"), F.lit("")).alias("lon")
    )
    return _pick_row(raw.select(F.trim("GEOID").alias("zip"), point.alias("point"), "line_order"), wanted, F.max_by)


def read_postal_file(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Secondary centroids (``zip, lat, lon`` as text) for the wanted codes.

    Tab-separated without a header: the second column is the code, the tenth and eleventh are the
    coordinates. Short rows and rows with a blank coordinate are skipped; the first row of a code counts.
    """
    # Positions of the code and the coordinates.
    code_at, lat_at, lon_at = 1, 9, 10
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(12)])
    raw = _read_tsv(spark, path, schema=schema, mode="PERMISSIVE").select("*", line_order().alias("line_order"))
    lat, lon = F.trim(f"c{lat_at}"), F.trim(f"c{lon_at}")
    rows = raw.filter((lat != "") & (lon != "")).select(
        F.trim(f"c{code_at}").alias("zip"), F.struct(lat.alias("lat"), lon.alias("lon")).alias("point"), "line_order"
    )
    return _pick_row(rows, wanted, F.min_by)


def _pick_row(rows: DataFrame, wanted: DataFrame, pick) -> DataFrame:
    """One point per wanted code, chosen by line order with partial aggregation."""
    return (
        rows.join(wanted.select("zip"), "zip", "left_semi")
        .groupBy("zip")
        .agg(pick("point", "line_order").alias("point"))
        .select("zip", "point.lat", "point.lon")
    )


def write_tsv(df: DataFrame, path: str, order_by: str, header: bool) -> None:
    """Tab-separated part files in global order of ``order_by``, which is not written."""
    df.orderBy(order_by).drop(order_by).write.mode("overwrite").csv(
        path, sep="\t", header=header, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue=""
    )
