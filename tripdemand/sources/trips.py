"""Monthly trip files: layout, reading, coverage and clean-zone writes.

Landed files follow the public naming ``<service>_tripdata_<YYYY-MM>.parquet``
(one file or folder per service and month). They are read in one scan per
service; the file month is recovered from the file path, so the per-file loop
of a single-node loader becomes a column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tripdemand.functions import literal_frame
from tripdemand.sources import commits

SERVICES = ("yellow", "fhvhv")
FILE_MONTH_PATTERN = r"_tripdata_(\d{4}-\d{2})\.parquet"

RAW_YELLOW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("Airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

RAW_FHVHV_SCHEMA = T.StructType([
    T.StructField("hvfhs_license_num", T.StringType()),
    T.StructField("pickup_datetime", T.TimestampNTZType()),
    T.StructField("dropoff_datetime", T.TimestampNTZType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
    T.StructField("trip_miles", T.DoubleType()),
    T.StructField("base_passenger_fare", T.DoubleType()),
    T.StructField("tips", T.DoubleType()),
    T.StructField("tolls", T.DoubleType()),
    T.StructField("bcf", T.DoubleType()),
    T.StructField("sales_tax", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
    T.StructField("cbd_congestion_fee", T.DoubleType()),
])

RAW_SCHEMAS = {"yellow": RAW_YELLOW_SCHEMA, "fhvhv": RAW_FHVHV_SCHEMA}


def trip_file_name(service: str, month: str) -> str:
    return f"{service}_tripdata_{month}.parquet"


def wide_schema(service: str) -> T.StructType:
    """The service's columns as they are read: 64-bit integers take both widths that published files have."""
    return T.StructType([T.StructField(f.name, T.LongType() if f.dataType == T.IntegerType() else f.dataType) for f in RAW_SCHEMAS[service]])


def typed(files: DataFrame, service: str) -> DataFrame:
    """Read files with the declared types (a value beyond them fails) and ``file_month``.

    Where the column is not used it costs nothing.
    """
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[service]]
    return files.select(*columns, F.regexp_extract(F.col("_metadata.file_path"), FILE_MONTH_PATTERN, 1).alias("file_month"))


def read_trips(spark: SparkSession, root: str, service: str,
               months: Iterable[str] | None = None) -> DataFrame:
    """All landed files of one service as one DataFrame, plus ``file_month``.

    The schema is given, not inferred, so optional fee columns that are
    missing from older files read as null. ``months=None`` reads every file;
    otherwise only the requested months' files are listed (a glob
    alternation), so unrequested months are never opened. Requested months
    with no file simply contribute no rows (see ``missing_months``).
    """
    schema = RAW_SCHEMAS[service]
    base = f"{root.rstrip('/')}/{service}_tripdata_"
    if months is None:
        pattern = base + "*.parquet"
    else:
        months = sorted(set(months))
        if not months:
            return _empty(spark, schema)
        pattern = base + "{" + ",".join(months) + "}.parquet"
    try:
        df = spark.read.schema(wide_schema(service)).parquet(pattern)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, schema)  # nothing landed for any requested month
    return typed(df, service)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*cols, F.lit(None).cast("string").alias("file_month"))


def write_trip_files(df: DataFrame, root: str, service: str, months: Iterable[str]) -> None:
    """Land rows as one folder per month, named like the published files.

    One write per requested month (a short, fixed list), each a distributed
    write of that month's rows.
    """
    for month in months:
        (df.filter(F.col("file_month") == month).drop("file_month")
         .write.mode("overwrite").parquet(f"{root.rstrip('/')}/{trip_file_name(service, month)}"))


def missing_months(spark: SparkSession, root: str, requested: Iterable[tuple[str, str]]) -> DataFrame:
    """Requested (service, month) pairs with no landed file.

    One row per file (its path, never its content) tells which months are there;
    the request list is the other side of an anti join.
    """
    req = literal_frame(spark, list(requested), "service string, file_month string")
    try:
        files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*_tripdata_*.parquet").select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return req  # nothing landed at all
    part = lambda group: F.regexp_extract("path", r"([a-z]+)" + FILE_MONTH_PATTERN, group)
    landed = files.select(part(1).alias("service"), part(2).alias("file_month")).distinct()
    return req.join(landed, ["service", "file_month"], "left_anti")


def landed_months(spark: SparkSession, root: str, service: str, months: Iterable[str]) -> list[str]:
    """Which of the months have a landed file, from file listings alone."""
    fs = spark._jvm.org.apache.hadoop.fs
    found = []
    for month in sorted(set(months)):
        path = fs.Path(f"{root.rstrip('/')}/{trip_file_name(service, month)}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            found.append(month)
    return found


CLEAN = "trips"
CLEAN_PARTS = ("service", "file_month")


def write_clean(df: DataFrame, path: str, months: Iterable[str] | None = None) -> None:
    """Write cleaned trips in folders by service and file month, and publish them at once.

    The months present in ``df`` are replaced, and of the requested ``months`` those of which
    ``df`` has no rows are emptied; other months stay. Until the write is published every
    reader sees the months as they were, and so it stays if the write fails.
    """
    change = commits.Change(df.sparkSession, path)
    gone = [f"service={s}/file_month={m}" for s in SERVICES for m in sorted(set(months or ()))]
    change.replace_parts(CLEAN, df, CLEAN_PARTS, gone)
    change.publish()


def read_clean(spark: SparkSession, path: str, schema: T.StructType | None = None, months: Iterable[str] | None = None) -> DataFrame:
    """The published clean zone, or the requested months of it (whole folders are pruned), with the columns of ``schema``."""
    clean = commits.read_committed(spark, path, CLEAN)
    if schema is not None:
        clean = clean.select(*(F.col(f.name).cast(f.dataType) for f in schema))
    return clean if months is None else clean.filter(F.col("file_month").isin(sorted(set(months))))
