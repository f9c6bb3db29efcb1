"""CSV sources and sinks (A1, A3) and the shared table (A4).

Schemas are explicit: inference scans the data and depends on it, and a
posting table at scale must not be read twice to guess types.

Spark reads a multi-line CSV file in one task. Here files are read as lines, in as many
byte ranges as they have, and records are put together again (``csv_records``): a line
begins a record if the quotes before it, in its file, are even in number. That parity is
a prefix sum in two levels, over the ranges of a file (few rows) and over the lines of a
range (bounded by the range's size). Only records of several lines are shuffled.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from hirescope.execution import broadcast_if_small, cut_lineage

# Posting columns the library understands; others in a file are read as strings.
POSTING_FIELDS = [
    ("posting_id", T.LongType()), ("company_name", T.StringType()), ("title", T.StringType()),
    ("description", T.StringType()), ("max_salary", T.DoubleType()), ("pay_period", T.StringType()),
    ("location", T.StringType()), ("company_id", T.DoubleType()), ("views", T.DoubleType()),
    ("med_salary", T.DoubleType()), ("min_salary", T.DoubleType()),
    ("formatted_work_type", T.StringType()), ("applies", T.DoubleType()),
    ("original_listed_time", T.DoubleType()), ("remote_allowed", T.DoubleType()),
    ("job_posting_url", T.StringType()), ("application_url", T.StringType()),
    ("application_type", T.StringType()), ("expiry", T.DoubleType()), ("closed_time", T.DoubleType()),
    ("formatted_experience_level", T.StringType()), ("skills_desc", T.StringType()),
    ("listed_time", T.DoubleType()), ("posting_domain", T.StringType()), ("sponsored", T.DoubleType()),
    ("work_type", T.StringType()), ("currency", T.StringType()), ("compensation_type", T.StringType()),
    ("normalized_salary", T.DoubleType()), ("zip_code", T.StringType()), ("fips", T.DoubleType()),
]
_KNOWN = dict(POSTING_FIELDS)


REJECT = "_rejected_line"


def _csv_reader(spark: SparkSession):
    return (spark.read.option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE"))


def posting_schema(header: list[str]) -> T.StructType:
    """Schema for a posting file with the given header: known columns typed, others strings."""
    return T.StructType([T.StructField(c, _KNOWN.get(c, T.StringType()), True) for c in header])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, record): the records of the CSV files below ``path`` without their
    headers, each file's first record; blank lines between records are left out."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    # Written once: a line's place cannot change between its uses.
    lines = cut_lineage(lines.withColumn("odd", (quotes % 2).cast("int")))
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = ranges.select("file", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("open"))
    # One row per byte range read.
    told = lines.join(broadcast_if_small(opened), ["file", "block"]).withColumn(
        "begins", (F.col("open") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 0)
    # The line that begins a line's record: in its own range, or in the last earlier range that has one.
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct("block", "at")
    told = cut_lineage(told.withColumn("head", F.last(F.when(F.col("begins"), place), ignorenulls=True).over(upto)))
    last = told.groupBy("file", "block").agg(F.max(F.when(F.col("begins"), place)).alias("head"))
    carried = last.select("file", "block", F.last("head", ignorenulls=True).over(earlier).alias("carried"))
    parts = told.join(broadcast_if_small(carried), ["file", "block"]).withColumn("head", F.coalesce("head", "carried"))
    whole = F.col("begins") & (F.col("odd") == 0)
    joined = (parts.where(~whole).groupBy("file", "head")
                   .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n").alias("record")))
    records = parts.where(whole).select("file", "head", F.col("value").alias("record")).unionByName(joined).select(
        "file", "head", F.rtrim("record", F.lit("\r")).alias("record")).where("record <> ''")
    records = cut_lineage(records)
    heads = records.groupBy("file").agg(F.min(F.struct("head", "record")).alias("first"))  # one row per file
    return (records.join(broadcast_if_small(heads), "file").where(F.col("head") > F.col("first.head"))
                   .select("file", F.col("first.record").alias("header"), "record"))


def _columns(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]))


def read_postings_checked(spark: SparkSession, path: str, header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """A1: (postings, rejects) of a CSV file or folder; descriptions may span lines.

    Columns are matched by name: files whose headers differ in order or set are read
    by their own header and united, missing columns being null. With ``header`` all
    files are taken to have that one. A row with a value that does not fit its type
    (or too many values) is not guessed at: it goes to the rejects, as its raw text.
    A large file is read by many tasks; all headers are found in one pass.
    """
    records = csv_records(spark, path)
    headers = [header] if header is not None else [r[0] for r in records.select("header").distinct().orderBy("header").collect()]
    out = None
    for h in headers or [[]]:
        names = list(h) if header is not None else _columns(h) if h else []
        schema = T.StructType([*posting_schema(names).fields, T.StructField(REJECT, T.StringType())])
        own = records if header is not None or not names else records.where(F.col("header") == h)
        options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": REJECT}
        df = own.select(F.from_csv("record", schema.simpleString(), options).alias("r")).select("r.*")
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    good = out.where(F.col(REJECT).isNull()).drop(REJECT)
    return good, out.where(F.col(REJECT).isNotNull())


def read_postings_csv(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """A1, strict: as ``read_postings_checked``, but a rejected row fails the read."""
    good, bad = read_postings_checked(spark, path, header)
    n = len(bad.take(1))
    if n:
        raise ValueError(f"{path} has rows that do not fit the schema; see read_postings_checked")
    return good


def read_lexicon_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2 input: every column as string (the phrase column is ``Skill`` or the first)."""
    return _csv_reader(spark).option("inferSchema", False).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: CSV with header (quote-escaped, multi-line safe)."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def share(df: DataFrame, name: str, key: str | None = None, buckets: int | None = None) -> DataFrame:
    """A4: keep the filtered table for every consumer.

    Without ``key``: cached, with a temporary view. With ``key``: a table of the
    warehouse, bucketed and sorted by it, so that joins and groupings on the key
    (J5, J18, J20, C2) of tables shared with the same number of buckets (default:
    ``spark.sql.shuffle.partitions``) need no exchange, in this session and in later ones.
    """
    if key is None:
        out = df.persist()
        out.createOrReplaceTempView(name)
        return out
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Dealt as it is bucketed: one file per bucket.
    df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
