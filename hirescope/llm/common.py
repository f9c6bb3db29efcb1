"""Small pieces shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.execution import cut_lineage

# The word separator of all contracts: space and U+0009..U+000D.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Cut the lineage: a table written once into the shared folder, and read back.
stash = cut_lineage


def fresh(df: DataFrame, base: str) -> str:
    """A column name made from ``base`` that ``df`` does not use."""
    used, name = {c.lower() for c in df.columns}, base
    while name.lower() in used:
        name = f"_{name}"
    return name


def held_out(doc_id: Column, folds: int) -> Column:
    """The contracts' split: crc32 of the id as text, modulo ``folds``, is 2.
    A null id counts as a training row."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 2, F.lit(False))


def words_of(text: Column) -> Column:
    """Words of a non-null text: maximal runs without separators; [] if none."""
    body = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    up = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, up, up.lower())
