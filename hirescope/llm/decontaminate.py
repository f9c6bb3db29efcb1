"""Operator 7, benchmark decontamination by size-partitioned MinHash containment
search: which documents hold at least 0.8 of a test item's word shingles?

Test items are short and documents long, so similarity says little; containment is
searched from the item's side. Items are partitioned by size: by shingle length
(five words, or all words of a shorter item) and, within it, by the number of
shingles, which sets the size of the sketch. An item's sketch holds its least
hashes (bottom-k MinHash); the share of them found among a document's shingle
hashes estimates the containment. An item of q shingles may miss at most
m = floor(q / 5) of them, so a sketch of m + 8 hashes (all, if there are fewer)
meets at least 8 (or q - m) in every document to be found: the search loses none.
Candidates are then verified exactly on the shingles' words.

All steps are DataFrame expressions. Documents are read once for the sketch search
(nothing is shuffled but hits) and once more for the candidates alone. The sketches
are broadcast if a count shows they are few, else joined by shuffle.

Words are runs of letters and digits, lower-cased. Defined results: null texts
hold no words; items without words are never found; rows that repeat a ``doc_id``
or ``item_id`` count as one document or item (their shingles unite); rows without
an id are never reported, and stay; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.llm.common import stash

SHINGLE = 5
SIMILARITY = 0.8
SPARE = 8


def _words(text: Column) -> Column:
    clean = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def _starts(words: Column, size: int) -> Column:
    return F.when(F.size(words) < size, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(words) - size))


def _hashes(words: Column, size: int) -> Column:
    return F.transform(_starts(words, size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


def _shingles(words: Column, size: int) -> Column:
    """Word tuples joined by spaces, with the hash of ``_hashes``."""
    return F.transform(_starts(words, size), lambda i: F.struct(
        F.array_join(F.slice(words, i + 1, F.lit(size)), " ").alias("shingle"),
        F.xxhash64(*[F.get(words, i + k) for k in range(size)]).alias("h")))


def item_shingles(items: DataFrame) -> DataFrame:
    """Distinct (item_id, size, shingle, h) with q, the number of the item's shingles."""
    given = items.where(F.col("item_id").isNotNull()).select("item_id", _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(SHINGLE))
    given = given.select("item_id", "words", size.alias("size"))
    parts = F.when(F.col("size") == 1, _shingles(F.col("words"), 1))
    for k in range(2, SHINGLE + 1):
        parts = parts.when(F.col("size") == k, _shingles(F.col("words"), k))
    rows = given.select("item_id", "size", F.explode(parts).alias("x")).select("item_id", "size", "x.shingle", "x.h").distinct()
    return rows.withColumn("q", F.count("*").over(Window.partitionBy("item_id")))


def sketches(shingles: DataFrame) -> DataFrame:
    """The least hashes of each item, and the hits that a document must have."""
    missing = F.floor(F.col("q") * (1 - SIMILARITY) + 1e-9)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("h"))
    return shingles.withColumn("rank", rank).where(F.col("rank") <= missing + SPARE).select(
        "item_id", "size", "h", (F.least(F.col("q"), missing + SPARE) - missing).alias("need"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item found: ``doc_id``, ``item_id``, ``n_shingles`` of
    the item, ``n_found`` of them in the document, ``containment``."""
    shingles = stash(item_shingles(items))
    few = broadcast_if_small(stash(sketches(shingles)))
    sizes = sorted(r["size"] for r in shingles.select("size").distinct().collect())  # 1 to SHINGLE
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id"), _words(F.col("text")).alias("words"))
    hits = None
    for size in sizes:
        rows = texts.select("doc_id", F.explode(_hashes(F.col("words"), size)).alias("h")).join(
            few.where(F.col("size") == size).select("item_id", "h", "need"), "h")
        hits = rows if hits is None else hits.unionByName(rows)
    if hits is None:
        return docs.limit(0).select("doc_id", F.lit(None).cast(dict(items.dtypes)["item_id"]).alias("item_id"), F.lit(0).cast("long").alias("n_shingles"),
                                    F.lit(0).cast("long").alias("n_found"), F.lit(0.0).alias("containment"))
    candidates = stash(hits.groupBy("doc_id", "item_id", "need").agg(F.count_distinct("h").alias("n")).where("n >= need").select("doc_id", "item_id"))
    suspects = texts.join(broadcast_if_small(candidates.select("doc_id").distinct()), "doc_id", "left_semi")
    wanted = broadcast_if_small(shingles)
    found = None
    for size in sizes:
        rows = suspects.select("doc_id", F.explode(_shingles(F.col("words"), size)).alias("x")).select("doc_id", "x.shingle", "x.h").join(
            wanted.where(F.col("size") == size), ["h", "shingle"]).select("doc_id", "item_id", "q", "shingle")
        found = rows if found is None else found.unionByName(rows)
    counted = found.groupBy("doc_id", "item_id", "q").agg(F.count_distinct("shingle").alias("n_found"))
    return counted.join(candidates, ["doc_id", "item_id"], "left_semi").where(F.col("n_found") >= SIMILARITY * F.col("q") - 1e-9).select(
        "doc_id", "item_id", F.col("q").cast("long").alias("n_shingles"), F.col("n_found").cast("long"),
        (F.col("n_found") / F.col("q")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    found = stash(contaminated(docs, items).select("doc_id").distinct())
    return docs.join(broadcast_if_small(found), "doc_id", "left_anti").select(*docs.columns)
