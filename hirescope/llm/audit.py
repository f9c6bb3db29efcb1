"""Operator 13, audit of how document filters interact, over a sparse document-term matrix.

1. Each block of texts is counted into a CSR shard (Arrow batches, numpy). A word's
   global number is its 64-bit hash; a shard lists the numbers of its columns and indexes
   that list. A task sends each word that is new to it once; that a word is not new is
   told by its number and a second hash.
2. The words sent make the global dictionary, a written table of distinct (number, word);
   no text and no shard is shuffled for it, and a word that is in all texts is one row a
   task. Two words with one number: the matrix is made anew with another seed, so the
   numbers tell words apart at any size.
3. Row sums of the shards are the words of a document, their nonzero counts its distinct
   words; these decide filters A and B.
4. The other flags are attached: C and D are read from the text in step 1, E compares the
   least id of a text's 256-bit digest. Rows are collapsed by id, then by digest and what
   the audit needs to know, before the least id of a digest is taken, so a group of copies
   never meets in one task.
5. What is left is a count for each part and each of the 32 sets of failed filters, from
   which all orders follow: a part's (at most 32) counts go into one row, and each order
   and step sums them.

Defined results: null text counts as empty (it fails A only, and E like any other text);
null source is the part ''; labels may repeat a document, one row with the value is
enough, and null labels are no; repeated rows each count, and rows that share an id are
not copies of one another by filter E; a row without id has no lesser one and is none; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.llm.common import stash

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_CAPITALS_PCT = 2
SYMBOLS = b"#$%&*|"
SHARD_WORDS = 1 << 18    # words of a shard, if they are not one text's
PIECE_OCTETS = 8 << 20   # octets of texts split into words at once, if they are not one text's
# Spark reads up to 4,096 rows of a row group at once, and a shard is a row of megabytes.
FEW_SHARDS = {"parquet.block.row.count.limit": "4"}

SHARD = ("shard long, doc_id array<long>, part array<string>, digest array<binary>, flags array<int>, "
         "indptr array<long>, indices array<int>, counts array<int>, columns array<long>, "
         "new_ids array<long>, new_words array<string>")
ROW_SUMS = "doc_id long, part string, digest binary, flags int, n_words long, n_distinct long"

_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[ord("A"):ord("Z") + 1] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Borders and octets of an array of strings."""
    borders = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    return borders, np.frombuffer(texts.buffers()[2] or b"", np.uint8)


def text_flags(octets: np.ndarray) -> int:
    """Filters C (4) and D (8) of a UTF-8 text."""
    points = int(((octets & 0xC0) != 0x80).sum())
    return 4 * (100 * int(_IS_CAPITAL[octets].sum()) > MAX_CAPITALS_PCT * points) + 8 * bool(_IS_SYMBOL[octets].any())


def word_numbers(words: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit multilinear hash of each word (none is empty): octets times seeded factors by place."""
    if not len(words):
        return np.zeros(0, np.int64)
    borders, octets = _buffers(words)
    octets, length = octets[borders[0]:borders[-1]], np.diff(borders)
    place = np.arange(len(octets)) - np.repeat(borders[:-1] - borders[0], length)
    factor = np.random.default_rng(seed).integers(0, 1 << 64, int(length.max()), np.uint64) | np.uint64(1)
    total = np.add.reduceat((octets.astype(np.uint64) + np.uint64(1)) * factor[place], borders[:-1] - borders[0])
    return ((total ^ (total >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each has."""
    trimmed = pc.ascii_trim_whitespace(texts)
    parts = pc.ascii_split_whitespace(trimmed)
    empty = pc.equal(trimmed, "").to_numpy(zero_copy_only=False)
    sizes = np.where(empty, 0, pc.list_value_length(parts).to_numpy())
    words = parts.flatten()
    return words.filter(pc.not_equal(words, "")) if empty.any() else words, sizes


def _csr(words: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """indptr, indices, counts and the word list of a block of texts."""
    coded = words.dictionary_encode()
    kinds = max(len(coded.dictionary), 1)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    cells, counts = np.unique(rows * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    indptr = np.searchsorted(cells, np.arange(len(sizes) + 1, dtype=np.int64) * kinds)
    return indptr, (cells % kinds).astype(np.int32), counts.astype(np.int32), coded.dictionary


def _one(values: pa.Array) -> pa.Array:
    """One list of all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, texts (column 3) of up to ``PIECE_OCTETS`` at once."""
    for batch in batches:
        borders, since = _buffers(batch.column(3))[0], 0
        while since < batch.num_rows:
            until = max(since + 1, int(np.searchsorted(borders, int(borders[since]) + PIECE_OCTETS, "right")) - 1)
            yield batch.slice(since, until - since)
            since = until


def shards(docs: DataFrame, seed: int) -> DataFrame:
    """CSR shards of ``docs``: ``indices`` point into ``columns``, the words' numbers under
    ``seed``; ``new_ids`` and ``new_words`` are those that the task had not sent before."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, sent, sent_check = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)  # ordered by number
        for batch in _pieces(batches):
            borders, octets = _buffers(batch.column(3))
            words, sizes = split_words(batch.column(3))
            ends, since, first = np.cumsum(sizes), 0, 0
            while since < batch.num_rows:
                until = max(since + 1, int(np.searchsorted(ends, first + SHARD_WORDS, "right")))
                last = int(ends[until - 1])
                indptr, indices, counts, kinds = _csr(words.slice(first, last - first), sizes[since:until])
                columns, check = word_numbers(kinds, 2 * seed), word_numbers(kinds, 2 * seed + 1)
                if len(sent):
                    at = np.minimum(np.searchsorted(sent, columns), len(sent) - 1)
                    new = np.flatnonzero((sent[at] != columns) | (sent_check[at] != check))
                else:
                    new = np.arange(len(columns))
                order = np.argsort(merged := np.concatenate([sent, columns[new]]), kind="stable")
                sent, sent_check = merged[order], np.concatenate([sent_check, check[new]])[order]
                key = (TaskContext.get().partitionId() << 32) + made
                made += 1
                flags = [text_flags(octets[borders[i]:borders[i + 1]]) for i in range(since, until)]
                given = batch.slice(since, until - since)
                lists = [given.column(0), given.column(1), given.column(2), pa.array(flags, pa.int32()), pa.array(indptr, pa.int64()),
                         pa.array(indices), pa.array(counts), pa.array(columns), pa.array(columns[new]), kinds.take(pa.array(new))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], pa.int64()), *map(_one, lists)],
                    ["shard", "doc_id", "part", "digest", "flags", "indptr", "indices", "counts", "columns", "new_ids", "new_words"])
                since, first = until, last

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text")).mapInArrow(count, SHARD)


def term_matrix(docs: DataFrame, first_seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix of ``docs`` (doc_id, source, text) as CSR shards, and the
    dictionary (word_id, word) of its columns; both are written."""
    for seed in itertools.count(first_seed):
        matrix = stash(shards(docs, seed), FEW_SHARDS)
        sent = matrix.select(F.explode(F.arrays_zip("new_ids", "new_words")).alias("e"))
        dictionary = stash(sent.select(F.col("e.new_ids").alias("word_id"), F.col("e.new_words").alias("word")).distinct())
        if dictionary.groupBy("word_id").count().where("count > 1").isEmpty():
            return matrix.drop("new_ids", "new_words"), dictionary


def row_sums(matrix: DataFrame) -> DataFrame:
    """Per document of the matrix: its words (row sum) and distinct words (nonzero count)."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, part, digest, flags, indptr, indices, counts, columns = (batch.column(c)[i].values for c in range(8))
                bounds = indptr.to_numpy()
                total = np.concatenate([[0], np.cumsum(counts.to_numpy(), dtype=np.int64)])
                ids, number = np.unique(columns.to_numpy(), return_inverse=True)
                rows = np.repeat(np.arange(len(doc_id)), np.diff(bounds))
                cells = np.unique(rows * max(len(ids), 1) + number[indices.to_numpy()])
                nonzero = np.bincount(cells // max(len(ids), 1), minlength=len(doc_id))
                yield pa.RecordBatch.from_arrays(
                    [doc_id, part, digest, flags, pa.array(np.diff(total[bounds])), pa.array(nonzero, pa.int64())],
                    ["doc_id", "part", "digest", "flags", "n_words", "n_distinct"])

    return matrix.select("doc_id", "part", "digest", "flags", "indptr", "indices", "counts", "columns").mapInArrow(fold, ROW_SUMS)


def failed_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed filters (bit 0 is A)."""
    sums = row_sums(term_matrix(docs)[0])
    fails_a = F.col("n_words") < MIN_WORDS
    fails_b = 100 * F.col("n_distinct") < MIN_DISTINCT_PCT * F.col("n_words")
    # A narrow table, written because it is read twice: rows without id skip the labels' join.
    rows = stash(sums.withColumn("mask", F.col("flags") + fails_a.cast("int") + 2 * fails_b.cast("int"))
                     .groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"))
    unknown = F.lit(False)
    marked = rows.where("doc_id IS NOT NULL").join(known, "doc_id", "left").unionByName(
        rows.where("doc_id IS NULL").withColumns({"is_good": unknown, "is_toxic": unknown}))
    # A digest's rows come to one for each part and label before they meet.
    texts = (marked.groupBy("digest", "part", "mask", F.coalesce("is_good", unknown).alias("is_good"),
                            F.coalesce("is_toxic", unknown).alias("is_toxic"))
                   .agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
                        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_nameless")))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    kept = F.col("n_nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = texts.withColumn("first", first).withColumn("n_first", kept).select(
        "part", "is_good", "is_toxic", F.explode(F.array(
            F.struct("mask", F.col("n_first").alias("n")),
            F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")))).alias("x"))
    among = lambda c: F.sum(F.when(F.col(c), F.col("x.n")).otherwise(0))
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), among("is_good").alias("good"), among("is_toxic").alias("toxic"))


def order_steps() -> Column:
    """Every order of the filters and step of it, with the step's bit and the bits applied
    before: one literal of 600 rows."""
    out = []
    for order in permutations(FILTERS):
        bits = [1 << FILTERS.index(letter) for letter in order]
        out += [{"filter_order": "".join(order), "step": k + 1, "bit": bits[k], "before": sum(bits[:k])} for k in range(len(bits))]
    return F.from_json(F.lit(json.dumps(out)), "array<struct<filter_order:string,step:int,bit:int,before:int>>")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step: ``kept``, ``removed``,
    ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost`` and ``shapley``."""
    # At most 32 sets a part.
    parts = failed_sets(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))
    steps = parts.select("part", "sets", F.explode(order_steps()).alias("o")).select("part", "sets", "o.*")
    bit, before = F.col("bit"), F.col("before")
    has = lambda m, b: m.bitwiseAND(b) != 0

    def total(value: str, where) -> Column:
        term = lambda s: F.when(where(s["mask"]), s[value]).otherwise(0)
        return F.aggregate("sets", F.lit(0).cast("long"), lambda acc, s: acc + term(s))

    removed = lambda m: has(m, bit) & ~has(m, before)
    share = lambda s: s["n"] * F.floor(120 / F.bit_count(s["mask"]))  # noqa: E731  a set of b filters loses its documents to each in 120 / b orders
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~has(m, before.bitwiseOR(bit))).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda m: has(m, bit) & has(m, before)).alias("redundant"), total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        F.aggregate("sets", F.lit(0).cast("long"), lambda acc, s: acc + F.when(has(s["mask"], bit), share(s)).otherwise(0)).alias("shapley"))


SQL = r"""
WITH counted AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e FROM counted),
marked AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         coalesce(good, false) AS good, coalesce(bad, false) AS bad
  FROM flags LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id) USING (doc_id)),
sets AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.bit + w.bit + x.bit + y.bit + z.bit = 31
    AND len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
firsts AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (mask & bit > 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM firsts
"""
