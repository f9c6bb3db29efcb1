"""Operator 6, near-duplicate documents by SimHash.

Fingerprints are made in one pass over Arrow batches. Links (at most two differing
bits) are found by segment popcounts: each of the 32 two-bit segments of a
fingerprint maps to its number of set bits, a point of a grid of 32 dimensions.
The Manhattan distance of two points is a lower bound of the Hamming distance, and
two points at distance two or less always share a grid point at distance one or
less from both. So the range join is an equality join on grid points: each
distinct fingerprint is entered at its point and that point's neighbours (about
50), and one that meets no other there has no link.

Those left are verified exactly, with the same idea on bits: fingerprints that
share a 64-bit value at Hamming distance one or less are within two bits of each
other, all of them, and all pairs within two bits share such a value. At most 65
fingerprints can share one, so linking each to the least of them loses no link
and no pairs of large groups are formed. Only distinct fingerprints take part;
copies hang on theirs.

Defined results: null text counts as empty; a text without words has fingerprint
zero and links like any other; rows keep their number, also with repeated or null
ids (a component of null ids only has a null id); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.llm.common import stash
from hirescope.llm.components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    size, body = min(shingle, len(words)), b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n, counts, step = len(words) - size + 1, np.zeros(64, np.int64), 1 << 14
    digest = xxhash.xxh64_intdigest
    for s in range(0, n, step):
        e = min(n, s + step)
        spans = zip(starts[s:e].tolist(), (ends[s + size - 1:e + size - 1] - 1).tolist(), strict=True)
        h = np.fromiter((digest(body[a:b], SEED) for a, b in spans), np.uint64, e - s)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` of every row."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = [simhash(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(fold, "doc_id long, fp long")


def _flip(x: Column, mask: int) -> Column:
    signed = mask - (1 << 64) if mask >> 63 else mask
    return x.bitwiseXOR(F.lit(signed).cast("long"))


def _const(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def popcount_point(fp: Column) -> Column:
    """The set bits (0 to 2) of each two-bit segment, packed into two bits each."""
    low = fp.bitwiseXOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(_const(0x5555555555555555))
    high = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(_const(0xAAAAAAAAAAAAAAAA))
    return low.bitwiseOR(high)


def grid_points(point: Column) -> Column:
    """A grid point and all its neighbours at Manhattan distance one."""
    out = [point]
    for j in range(0, 64, 2):
        segment = F.shiftrightunsigned(point, j).bitwiseAND(F.lit(3).cast("long"))
        out.append(F.when(segment != 2, _flip(point, 1 << j)))    # 0 to 1, 1 to 0
        out.append(F.when(segment != 0, _flip(point, 3 << j)))    # 1 to 2, 2 to 1
    return F.array(*out)


def near_links(distinct: DataFrame) -> DataFrame:
    """``distinct``: unique ``fp``. Pairs (a, b) that connect all fingerprints within
    two bits of each other; every pair given is within two bits."""
    at = distinct.select("fp", F.explode(grid_points(popcount_point(F.col("fp")))).alias("cell")).where("cell IS NOT NULL")
    met = at.withColumn("n", F.count("*").over(Window.partitionBy("cell"))).where("n > 1").select("fp").distinct()
    around = met.select("fp", F.explode(F.array(F.col("fp"), *[_flip(F.col("fp"), 1 << j) for j in range(64)])).alias("centre"))
    least = around.withColumn("low", F.min("fp").over(Window.partitionBy("centre")))
    return least.where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the least id it reaches, per row."""
    marked = stash(fingerprints(docs, shingle))
    distinct = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = connected_components(near_links(distinct.select("fp"))).select(F.col("node").alias("fp"), "root")
    known = distinct.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    return marked.join(known.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    return simhash_components(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one of least id. Rows that
    repeat an id stay or go together; rows without an id stay."""
    found = simhash_components(docs)
    gone = stash(found.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("first")).where("first = 0").select("doc_id"))
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)
