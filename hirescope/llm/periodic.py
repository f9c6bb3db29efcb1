"""Operator 11, periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q, long enough
(``min_exponent`` periods and ``min_length`` words), that no neighbouring word extends.

Texts come in Arrow batches; a batch's texts, as word numbers with a separator of
their own kind between any two, make one sequence. Alternate block compression
(maximal blocks a^k become one symbol) and pair compression (a hashed bit calls every
symbol left or right; each left-right pair becomes one symbol) turn it into a
run-length grammar, a level at a time and only as high as a query climbs. Equal
stretches are parsed alike but for their borders, so a longest common extension climbs
the levels while it matches and descends to the first word that differs, with a fixed
number of steps a level, to either side.

Candidates lie on a harmonic grid: for period q every (max(min_exponent * q, min_length)
- q)-th word that equals the one q later, n ln n / (min_exponent - 1) places at most, of
which every run holds one. Both extensions of a candidate are exact; a stretch found
with several periods has the least. No suffix array is built and nothing leaves the
text's task: the plan has no shuffle.

Defined results: null text counts as empty, without runs and with an empty collapsed
text; rows keep their number and their order does not matter, repeated and null ids
included; runs are ordered by start, then period, so there are no ties; an empty table
gives an empty result; other columns are ignored. A text is held whole by its task, some
300 bytes a word of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import words_of

MIN_EXPONENT = 4
MIN_LENGTH = 6
BLOCK_WORDS = 1 << 18    # words whose texts share a grammar, if they are not one text's
BLOCK_PLACES = 1 << 18   # candidates resolved together
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Grammar:
    """The levels of a sequence whose first and last symbol occur once each.

    ``symbols[l]``: the sequence at level l. ``begin[l][k]``: where symbol k of level
    l + 1 begins at level l, one entry more at the end; ``parent[l][i]``: the symbol of
    level l + 1 that holds place i. Even levels are parsed into blocks, odd ones into pairs.
    """

    def __init__(self, sequence: np.ndarray) -> None:
        self.symbols = [sequence.astype(np.int64)]
        self.begin: list[np.ndarray] = []
        self.parent: list[np.ndarray] = []
        self.fresh = int(sequence.max()) + 1

    def climb(self) -> None:
        """Parse the highest level."""
        level, s = len(self.begin), self.symbols[-1]
        n = len(s)
        opens = np.ones(n, bool)
        if level % 2 == 0:
            opens[1:] = s[1:] != s[:-1]
            start = np.append(np.flatnonzero(opens), n)
            length = np.diff(start)
            merged = length > 1
            key = s[start[:-1]][merged] * (int(length.max()) + 1) + length[merged]
        else:
            mixed = (s.astype(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left = (mixed >> np.uint64(40)) & np.uint64(1) == 1
            first = np.flatnonzero(left[:-1] & ~left[1:])
            opens[first + 1] = False
            start = np.append(np.flatnonzero(opens), n)
            merged = np.diff(start) > 1
            key = s[first] * self.fresh + s[first + 1]
        up = s[start[:-1]]
        if len(key):
            kinds, number = np.unique(key, return_inverse=True)
            up[merged] = self.fresh + number
            self.fresh += len(kinds)
        self.begin.append(start)
        self.parent.append(np.cumsum(opens) - 1)
        self.symbols.append(up)

    def _reach(self, level: int, at: np.ndarray, step: int) -> np.ndarray:
        """Places from ``at`` to the end, in direction ``step``, of the parent that holds it."""
        begin, parent = self.begin[level], self.parent[level][at]
        return begin[parent + 1] - at if step > 0 else at - begin[parent] + 1

    def _inside(self, level: int, at: np.ndarray, step: int) -> np.ndarray:
        """Whether the parent that holds ``at`` begins before it, seen in direction ``step``."""
        begin, parent = self.begin[level], self.parent[level][at]
        return begin[parent] != at if step > 0 else begin[parent + 1] - 1 != at

    def extend(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on agree, to the right (step 1) or
        to the left (step -1); i and j differ everywhere."""
        x, y = i.copy(), j.copy()
        stopped = np.zeros(len(x), np.int64)
        live, level = np.arange(len(x)), 0
        while len(live):
            s = self.symbols[level]
            same = s[x[live]] == s[y[live]]
            stopped[live[~same]] = level
            live = live[same]
            if not len(live):
                break
            if level == len(self.begin):
                self.climb()
            a, b = x[live], y[live]
            part = self._inside(level, a, step) | self._inside(level, b, step)
            to_a, to_b = self._reach(level, a, step), self._reach(level, b, step)
            by = np.where(part, np.minimum(to_a, to_b), 0) * step
            x[live], y[live] = a + by, b + by
            ends = part & (to_a != to_b)
            stopped[live[ends]] = level
            live = live[~ends]
            x[live], y[live] = self.parent[level][x[live]], self.parent[level][y[live]]
            level += 1
        for level in range(int(stopped.max(initial=0)) - 1, -1, -1):
            down = np.flatnonzero(stopped > level)
            begin, s = self.begin[level], self.symbols[level]
            a, b = (begin[x[down]], begin[y[down]]) if step > 0 else (begin[x[down] + 1] - 1, begin[y[down] + 1] - 1)
            by = np.minimum(self._reach(level, a, step), self._reach(level, b, step)) if level % 2 == 0 else 1
            by = np.where(s[a] == s[b], by, 0) * step
            x[down], y[down] = a + by, b + by
        return (x - i) * step


def find_runs(sequence: np.ndarray, longest: int, min_exponent: int = MIN_EXPONENT,
              min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs of a sequence, ordered by start and period.

    The first and last symbol occur once each; ``longest`` bounds the length of a
    stretch without a symbol that occurs once.
    """
    grammar, n = Grammar(sequence), len(sequence)
    found, places, periods, held = [], [], [], 0

    def resolve() -> None:
        nonlocal held
        i, q = np.concatenate(places), np.concatenate(periods)
        places.clear(), periods.clear()
        held = 0
        # Unless one place is enough for a run, a neighbouring one agrees too.
        beside = (sequence[i + 1] == sequence[i + 1 + q]) | (sequence[i - 1] == sequence[i - 1 + q])
        beside |= np.maximum(min_length, min_exponent * q) - q < 2
        i, q = i[beside], q[beside]
        after, before = grammar.extend(i, i + q, 1), grammar.extend(i, i + q, -1)
        start, end = i - before + 1, i + q + after
        enough = end - start >= np.maximum(min_length, min_exponent * q)
        rows = np.stack([start[enough], end[enough], q[enough]])
        rows = rows[:, np.lexsort(rows[::-1])]  # by start, end, period: the first of a stretch has its least period
        found.append(rows[:, np.append(True, (np.diff(rows[:2]) != 0).any(axis=0))] if rows.shape[1] else rows)

    for q in range(1, longest // min_exponent + 1):
        if min_length > longest:
            break
        grid = max(min_length, min_exponent * q) - q
        here = sequence[1:n - q - 1:grid]
        at = np.flatnonzero(here == sequence[1 + q:n - 1:grid][:len(here)])
        if len(at):
            places.append(at * grid + 1)
            periods.append(np.full(len(at), q, np.int64))
            held += len(at)
            if held >= BLOCK_PLACES:
                resolve()
    if held:
        resolve()
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, q = np.concatenate(found, axis=1)
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    first = np.append(True, (np.diff(start) != 0) | (np.diff(end) != 0)) if len(start) else np.zeros(0, bool)
    start, end, q = start[first], end[first], q[first]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _runs_of_block(texts: list[list[bytes]], min_exponent: int, min_length: int) -> Iterator[tuple[list[dict], bytes]]:
    """Runs and collapsed text of each text, given as its words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = [w for t in texts for w in t]
    numbers = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    offset = np.cumsum(sizes + 1) - sizes             # where each text begins; a separator stands before it
    total = int(sizes.sum()) + len(texts) + 1
    sequence = len(flat) + np.arange(total, dtype=np.int64)  # separators differ from all words and from each other
    sequence[np.arange(len(flat)) + np.repeat(np.arange(1, len(texts) + 1), sizes)] = numbers
    start, end, q = find_runs(sequence, int(sizes.max(initial=0)), min_exponent, min_length)
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, start + q, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change) > 0
    bounds = np.searchsorted(start, np.append(offset, total))
    for k, words in enumerate(texts):
        a, b, o = bounds[k], bounds[k + 1], int(offset[k])
        if a < b:
            gone = dropped[o:o + len(words)]
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        runs = [{"start": s - o, "length": e - s, "period": p}
                for s, e, p in zip(start[a:b].tolist(), end[a:b].tolist(), q[a:b].tolist(), strict=True)]
        yield runs, b" ".join(words)


def periodic_runs(docs: DataFrame, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``runs`` (start, length, period, in words), and
    ``collapsed``, the words that no run repeats, joined by one space: of every run the
    first period stays."""
    if min_exponent < 2:
        raise ValueError("min_exponent must be at least 2")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs, collapsed = zip(*_runs_of_block(texts, min_exponent, min_length), strict=True)
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "runs", "collapsed"])

        for batch in batches:
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_buffer().to_pybytes().split() if text.is_valid else [])
                held += len(texts[-1]) + 1
                if held >= BLOCK_WORDS:
                    yield block(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield block(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(fold, SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: in documents whose h = crc32(doc_id as text) divides by 10,
    the words from a = g % n on repeat the p words that begin there (g = h div 10,
    p = 1 + (n - a) div (3 + g % 8)). A null id changes nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        "doc_id", "text", F.floor(h / 10).alias("g"),
        F.when((h % 10 == 0) & F.col("text").isNotNull(), words_of(F.col("text")))
         .otherwise(F.array().cast("array<string>")).alias("w"))
    placed = chosen.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    placed = placed.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", source(i).cast("int")))
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def runs_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: per document the number of runs, the longest one (ties:
    least start, then least period), and digests of all runs and of the collapsed text."""
    found = periodic_runs(with_planted_runs(docs))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("m", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("m.s").alias("start"), (-F.col("m.l")).alias("length"),
        F.col("m.p").alias("period"), F.floor(-F.col("m.l") * 1000 / F.col("m.p")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
