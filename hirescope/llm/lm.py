"""Operator 5, language-model scores by online logistic context mixing.

A token (a word, or the end of a text) is coded bit by bit in two parts. First its
class, by a Huffman code of the classes: each of the most frequent training tokens is a
class of its own, the others are classed by their first byte. Four predictors estimate
each bit from hashed contexts that cross tokens: none, the last two bytes before the
token, the token before it, the two tokens before it. Then the other bytes of a token
that is no class of its own and a terminator, by five predictors within the token: the
place in it, the last one, two and three bytes, and all bytes since its beginning. In
both parts the stretched probabilities are mixed by weights that a gate selects (which
bit, and how often the longer contexts have been seen), learned online by gradient steps
on coding cost, and the result is refined by an adaptive table.

What is learned covers all training documents and runs as Spark jobs:

1. token counts of the corpus (per-task counters, then a grouped sum);
2. the classes' part, in text order: a task reads its training texts one after another,
   predicts each bit from what it has read, takes a gradient step, then counts the bits;
   the tasks' counts are added, their weights averaged by mass;
3. the spelling part, from the distinct tokens with their counts (a token that is a class
   counts once): bit counts of every context, summed over tasks, then weights and the
   refinement table; a token's own occurrence is left out of the counts it learns from;
4. the spelling of every distinct token, which depends on its bytes alone;
5. per document, in text order, the classes' bits in their contexts, plus the sum of the
   tokens' spellings: the at most ``head`` most frequent tokens are broadcast, the others
   are joined by shuffle, with the same result.

Tables have a fixed size (``SLOTS`` for each predictor), so contexts share slots in a
large corpus.

Defined results: a null text counts as empty (one end token); rows keep their
number, also with repeated or null ids (a null id is a training row); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import held_out, stash

END = b"\n"          # no word holds it
ORDERS = 5
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
GATES = 8 * 4
APM_BUCKETS = 24
VIEWS = 4            # contexts of a class
VIEW_GATES = 8 * 4 * 4
CLASS_WORDS = 4096
PASSAGE = 1 << 11    # tokens handled at once: their arrays stay in a core's cache
BLOCK = 1 << 12      # bytes handled at once; eight times as many bits
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Coded:
    """Tokens as bytes with their contexts."""

    def __init__(self, tokens: list[bytes]):
        self.n = len(tokens)
        self.bytes = np.frombuffer(b" ".join(tokens) + b" ", np.uint8) if tokens else np.zeros(0, np.uint8)
        sizes = np.fromiter(map(len, tokens), np.int64, self.n) + 1
        self.token = np.repeat(np.arange(self.n), sizes)
        first = np.cumsum(sizes) - sizes
        self.place = place = np.arange(len(self.bytes)) - first[self.token]
        b = self.bytes.astype(np.uint64)
        back = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint64), b[:-k]])[:len(b)] + np.uint64(1), np.uint64(0)) for k in (1, 2, 3)]
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max()) if self.n else 1, _STEP, np.uint64), dtype=np.uint64)
            sums = np.concatenate([[np.uint64(0)], np.cumsum((b + np.uint64(1)) * powers[place], dtype=np.uint64)])
            prefix = sums[:-1] - sums[first][self.token]
            two = back[0] * np.uint64(257) + back[1]
            self.context = [np.minimum(place, 15).astype(np.uint64), back[0] + np.uint64(1 << 20), two + np.uint64(1 << 21),
                            two * np.uint64(257) + back[2] + np.uint64(1 << 30), prefix ^ _STEP]

    def blocks(self, size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Token number of each byte, and by byte and bit: the bit, the bits so far
        (with a leading 1), and the slot in each predictor's table."""
        for s in range(0, len(self.bytes), size):
            part = self.bytes[s:s + size]
            bits = np.unpackbits(part[:, None], axis=1)
            so_far = (1 << np.arange(8)) | (part[:, None].astype(np.int64) >> (8 - np.arange(8)))
            with np.errstate(over="ignore"):
                inner = so_far.astype(np.uint64) * _STEP
                slots = [(((c[s:s + size, None] * _MIX + inner) * _MIX) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for c in self.context]
            yield self.token[s:s + size], bits, so_far, slots


def stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log odds of a 1, shrunk towards 0 where little was seen."""
    n = n0 + n1
    return (np.log(n1 + 0.4) - np.log(n0 + 0.4)) * (n / (n + 1.5))


def seen_level(n: np.ndarray) -> np.ndarray:
    """0 to 3: never seen, under 4 times, under 64, more."""
    return ((n > 0).astype(np.int8) + (n >= 4) + (n >= 64)).astype(np.int8)


def gates(level: np.ndarray) -> np.ndarray:
    """Weight set by bit and by how often the longest context was seen."""
    return np.arange(8) + 8 * level.astype(np.int64)


def apm_cell(so_far: np.ndarray, z: np.ndarray) -> np.ndarray:
    return so_far * APM_BUCKETS + np.clip(((z + 12) * (APM_BUCKETS / 24)).astype(np.int64), 0, APM_BUCKETS - 1)


class Mixer:
    """Online mixing: after each small step's bits, a gradient step on the coding cost,
    scaled by a running sum of its curvature."""

    def __init__(self, start: list[float], sets: int, cells: int, rate: float = 0.7):
        self.rate, self.weights = rate, np.tile(start, (sets, 1))
        self.apm = np.zeros((2, cells * APM_BUCKETS))
        self.mass, self.bend = np.zeros(sets), np.zeros((sets, len(start)))

    def mix(self, x: np.ndarray, gate: np.ndarray, bits: np.ndarray, weight: np.ndarray, so_far: np.ndarray, step: int = 8 * BLOCK) -> None:
        """``x``: predictor x bit; the others: one value a bit."""
        sets, z = len(self.mass), np.empty(len(bits))
        for s in range(0, len(bits), step):
            part = slice(s, s + step)
            g, w, now = gate[part], weight[part], self.weights.astype(x.dtype)
            z[part] = sum(x[k, part] * now[:, k].take(g) for k in range(len(x)))
            p = 1 / (1 + np.exp(-np.clip(z[part], -30, 30)))
            err, curve = (bits[part] - p) * w, p * (1 - p) * w
            for k in range(len(x)):
                v = x[k, part]
                self.bend[:, k] = 0.98 * self.bend[:, k] + np.bincount(g, curve * v * v, sets)
                self.weights[:, k] += self.rate * np.bincount(g, err * v, sets) / (self.bend[:, k] + 1)
            self.mass += np.bincount(g, w, sets)
        cell = apm_cell(so_far, z)
        np.add.at(self.apm[0], cell, weight)
        np.add.at(self.apm[1], cell, weight * bits)


def refinement(apm: np.ndarray) -> np.ndarray:
    """The probability of a 1 in each cell."""
    middle = (np.arange(APM_BUCKETS) + 0.5) * (24 / APM_BUCKETS) - 12
    prior = np.tile(1 / (1 + np.exp(-middle)), apm.shape[1] // APM_BUCKETS)
    return ((apm[1] + 4 * prior) / (apm[0] + 4)).astype(np.float32)


class Learner(Mixer):
    """Learns the spelling part from tokens with their counts."""

    def __init__(self, inputs: list[np.ndarray], level: np.ndarray):
        super().__init__([0.0, 0.0, 0.2, 0.3, 0.5], GATES, 256)
        self.inputs, self.level = inputs, level

    @staticmethod
    def prepared(table: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """By predictor, the bit that comes, and slot: the input without that bit's own
        occurrence; and by slot how often the longest context was seen besides."""
        inputs = [np.concatenate([stretched(np.maximum(n0 - 1, 0), n1), stretched(n0, np.maximum(n1 - 1, 0))]) for n0, n1 in table]
        return inputs, seen_level(table[-1].sum(axis=0) - 1)

    def learn(self, tokens: list[bytes], counts: np.ndarray) -> None:
        for token, bits, so_far, slots in Coded(tokens).blocks():
            weight = np.repeat(counts[token][:, None], 8, axis=1)
            own = bits.astype(np.int64) * SLOTS
            x = np.stack([self.inputs[k].take((own + slots[k]).ravel()) for k in range(ORDERS)])
            gate = gates(self.level.take(slots[-1]))
            self.mix(x, gate.ravel(), bits.ravel(), weight.ravel(), so_far.ravel())


class Model:
    """The fitted model; ``log10p`` gives tokens' log10 probabilities."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, apm: np.ndarray):
        self.inputs = np.stack([stretched(t[0], t[1]) for t in table]).astype(np.float32)
        self.level = seen_level(table[-1].sum(axis=0))
        self.weights = weights.astype(np.float32)
        self.apm = refinement(apm)

    def log10p(self, tokens: list[bytes], given: int = 0) -> np.ndarray:
        """Of each token's bytes and terminator, the first ``given`` being known."""
        total, coded, done = np.zeros(len(tokens)), Coded(tokens), 0
        for token, bits, so_far, slots in coded.blocks():
            gate = gates(self.level[slots[-1]])
            z = sum(self.inputs[k][slots[k]] * self.weights[:, k][gate] for k in range(ORDERS))
            p = 0.5 / (1 + np.exp(-np.clip(z, -15, 15))) + 0.5 * self.apm[apm_cell(so_far, z)]
            cost = np.log(np.where(bits == 1, p, 1 - p).clip(1e-7, 1)).sum(axis=1, dtype=np.float64)
            total += np.bincount(token, cost * (coded.place[done:done + len(token)] >= given), len(tokens))
            done += len(token)
        return total / math.log(10)


class Classes:
    """The classes of tokens and their Huffman code: 0 to 255 by first byte, then one for
    each of ``words``. ``firsts`` and ``counts``: occurrences in training."""

    def __init__(self, words: list[bytes], counts: list[int], firsts: np.ndarray):
        self.of = {w: 256 + i for i, w in enumerate(words)}
        n = 256 + len(words)
        heap = [(int(c) + 1, i) for i, c in enumerate([*firsts, *counts])]
        heapq.heapify(heap)
        parent, side = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
        for new in range(n, 2 * n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            parent[i] = parent[j] = new
            side[j] = 1
            heapq.heappush(heap, (a + b, new))
        codes, root = [], 2 * n - 2
        for i in range(n):
            path = []
            while i != root:
                path.append((parent[i] - n, side[i]))
                i = parent[i]
            codes.append(path[::-1])
        self.length = np.array([len(c) for c in codes])
        self.start = np.cumsum(self.length) - self.length
        self.node, self.bit = np.array(list(chain.from_iterable(codes))).T.copy()
        self.nodes = n - 1


class Passage:
    """Texts (lists of tokens) in a row: each token's class and its contexts, which begin
    anew with a text. ``first``: each text's first token."""

    def __init__(self, classes: Classes, texts: list[list[bytes]]):
        self.classes, tokens = classes, list(chain.from_iterable(texts))
        self.n, sizes = len(tokens), np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(sizes) - sizes
        place = np.arange(self.n) - np.repeat(self.first, sizes)
        raw = np.frombuffer(b" ".join(tokens), np.uint8)
        width = np.fromiter(map(len, tokens), np.int64, self.n)
        last = np.cumsum(width + 1) - 2
        self.kind = np.fromiter(map(classes.of.get, tokens, raw[last - width + 1].tolist()), np.int64, self.n)
        raw = raw.astype(np.uint64)
        name = np.fromiter(map(zlib.crc32, tokens), np.uint64, self.n)

        def before(x: np.ndarray, k: int) -> np.ndarray:
            out = np.zeros(self.n, np.uint64)
            out[k:] = x[:-k] + np.uint64(1)
            return np.where(place >= k, out, np.uint64(0))

        one, tail = before(name, 1), before(raw[last] + (raw[np.maximum(last - 1, 0)] << np.uint64(8)), 1)
        with np.errstate(over="ignore"):
            self.context = [c * _MIX for c in (tail + np.uint64(1 << 40), one + np.uint64(1 << 41), (one * _STEP) ^ (before(name, 2) + np.uint64(1 << 42)))]

    def blocks(self, size: int = PASSAGE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """By bit: the token's number, the bit's place in its code, the code's node, the
        bit, and the slot in each predictor's table."""
        own = self.classes
        for s in range(0, self.n, size):
            kind = self.kind[s:s + size]
            length = own.length[kind]
            token = np.repeat(np.arange(len(kind)), length)
            depth = np.arange(len(token)) - (np.cumsum(length) - length).take(token)
            at = own.start.take(kind).take(token) + depth
            node = own.node.take(at)
            with np.errstate(over="ignore"):
                inner = node.view(np.uint64) * _STEP
                slots = [(((c[s:s + size].take(token) + inner) * _MIX) >> np.uint64(64 - SLOT_BITS)).view(np.int64) for c in self.context]
            yield token + s, depth, node, own.bit.take(at), [node, *slots]


def view_gates(depth: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Weight set by the place in the code and by how often the last token and the last
    two tokens were seen there."""
    return np.minimum(depth, 7) + 8 * one.astype(np.int64) + 32 * two.astype(np.int64)


class ClassLearner(Mixer):
    """Learns the classes' part from texts in order: a block's bits are predicted from the
    blocks before it, then counted."""

    def __init__(self, classes: Classes):
        super().__init__([0.4, 0.2, 0.3, 0.3], VIEW_GATES, classes.nodes)
        self.classes, self.table = classes, np.zeros((VIEWS, SLOTS, 2), np.float32)

    def learn(self, texts: list[list[bytes]]) -> None:
        for _, depth, node, bits, slots in Passage(self.classes, texts).blocks():
            seen = [self.table[k].take(slots[k], axis=0) for k in range(VIEWS)]
            level = [seen_level(seen[k][:, 0] + seen[k][:, 1]) for k in (-2, -1)]
            x = np.stack([stretched(n[:, 0], n[:, 1]) for n in seen])
            self.mix(x, view_gates(depth, *level), bits, np.ones(len(bits)), node)
            for k in range(VIEWS):
                np.add.at(self.table[k].reshape(-1), 2 * slots[k] + bits, np.float32(1))

    def learned(self) -> np.ndarray:
        return np.concatenate([np.ravel(x).astype(np.float32, copy=False) for x in (self.table, self.weights * self.mass[:, None], self.mass, self.apm)])


class ClassModel:
    """The fitted classes' part; ``log10p`` gives texts' log10 probabilities."""

    def __init__(self, classes: Classes, learned: np.ndarray):
        self.classes = classes
        table, weights, mass, apm = np.split(learned, np.cumsum([VIEWS * SLOTS * 2, VIEW_GATES * VIEWS, VIEW_GATES]))
        table, mass = table.reshape(VIEWS, SLOTS, 2), mass[:, None]
        self.inputs = stretched(table[:, :, 0], table[:, :, 1]).astype(np.float32)
        self.level = [seen_level(t.sum(axis=1)) for t in table[-2:]]
        self.weights = np.where(mass > 0, weights.reshape(VIEW_GATES, VIEWS) / np.maximum(mass, 1), 1 / VIEWS).astype(np.float32)
        self.apm = refinement(apm[:2 * classes.nodes * APM_BUCKETS].reshape(2, -1))

    def log10p(self, texts: list[list[bytes]]) -> np.ndarray:
        """Of the classes of each text's tokens, in order; a text has a token at least."""
        passage = Passage(self.classes, texts)
        total = np.zeros(passage.n)
        for token, depth, node, bits, slots in passage.blocks():
            gate = view_gates(depth, *(self.level[i][slots[k]] for i, k in enumerate((-2, -1))))
            z = sum(self.inputs[k].take(slots[k]) * self.weights[:, k].take(gate) for k in range(VIEWS))
            p = 0.5 / (1 + np.exp(-np.clip(z, -15, 15))) + 0.5 * self.apm[apm_cell(node, z)]
            cost = np.log(np.where(bits == 1, p, 1 - p).clip(1e-7, 1))
            total[token[0]:token[-1] + 1] = np.bincount(token - token[0], cost)
        return np.add.reduceat(total, passage.first) / math.log(10) if texts else np.zeros(0)


def tokens_of(text: pa.Scalar) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split() separates at the contract's characters."""
    return text.as_buffer().to_pybytes().lower().split() if text.is_valid else []


def token_counts(docs: DataFrame, folds: int = 7, room: int = 200_000) -> DataFrame:
    """``token``, ``c`` (occurrences in training rows), ``n`` (in all rows)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            keys = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([seen[0][k] for k in keys], pa.int64()),
                                              pa.array([seen[0][k] + seen[1][k] for k in keys], pa.int64())], ["token", "c", "n"])
            for s in seen:
                s.clear()
            return out

        for batch in batches:
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = seen[held]
                own.update(tokens_of(text))
                own[END] += 1
                if len(seen[0]) + len(seen[1]) > room:
                    yield rows()
        yield rows()

    given = docs.select(held_out(F.col("doc_id"), folds).alias("held"), F.col("text").cast("binary"))
    return given.mapInArrow(count, "token binary, c long, n long").groupBy("token").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _taken(batch: pa.RecordBatch, step: int = 50_000) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for s in range(0, batch.num_rows, step):
        part = batch.slice(s, step)
        yield part.column("token").to_pylist(), part.column("c").to_numpy().astype(np.float64)


def _spelled(batch: pa.RecordBatch, classes: Classes) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """What the spelling part learns from: a token that is a class counts once."""
    for tokens, c in _taken(batch):
        yield tokens, np.where([w in classes.of for w in tokens], 1.0, c)


def summed(rows: DataFrame, size: int, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray]) -> np.ndarray:
    """The sum over tasks of the ``size`` floats that ``work`` makes of a task's batches. A
    task sends them in pieces; each piece is summed by itself; the sum has a fixed size."""
    piece = 1 << 14

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = work(batches).astype(np.float32, copy=False)
        for i, s in enumerate(range(0, size, piece)):
            part = own[s:s + piece]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["piece", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for x in group.column("sums"))
        return pa.table({"piece": group.column("piece")[:1], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    schema = "piece int, sums binary"
    out = np.zeros(size, np.float32)
    for r in rows.mapInArrow(send, schema).groupBy("piece").applyInArrow(add, schema).collect():
        part = np.frombuffer(r["sums"], np.float32)
        out[r["piece"] * piece:r["piece"] * piece + len(part)] = part
    return out


def context_counts(counts: DataFrame, classes: Broadcast) -> np.ndarray:
    """Bit counts (predictor, bit, slot), summed over the training tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        table = np.zeros((ORDERS, 2 * SLOTS), np.float32)
        for batch in batches:
            for tokens, c in _spelled(batch, classes.value):
                for token, bits, _, slots in Coded(tokens).blocks():
                    weight, one = np.repeat(c[token].astype(np.float32), 8), bits.astype(np.int64) * SLOTS
                    for k in range(ORDERS):
                        np.add.at(table[k], (one + slots[k]).ravel(), weight)
        return table.ravel()

    return summed(counts.where("c > 0"), ORDERS * 2 * SLOTS, count).reshape(ORDERS, 2, SLOTS)


def token_classes(counts: DataFrame, words: int = CLASS_WORDS) -> Classes:
    """The ``words`` most frequent training tokens, and all others by first byte."""
    top = counts.where("c > 0").orderBy(F.desc("c"), "token").limit(words).collect()
    firsts = np.zeros(256, np.int64)
    for r in counts.where("c > 0").groupBy(F.substring("token", 1, 1).alias("b")).agg(F.sum("c").alias("c")).collect():
        firsts[r["b"][0]] = r["c"]
    for r in top:
        firsts[r["token"][0]] -= r["c"]
    return Classes([bytes(r["token"]) for r in top], [r["c"] for r in top], firsts)


def passages(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows in order, some thousand tokens or one longer text at once, and their tokens."""
    for batch in batches:
        start, texts, size = 0, [], 0
        for i, text in enumerate(batch.column(column), 1):
            texts.append([*tokens_of(text), END])
            size += len(texts[-1])
            if size >= PASSAGE or i == batch.num_rows:
                yield batch.slice(start, i - start), texts
                start, texts, size = i, [], 0


def fit_classes(docs: DataFrame, classes: Broadcast, folds: int = 7) -> ClassModel:
    """Contexts, weights and refinement from all training texts, in text order."""
    def learn(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        learner = ClassLearner(classes.value)
        for _, texts in passages(batches, 0):
            learner.learn(texts)
        return learner.learned()

    size = VIEWS * SLOTS * 2 + VIEW_GATES * (VIEWS + 1) + 2 * classes.value.nodes * APM_BUCKETS
    return ClassModel(classes.value, summed(docs.where(~held_out(F.col("doc_id"), folds)).select(F.col("text").cast("binary")), size, learn))


def fit(counts: DataFrame, classes: Broadcast) -> Model:
    """The spelling part: predictors, weights and refinement from all training tokens."""
    sc = counts.sparkSession.sparkContext
    table = context_counts(counts, classes)
    shared = sc.broadcast(Learner.prepared(table))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner(*shared.value)
        for batch in batches:
            for tokens, c in _spelled(batch, classes.value):
                learner.learn(tokens, c)
        yield pa.RecordBatch.from_arrays([pa.array([x.astype(np.float64).tobytes()], pa.binary()) for x in (
            learner.weights * learner.mass[:, None], learner.mass, learner.apm)], ["weights", "mass", "apm"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                own = [np.frombuffer(x.as_buffer(), np.float64) for x in row]
                sums = own if sums is None else [a + b for a, b in zip(sums, own, strict=True)]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in sums], ["weights", "mass", "apm"])

    schema = "weights binary, mass binary, apm binary"
    # A task's sums take about 0.1 MB; they are added in up to 16 tasks first.
    rows = counts.where("c > 0").mapInArrow(learn, schema).repartition(16).mapInArrow(add, schema).collect()
    shared.unpersist()
    total = [sum(np.frombuffer(r[k], np.float64) for r in rows) if rows else np.zeros(n) for k, n in (
        ("weights", GATES * ORDERS), ("mass", GATES), ("apm", 2 * 256 * APM_BUCKETS))]
    mass = total[1][:, None]
    weights = np.where(mass > 0, total[0].reshape(GATES, ORDERS) / np.maximum(mass, 1), 0.2)
    return Model(table, weights, total[2].reshape(2, -1))


def score_tokens(counts: DataFrame, model: Model, classes: Broadcast) -> DataFrame:
    """``counts`` with ``lp``, the log10 probability of each token's spelling when its class
    is known: 0 for a class of its own, else that of the bytes after the first."""
    shared = counts.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, own = shared.value, classes.value
        for batch in batches:
            lp = [np.where([w in own.of for w in tokens], 0.0, m.log10p(tokens, 1)) for tokens, _ in _taken(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(lp) if lp else [], pa.float64())], [*batch.schema.names, "lp"])

    return counts.mapInArrow(score, "token binary, c long, n long, lp double")


def lm_scores(docs: DataFrame, folds: int = 7, head: int = 150_000) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram), ``score`` (the model) and ``bits_per_byte``."""
    sc = docs.sparkSession.sparkContext
    counts = stash(token_counts(docs, folds))
    total, kinds = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    classes = sc.broadcast(token_classes(counts))
    in_order = sc.broadcast(fit_classes(docs, classes, folds))
    scored = stash(score_tokens(counts, fit(counts, classes), classes).withColumn("lb", F.log10((F.col("c") + 1) / F.lit(float(total + kinds + 1)))))
    # The lowest power of two that at most ``head`` tokens reach in number.
    level, tall = F.floor(F.log2("n")).cast("int"), 0
    sizes = {r["level"]: r["k"] for r in scored.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect()}
    floor = max(sizes, default=0) + 1
    while sizes.get(floor - 1, 0) + tall <= head and floor > 0:
        floor -= 1
        tall += sizes.get(floor, 0)
    top = scored.where(F.col("n") >= 2 ** floor).select("token", (F.col("c") > 0).alias("known"), "lb", "lp").toArrow()
    shared = sc.broadcast(top)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        place = {w: i for i, w in enumerate(table.column("token").to_pylist())}
        values = np.stack([table.column(k).to_numpy().astype(np.float64) for k in ("known", "lb", "lp")])
        values = np.concatenate([values, np.zeros((3, 1))], axis=1)
        last, model = table.num_rows, in_order.value
        for part, texts in passages(batches, 3):
            sums, rest = [], []
            for words in texts:
                at = np.fromiter(map(place.get, words, repeat(last)), np.int64, len(words))
                sums.append(values.take(at, axis=1).sum(axis=1))
                rest.append([words[i] for i in np.flatnonzero(at == last)])
            s = np.array(sums).reshape(-1, 3)
            size = [len(text.as_buffer()) if text.is_valid else 0 for text in part.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(map(len, texts), pa.int64()), pa.array(size, pa.int64()), pa.array(s[:, 0]), pa.array(s[:, 1]),
                 pa.array(s[:, 2] + model.log10p(texts)), pa.array(rest, pa.list_(pa.binary()))],
                ["row", "doc_id", "held_out", "n_tokens", "n_bytes", "known", "lb", "lp", "rest"])

    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id"), folds).alias("held_out"), F.col("text").cast("binary").alias("text"))
    # Written once, so a row's number cannot change between its uses.
    parts = stash(given.mapInArrow(score, "row long, doc_id long, held_out boolean, n_tokens long, n_bytes long, known double, lb double, lp double, rest array<binary>"))
    others = scored.where(F.col("n") < 2 ** floor).select("token", (F.col("c") > 0).cast("long").alias("known"), "lb", "lp")
    sums = parts.select("row", F.explode("rest").alias("token")).join(others, "token").groupBy("row").agg(
        F.sum("known").alias("k2"), F.sum("lb").alias("lb2"), F.sum("lp").alias("lp2"))
    out = parts.drop("rest").join(sums, "row", "left")
    score_of = F.col("lp") + F.coalesce("lp2", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known").cast("long") + F.coalesce("k2", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("lb") + F.coalesce("lb2", F.lit(0.0))).alias("base_score"),
        score_of.alias("score"), (-score_of * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))
