"""Operator 4, toxicity by a convolutional text classifier written in numpy:
hashed word embeddings, filters of several widths, max pooling over the whole
text, a logistic output, and a threshold calibrated for each language.

A word's embedding is the sum of hashed rows for the word itself and for its
beginnings of 3 to 8 characters, so inflected and compound forms share what was
learned. All labelled rows are learned from, in Spark tasks: texts by class and bucket are
counted, then each task trains the network on its rows and the tasks' moves are
averaged, so only arrays of the network's size reach the driver. A quarter of the
labelled rows is kept apart to calibrate; their scores are counted in ``STEPS`` steps.
Scoring is one pass over Arrow batches without a shuffle, with whole texts.

The language used for calibration is predicted from the text (operator 2), never
read from a column. Raw probabilities are mapped, monotonically and per language,
so that the calibrated threshold falls on ``THRESHOLD``.

Defined results: a null or empty text scores as a text without words (the network's
bias alone, mapped below the threshold); with no labelled rows of both kinds every
score is 0; a document with several labels counts as toxic if one says so; rows
keep their number, also with repeated or null ids; other columns are ignored.
"""

from __future__ import annotations

import copy
import ctypes
import gc
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.execution import DEFAULT_BROADCAST_ROWS, broadcast_if_small
from hirescope.llm.common import held_out, stash
from hirescope.llm.langid import GAP, UNKNOWN, LangScorer, WordTable, fit_lang_model, letter_words, units

THRESHOLD = 0.3
BUCKETS = 1 << 17
PARTS = 7          # the word and its beginnings of 3..8 characters
WIDTHS = (1, 2, 3)
STEPS = 10_000     # of the scores that calibrate


def word_ids(word: str) -> list[int]:
    """Bucket numbers of a word and its beginnings; bucket 0 stands for none."""
    keys = [f"={word}", *(word[:n] if len(word) >= n else "" for n in range(3, 9))]
    return [zlib.crc32(k.encode()) % (BUCKETS - 1) + 1 if k else 0 for k in keys]


class TextCNN:
    """Embedding (bucket x dim), filters of ``WIDTHS`` (``n_filters`` of each), output."""

    def __init__(self, dim: int = 8, n_filters: int = 6, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.dim, self.n_filters = dim, n_filters
        self.embed = rng.normal(0, 0.05, (BUCKETS, dim)).astype(np.float32)
        self.embed[0] = 0
        self.filters = rng.normal(0, 0.3, (dim, sum(WIDTHS) * n_filters)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * n_filters, np.float32)
        self.out, self.out_bias = rng.normal(0, 0.3, len(WIDTHS) * n_filters).astype(np.float32), np.float32(0)

    def slots(self) -> Iterator[tuple[int, int, list[slice]]]:
        """Number, width and, for each place in the window, the columns of a filter group."""
        at = 0
        for g, width in enumerate(WIDTHS):
            yield g, width, [slice(at + j * self.n_filters, at + (j + 1) * self.n_filters) for j in range(width)]
            at += width * self.n_filters

    def project(self, ids: np.ndarray) -> np.ndarray:
        """Contribution of each word (rows of PARTS ids) to each filter column."""
        return self.embed[ids].sum(axis=1) @ self.filters

    def pooled(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max over the places of a text (words x columns), and where it is (-1: the text
        is too short)."""
        top = np.zeros(len(WIDTHS) * self.n_filters, np.float32)
        where = np.full(len(top), -1)
        for g, width, cols in self.slots():
            n = len(z) - width + 1
            if n > 0:
                pre = z[:n, cols[0]].T
                for j in range(1, width):
                    pre = pre + z[j:j + n, cols[j]].T
                own = slice(g * self.n_filters, (g + 1) * self.n_filters)
                where[own] = pre.argmax(axis=1)
                top[own] = np.maximum(pre.max(axis=1) + self.bias[own], 0)
        return top, where

    def start(self, seen: np.ndarray, n: np.ndarray, prior: float = 10.0) -> TextCNN:
        """The first embedding column becomes the smoothed log odds of each bucket between
        toxic and other texts (``seen``: texts by class and bucket, ``n``: by class), seen
        by one filter of each width; all the rest starts at random."""
        p = n[1] / n.sum()
        odds = np.log((seen[1] + prior * p) / (n[1] + prior * p)) - np.log((seen[0] + prior * (1 - p)) / (n[0] + prior * (1 - p)))
        odds[0] = 0
        self.embed[:, 0] = np.clip(odds, -3, 6) / 4
        for _g, _w, cols in self.slots():
            for c in cols:
                self.filters[0, c.start] = 1.0
        return self

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.out_bias]


class Trainer:
    """Trains a network with Adagrad, some texts a step; ``moved`` counts the steps that
    moved each bucket's embedding, and ``steps`` the texts."""

    def __init__(self, net: TextCNN, weight: np.ndarray, epochs: int, rate: float = 0.05, size: int = 8, seed: int = 5):
        self.net, self.weight, self.epochs, self.rate, self.size = net, weight, epochs, rate, size
        self.rng, self.grads = np.random.default_rng(seed), [np.full_like(x, 1e-4) for x in net.arrays()]
        self.moved, self.steps = np.zeros(BUCKETS, np.float32), 0

    def learn(self, texts: list[np.ndarray], parts: np.ndarray, labels: np.ndarray) -> None:
        """``texts``: word numbers; ``parts``: the ids of each word number."""
        for _ in range(self.epochs):
            order = self.rng.permutation(len(texts))
            for s in range(0, len(order), self.size):
                some = order[s:s + self.size]
                self._step([texts[i] for i in some], parts, labels[some])
        self.steps += len(texts)

    def _step(self, texts: list[np.ndarray], parts: np.ndarray, labels: np.ndarray) -> None:
        net, flat = self.net, np.concatenate(texts)
        kinds, inverse = np.unique(flat, return_inverse=True)
        ids = parts[kinds]
        vectors = sum(net.embed.take(ids[:, j], axis=0) for j in range(PARTS))
        z, at = (vectors @ net.filters)[inverse], np.cumsum([0, *map(len, texts)])
        read = [net.pooled(z[at[i]:at[i + 1]]) for i in range(len(texts))]
        top, where = np.stack([t for t, _ in read]), np.stack([w for _, w in read])
        odds = np.clip(top @ net.out + net.out_bias, -30, 30)
        err = ((1 / (1 + np.exp(-odds)) - labels) * self.weight[labels]).astype(np.float32)
        d_top = np.where((top > 0) & (where >= 0), err[:, None] * net.out, 0).astype(np.float32)
        row, k = np.nonzero(d_top)
        word, column, move = [], [], []
        for g, width, cols in net.slots():
            own = k // net.n_filters == g
            for j in range(width):
                word.append(inverse[at[row[own]] + where[row[own], k[own]] + j])
                column.append(cols[j].start + k[own] % net.n_filters)
                move.append(d_top[row[own], k[own]])
        used, place = np.unique(np.concatenate(word), return_inverse=True)
        dz = np.zeros((len(used), net.filters.shape[1]), np.float32)
        np.add.at(dz, (place, np.concatenate(column)), np.concatenate(move))
        if len(used):
            d_words = dz @ net.filters.T
            buckets, place = np.unique(ids[used], return_inverse=True)
            d = np.zeros((len(buckets), net.dim), np.float32)
            np.add.at(d, place.ravel(), np.repeat(d_words, PARTS, axis=0))
            buckets, d = buckets[buckets > 0], d[buckets > 0]
            self.grads[0][buckets] += d * d
            net.embed[buckets] -= self.rate * d / np.sqrt(self.grads[0][buckets])
            self.moved[buckets] += 1
        for i, d in ((1, vectors[used].T @ dz), (2, d_top.sum(axis=0)), (3, err @ top), (4, err.sum())):
            self.grads[i] += d * d
            step = (self.rate * d / np.sqrt(self.grads[i])).astype(np.float32)
            if i == 4:
                net.out_bias = np.float32(net.out_bias - step)
            else:
                target = net.arrays()[i]
                target -= step


class Judge:
    """Scores texts with a fitted network. A word's projections and its language
    vector stand in one column of a ``WordTable``, so a text is read once."""

    def __init__(self, net: TextCNN, langs: dict, room: int = 300_000):
        self.net, self.lang = net, LangScorer(langs)
        self.split = net.filters.shape[1]
        self.words = WordTable(self.split + len(self.lang.langs), self._columns, room)

    def _columns(self, words: list[str]) -> np.ndarray:
        projected = self.net.project(np.array([word_ids(w) for w in words])).T
        projected[:, [i for i, w in enumerate(words) if w == GAP]] = -1e6  # no window over a gap can be the greatest
        return np.concatenate([projected, self.lang.vectors(words)]) if self.lang.langs else projected

    def read(self, texts: list[str | None]) -> list[tuple[float, str]]:
        """The raw probability and the language of each text."""
        lap = max(WIDTHS) - 1
        top, totals = np.zeros((len(texts), len(self.net.out)), np.float32), np.zeros((len(texts), len(self.lang.langs)))
        sizes = np.zeros(len(texts), np.int64)
        for flat, starts, owners in units(texts, lap + 1):
            columns = self.words.take(flat)
            for g, width, cols in self.net.slots():
                pre = columns[cols[0]]
                for j in range(1, width):
                    pre = pre[:, :len(flat) - j] + columns[cols[j], j:]
                own = slice(g * self.net.n_filters, (g + 1) * self.net.n_filters)
                best = np.maximum.reduceat(pre, starts, axis=1).T
                np.maximum.at(top, (owners, own), np.maximum(best + self.net.bias[own], 0))
            if self.lang.langs:
                np.add.at(totals, owners, np.add.reduceat(columns[self.split:], starts, axis=1, dtype=np.float64).T)
            np.add.at(sizes, owners, np.diff(starts, append=len(flat)) - lap - 1)
        p = 1 / (1 + np.exp(-np.clip(top @ self.net.out + self.net.out_bias, -30, 30)))
        return [(float(x), self.lang.decide(t)[0] if n and self.lang.langs else UNKNOWN) for x, t, n in zip(p, totals, sizes, strict=True)]


GROUP = "flat binary, sizes binary, parts binary, labels binary"


def word_groups(rows: DataFrame, max_words: int) -> DataFrame:
    """All texts of ``rows`` (text, toxic) as word numbers, with the ids of each number: whole
    texts, a row for each group of them that ends with the text that reaches ``max_words``
    words. Texts without words have no part."""
    def group(numbers: dict[str, int], texts: list[np.ndarray], labels: list[int], known: WordTable) -> pa.RecordBatch:
        names = list(numbers)
        parts = [known.take(names[i:i + 50_000]).T.astype(np.int32) for i in range(0, len(names), 50_000)]
        arrays = [np.concatenate(texts), np.array([len(t) for t in texts], np.int32), np.concatenate(parts), np.array(labels, np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], ["flat", "sizes", "parts", "labels"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, texts, labels, size = {}, [], [], 0
        known = WordTable(PARTS, lambda words: np.array([word_ids(w) for w in words]).T)  # bucket numbers are exact in float32
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = letter_words((text.as_py() or "").lower())
                if words:
                    for w in set(words).difference(numbers):
                        numbers[w] = len(numbers)
                    texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                    labels.append(toxic)
                    size += len(words)
                if size >= max_words:
                    yield group(numbers, texts, labels, known)
                    numbers, texts, labels, size = {}, [], [], 0
        if texts:
            yield group(numbers, texts, labels, known)

    return rows.mapInArrow(read, GROUP)


def _taken(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Each group's texts, the ids of its word numbers, and labels."""
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            flat, sizes, parts, labels = (np.frombuffer(x.as_buffer(), np.int32) for x in row)
            yield np.split(flat, np.cumsum(sizes)[:-1]), parts.reshape(-1, PARTS), labels


def _sum_arrays(rows: DataFrame, names: list[str]) -> list[np.ndarray] | None:
    """The sums of float arrays that tasks send as bytes: first added in up to 16 tasks,
    so that the driver gets no more than that many rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                own = [np.frombuffer(x.as_buffer(), np.float32) for x in row]
                sums = own if sums is None else [a + b for a, b in zip(sums, own, strict=True)]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in sums], names)

    total = None
    for row in rows.repartition(16).mapInArrow(add, rows.schema).toLocalIterator():
        own = [np.frombuffer(row[k], np.float32).astype(np.float64) for k in names]
        total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
    return total


def _as_row(arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x, np.float32).tobytes()], pa.binary()) for x in arrays], names)


def class_counts(groups: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Of all texts: how many by class and bucket, and by class."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros((2, BUCKETS), np.float32), np.zeros(2, np.float32)
        for texts, parts, labels in _taken(batches):
            for t, y in zip(texts, labels, strict=True):
                seen[y, np.unique(parts[np.unique(t)])] += 1
                n[y] += 1
        if n.any():
            yield _as_row([seen, n], ["seen", "n"])

    got = _sum_arrays(groups.mapInArrow(count, "seen binary, n binary"), ["seen", "n"])
    return None if got is None else (got[0].reshape(2, BUCKETS), got[1])


def fit_network(groups: DataFrame, seen: np.ndarray, n: np.ndarray, updates: int = 100_000, epochs: int = 6) -> TextCNN:
    """Every task trains the same network on all its texts; a bucket's embedding moves by the
    mean of the tasks' moves weighted by their steps there, all the rest by texts. The
    classes weigh the same. Each text is learned from ``epochs`` times, or, from many texts,
    as often as makes ``updates`` updates in all, but at least once."""
    passes = int(min(epochs, max(1, updates // n.sum())))
    first = TextCNN().start(seen, n)
    weight, names = n.sum() / (2 * n), ["embed", "moved", "rest", "steps"]
    shared = groups.sparkSession.sparkContext.broadcast(first)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = copy.deepcopy(shared.value)
        trainer = Trainer(net, weight, passes)
        for group in _taken(batches):
            trainer.learn(*group)
        if trainer.steps:
            moves = [(x - y) for x, y in zip(net.arrays(), shared.value.arrays(), strict=True)]
            rest = np.concatenate([np.ravel(x) for x in moves[1:]]) * trainer.steps
            yield _as_row([moves[0] * trainer.moved[:, None], trainer.moved, rest, np.array([trainer.steps])], names)

    embed, moved, rest, steps = _sum_arrays(groups.mapInArrow(learn, ", ".join(f"{x} binary" for x in names)), names)
    shared.unpersist()
    net = copy.deepcopy(first)
    net.embed += (embed.reshape(BUCKETS, -1) / np.maximum(moved, 1)[:, None]).astype(np.float32)
    rest, at = (rest / steps).astype(np.float32), 0
    for x in net.arrays()[1:4]:
        x += rest[at:at + x.size].reshape(x.shape)
        at += x.size
    net.out_bias = np.float32(net.out_bias + rest[at])
    return net


def fit_toxicity(docs: DataFrame, marks: DataFrame, langs: dict, max_words: int = 2_000_000) -> dict:
    """``docs``: doc_id, text (not null); ``marks``: doc_id, toxic (0 or 1), one row
    per id. All labelled rows count, whole texts: three quarters (by a hash of the id) train
    the network, the others give a threshold per language. A task holds about ``max_words``
    words at once, however many it learns from. Returns the network and the thresholds."""
    # Other bits than ``held_out`` takes.
    apart = F.shiftrightunsigned(F.crc32(F.col("doc_id").cast("string").cast("binary")), 2) % 4 == 3
    n_marks = marks.limit(DEFAULT_BROADCAST_ROWS + 1).count()
    rows = docs.select("doc_id", "text").join(broadcast_if_small(marks, known_rows=n_marks), "doc_id")
    if n_marks > DEFAULT_BROADCAST_ROWS:
        rows = stash(rows)  # texts are shuffled once, not at each pass
    groups = stash(word_groups(rows.where(~apart).select("text", "toxic"), max_words))
    got = class_counts(groups)
    if got is None or not got[1].all():
        return {"net": None, "langs": langs, "cuts": {}}
    net = fit_network(groups, *got)
    shared = docs.sparkSession.sparkContext.broadcast((net, langs))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Judge(*shared.value, room=100_000), Counter()
        for batch in batches:
            read = reader.read(batch.column(0).to_pylist())
            seen.update((lang, round(p * STEPS), y) for (p, lang), y in zip(read, batch.column(1).to_pylist(), strict=True))
        columns = zip(*((*k, c) for k, c in seen.items()), strict=True) if seen else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                                         ["lang", "step", "toxic", "n"])

    # At most two rows for each language and step.
    held = rows.where(apart).select("text", "toxic").mapInArrow(judge, "lang string, step int, toxic int, n long").groupBy(
        "lang", "step", "toxic").agg(F.sum("n").alias("n")).collect()
    shared.unpersist()
    every = _best_cut([(r["step"] / STEPS, r["toxic"], r["n"]) for r in held], 0.5)
    cuts = {lang: _best_cut([(r["step"] / STEPS, r["toxic"], r["n"]) for r in held if r["lang"] == lang], every) for lang in {r["lang"] for r in held}}
    return {"net": net, "langs": langs, "cuts": cuts, "cut": every}


def _best_cut(scored: list[tuple[float, int, int]], default: float, least: int = 10) -> float:
    """The threshold of best F1 over (score, class, rows), in the middle of its gap; the
    default where either class has fewer than ``least`` rows."""
    if min(sum(w for _, y, w in scored if y), sum(w for _, y, w in scored if not y)) < least:
        return default
    scored = sorted(scored, reverse=True)
    need, hit, wrong, best, cut = sum(w for _, y, w in scored if y), 0.0, 0.0, -1.0, default
    for i, (p, y, w) in enumerate(scored):
        hit, wrong = hit + w * (y == 1), wrong + w * (y == 0)
        f1 = 2 * hit / (hit + wrong + need)
        if f1 > best and (i + 1 == len(scored) or scored[i + 1][0] < p):
            best, cut = f1, (p + scored[i + 1][0]) / 2 if i + 1 < len(scored) else p
    return float(min(0.99, max(0.01, cut)))


class Verdict:
    """Calibrated scores of texts under a fitted model; 0 where nothing was learned."""

    def __init__(self, model: dict):
        self.cuts, self.cut = model["cuts"], model.get("cut", 0.5)
        self.judge = Judge(model["net"], model["langs"]) if model["net"] else None

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.judge is None:
            return np.zeros(len(texts))
        read = self.judge.read(texts)
        p, cut = np.array([x for x, _ in read]), np.array([self.cuts.get(lang, self.cut) for _, lang in read])
        return np.where(p < cut, THRESHOLD * p / cut, THRESHOLD + (1 - THRESHOLD) * (p - cut) / (1 - cut))


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id`` and ``score`` per row; at or above ``THRESHOLD``: toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = Verdict(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(verdict.scores(batch.column(1).to_pylist()))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, score double")


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 4, **fit) -> dict:
    """Fits on the labelled rows outside the held-out fold."""
    train = docs.where(~held_out(F.col("doc_id"), folds))
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    langs = fit_lang_model(train.select("doc_id", "text", "lang"))
    model = fit_toxicity(train.select("doc_id", "text").where(F.col("text").isNotNull()), marks, langs, **fit)
    _give_back()
    return model


def _give_back() -> None:
    """Return the driver's memory of the fit to the system, for the stages that follow."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4) -> DataFrame:
    scored = score_toxicity(docs, toxicity_model(docs, labels, folds))
    return scored.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id"), folds).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored toxic. Whole rows pass through the scoring
    task, so repeated ids and extra columns do no harm."""
    shared, at = docs.sparkSession.sparkContext.broadcast(toxicity_model(docs, labels)), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdict = Verdict(shared.value)
        for batch in batches:
            yield batch.filter(pa.array(verdict.scores(batch.column(at).to_pylist()) < THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
