"""Operator 2, language identification by word-first backoff: a known word scores
by its log frequency in each language; an unseen word falls back to its
character n-grams, at each place the longest one known.

Learning counts words and n-grams in Spark over a bounded sample of labelled
rows (``docs_per_lang`` per language, drawn by a hash of the id). The model holds
the ``vocab`` most frequent words and n-grams of each order per language, so its
size is bounded by parameters and the number of languages, and it is broadcast.
Prediction is one pass over Arrow batches without a shuffle; whole texts count.

Defined results: a null text or one without a letter gives ``und`` with score 0;
so does every text when there is nothing to learn from; equal best scores go to
the alphabetically first language; rows keep their number, also with repeated or
null ids; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.llm.common import held_out

ALPHANUMERIC = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
UNKNOWN = "und"


def letter_words(text: str) -> list[str]:
    """The maximal runs of letters. The pattern also takes numerals (fractions, Roman
    figures), which are rare: words that hold one are cut there."""
    words = ALPHANUMERIC.findall(text)
    if all(map(str.isalpha, words)):
        return words
    return ["".join(run) for w in words for letters, run in groupby(w, str.isalpha) if letters]


def ngrams(word: str, n: int) -> list[str]:
    padded = f"_{word}_"
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words.setdefault(lang, Counter()).update(letter_words(text.lower()))
        rows = []
        for lang, counts in words.items():
            grams = {n: Counter() for n in ORDERS}
            for w, c in counts.items():
                for n in ORDERS:
                    for g in ngrams(w, n):
                        grams[n][g] += c
            rows += [(lang, 0, w, c) for w, c in counts.items()]
            rows += [(lang, n, g, c) for n in ORDERS for g, c in grams[n].items()]
        if rows:
            lang, kind, gram, n = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(kind, pa.int32()), pa.array(gram), pa.array(n, pa.int64())],
                                             ["lang", "kind", "gram", "n"])


def fit_lang_model(labelled: DataFrame, docs_per_lang: int = 2000, vocab: int = 10_000, seed: int = 17) -> dict:
    """``labelled``: doc_id, text, lang. Returns the languages and, by kind (0: word,
    else the n-gram's order), a dictionary from gram to a row of log frequencies."""
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_rows"))
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(broadcast_if_small(sizes), "lang").where(u * F.col("_rows") < docs_per_lang).select("lang", "text")
    counts = sample.mapInArrow(_count_batches, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(
        F.sum("n").alias("n"))
    by = Window.partitionBy("lang", "kind")
    top = (counts.withColumn("total", F.sum("n").over(by))
           .withColumn("rank", F.row_number().over(by.orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= vocab))
    got = top.select("lang", "kind", "gram", "n", "total").toArrow().to_pydict()
    langs = sorted(set(got["lang"]))
    at = {x: i for i, x in enumerate(langs)}
    totals = np.ones((5, len(langs)))
    seen: list[dict[str, np.ndarray]] = [{} for _ in range(5)]
    for lang, kind, gram, n, total in zip(*(got[k] for k in ("lang", "kind", "gram", "n", "total")), strict=True):
        totals[kind, at[lang]] = total
        seen[kind].setdefault(gram, np.zeros(len(langs)))[at[lang]] = n
    tables = []
    for kind, table in enumerate(seen):
        weight = 1.0 if kind == 0 else 1.0 / kind
        keys = list(table)
        rate = np.log((np.array([table[k] for k in keys]).reshape(len(keys), len(langs)) + 0.5) / (totals[kind] + 0.5 * vocab))
        tables.append((keys, (weight * rate).astype(np.float32)))
    return {"langs": langs, "tables": tables}


GAP = ""           # stands between texts; no word is empty
UNIT = 4_000       # words handled at once: their arrays stay in a core's cache


def units(texts: list[str | None], gap: int = 1) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """The words of many texts in a row, ``gap`` gap marks after each text, as units
    of about ``UNIT`` words; where a text starts in the unit, and its number. Longer
    texts come in pieces that share ``gap - 1`` words, so that no window is lost."""
    flat, starts, owners = [], [], []
    for i, text in enumerate(texts):
        words = letter_words(text.lower()) if text else []
        for s in range(0, max(1, len(words)), UNIT):
            starts.append(len(flat))
            owners.append(i)
            flat += words[s:s + UNIT + gap - 1]
            flat += [GAP] * gap
            if len(flat) >= UNIT:
                yield flat, np.array(starts), np.array(owners)
                flat, starts, owners = [], [], []
    if starts:
        yield flat, np.array(starts), np.array(owners)


class WordTable:
    """Vectors of words, computed once per distinct word and kept for reuse in a table
    of ``room`` columns at most, which starts anew when it is full."""

    def __init__(self, width: int, vectors: Callable[[list[str]], np.ndarray], room: int = 300_000):
        self.vectors, self.memo, self.table = vectors, {}, np.zeros((width, room), np.float32)

    def take(self, words: list[str]) -> np.ndarray:
        """A column per word; far fewer words than ``room``."""
        memo = self.memo
        new = list(set(words).difference(memo))
        if len(memo) + len(new) > self.table.shape[1]:
            memo.clear()
            new = list(set(words))
        if new:
            first = len(memo)
            self.table[:, first:first + len(new)] = self.vectors(new)
            memo.update(zip(new, range(first, first + len(new)), strict=True))
        return self.table.take(np.fromiter(map(memo.__getitem__, words), np.int64, len(words)), axis=1)


class LangScorer:
    """Scores words and texts with a model."""

    def __init__(self, model: dict):
        self.langs = model["langs"]
        (words, vectors), *grams = model["tables"]
        # Rows of all vectors, a row of zeros first; words and n-grams map to rows.
        self.rows = np.concatenate([np.zeros((1, len(self.langs)), np.float32), vectors, *[v for _, v in grams]])
        self.words = {w: i for i, w in enumerate(words, 1)}
        self.grams = {g: i for i, g in enumerate((g for keys, _ in grams for g in keys), len(words) + 1)}
        self.seen = WordTable(len(self.langs), self.vectors) if self.langs else None

    def _backoff(self, word: str) -> list[int]:
        """Rows of the longest n-gram known at each place of the word."""
        padded, get, out = f"_{word}_", self.grams.get, [0]
        for i in range(len(padded)):
            for n in ORDERS:
                row = get(padded[i:i + n]) if i + n <= len(padded) else None
                if row is not None:
                    out.append(row)
                    break
        return out

    def vectors(self, words: list[str]) -> np.ndarray:
        """Log-frequency vectors, a column per word."""
        rows = [[self.words[w]] if w in self.words else self._backoff(w) if w else [0] for w in words]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((r for own in rows for r in own), np.int64, int(sizes.sum()))
        return np.add.reduceat(self.rows[flat], np.cumsum(sizes) - sizes, axis=0).T

    def decide(self, total: np.ndarray) -> tuple[str, float]:
        best = int(total.argmax())
        return self.langs[best], float(1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum())

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        totals, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for flat, starts, owners in units(texts):
            np.add.at(totals, owners, np.add.reduceat(self.seen.take(flat), starts, axis=1, dtype=np.float64).T)
            np.add.at(sizes, owners, np.diff(starts, append=len(flat)) - 1)
        return [self.decide(t) if n else (UNKNOWN, 0.0) for t, n in zip(totals, sizes, strict=True)]


def identify_language(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (posterior of the prediction) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = LangScorer(shared.value)
        for batch in batches:
            got = scorer.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in got], pa.string()),
                                              pa.array([s for _, s in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, folds: int = 4, **fit) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts all rows."""
    model = fit_lang_model(docs.where(~held_out(F.col("doc_id"), folds)).select("doc_id", "text", "lang"), **fit)
    return identify_language(docs, model).select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "lang_pred", "score")
