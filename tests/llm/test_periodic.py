"""Operator 11 against brute force over every period, and its edge cases."""

import hashlib
import random
import zlib

import pytest

from hirescope.llm import periodic
from hirescope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_exponent=4, min_length=6):
    """Every maximal stretch of equal words q apart, for every q; the least q of a stretch."""
    n, best = len(words), {}
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_exponent * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute_digest(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = brute_runs(words)
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    head = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(words, runs)).hexdigest())


def test_find_runs_against_brute_force(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK_PLACES", 50)  # candidates come in many parts
    rng = random.Random(7)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 10)):
            n, kinds = rng.choice([0, 1, 3, 8, 30, 80, 200]), rng.choice([1, 2, 2, 3, 20])
            words = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
            if n > 20 and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 9)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        for exponent, least in ((4, 6), (2, 2), (3, 10)):
            for words, (runs, collapsed) in zip(texts, periodic._runs_of_block(texts, exponent, least), strict=True):
                got = [(r["start"], r["length"], r["period"]) for r in runs]
                want = sorted(brute_runs(words, exponent, least), key=lambda r: (r[0], r[2]))
                assert got == want
                assert collapsed == brute_collapsed(words, want)


def test_extensions_match_word_by_word_comparison():
    import numpy as np

    rng = np.random.default_rng(3)
    for kinds in (1, 2, 5):
        body = rng.integers(0, kinds, 400)
        grammar = periodic.Grammar(np.concatenate([[kinds], body, [kinds + 1]]))
        s = grammar.symbols[0]
        i = rng.integers(1, 400, 300)
        j = rng.integers(1, 400, 300)
        i, j = i[i != j], j[i != j]
        for step in (1, -1):
            got = grammar.extend(i, j, step)
            for a, b, k in zip(i, j, got, strict=True):
                assert all(s[a + step * t] == s[b + step * t] for t in range(k)) and s[a + step * k] != s[b + step * k]


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"][0](spark, SF).collect()}
    assert got == {r.doc_id: brute_digest(r.doc_id, r.text) for r in rows}
    assert sum(v[0] for v in got.values()) > 0


@pytest.mark.parametrize("given", [
    [], [(None, "a a a a a a a"), (1, None), (2, ""), (3, " \t\n")],
    [(5, "b " * 9), (5, "b " * 9), (6, "x y z " * 5 + "q " * 7)], [(7, "only\x0bone two two " * 4)],
    [(23, "k " * 30000 + "l m " * 9000), (24, "é " * 6)]])
def test_edges(spark, given):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in given], "doc_id long, text string, runs int, start string")
    got = sorted(periodic.runs_digest(docs).collect(), key=str)
    # Of the long text only the closed form is known: no period but those of its two halves.
    small = [(i, t) for i, t in given if t is None or len(t) < 1000]
    want = sorted(((i, *brute_digest(i, t)) if i is not None else (i, *brute_digest("none", t)) for i, t in small), key=str)
    assert len(got) == len(given)
    assert [tuple(r) for r in got if len(given) == len(small)] == (want if len(given) == len(small) else [])
    if len(given) != len(small):
        assert {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in got}[23] == (2, 0, 30000, 1)
