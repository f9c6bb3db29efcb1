"""Operator 10, quality rules by weak supervision: each rule votes good, bad or
abstains; expectation-maximisation estimates how far each rule can be trusted;
the posterior probability of "good" replaces all-must-pass filtering.

Measures and votes are DataFrame expressions within one row, without a shuffle.
Only the vote patterns (at most 3^rules of them) are counted over all documents
and brought to the driver, where the expectation-maximisation runs on them.

Defined results: a null text has no words; rows keep their number, also with
repeated or null ids; an empty table gives an empty result; columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import SPACE_CHARS, stash, words_of

SYMBOLS = "#*$%&|<>"
GOOD, BAD, ABSTAIN = 1, 0, 2

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def measures(docs: DataFrame) -> DataFrame:
    """The per-document counts: words, characters, symbols, lines, repeats."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id"), text.alias("text"), words_of(text).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    grams = F.when(F.size("words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW),
                    lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WINDOW)])))
    wide = base.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.translate("text", "!?", "")).alias("_no_marks"), F.length("text").alias("_chars"),
        lines.alias("lines"), grams.alias("grams"))
    return wide.select(
        "doc_id", "n_words", "word_chars", "n_symbols", (F.col("_chars") - F.col("_no_marks")).cast("long").alias("n_marks"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("grams")) == F.size("grams"), F.lit(0))
        .otherwise(_covered(F.col("grams"))).cast("long").alias("n_repeat_words"))


def _covered(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more. Windows are sorted by
    hash; equal neighbours mark their positions; overlapping windows count once."""
    ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(ranked, F.slice(ranked, F.lit(2), F.size(grams)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    equal = F.filter(pairs, lambda p: F.coalesce(p["a"]["h"] == p["b"]["h"], F.lit(False)))
    starts = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))))
    first = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    return F.aggregate(starts, first, lambda s, i: F.struct(
        (i + WINDOW).alias("to"), (s["n"] + i + WINDOW - F.greatest(s["to"], i)).alias("n")))["n"]


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(BAD)).when(good, F.lit(GOOD)).otherwise(F.lit(ABSTAIN))


def votes() -> dict[str, Column]:
    """One three-valued vote per rule, from the measures."""
    n, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    words = F.greatest(n, F.lit(1))
    return {
        "length": _vote(n >= 20, n < MIN_WORDS),
        "word_length": _vote((F.col("word_chars") >= 3 * n) & (F.col("word_chars") <= 9 * n) & (n > 0),
                             (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n) | (n == 0)),
        "symbols": _vote(F.col("n_symbols") * 50 <= chars, F.col("n_symbols") * 12 > chars),
        "marks": _vote(F.col("n_marks") * 20 <= words, F.col("n_marks") * 2 > words),
        "dup_lines": F.when(F.col("n_lines") < 2, F.lit(ABSTAIN)).otherwise(
            _vote(F.col("n_dup_lines") * 10 <= F.col("n_lines"), F.col("n_dup_lines") * 3 > F.col("n_lines"))),
        "repeats": F.when(n < WINDOW, F.lit(ABSTAIN)).otherwise(
            _vote(F.col("n_repeat_words") * 20 <= n, F.col("n_repeat_words") * 100 > MAX_REPEAT_PERCENT * n)),
    }


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50,
                    ceiling: float = 0.995) -> dict[tuple[int, ...], float]:
    """Expectation-maximisation over weighted vote patterns. Each rule has one
    accuracy for good and one for bad documents. A rule may overlook most bad
    documents (each kind of junk trips few rules), but it is held to vote "bad"
    at least twice as often on bad ones as on good ones. Returns P(good) of each
    pattern."""
    if not patterns:
        return {}
    rules = len(patterns[0][0])
    right, prior = [[0.97, 0.4] for _ in range(rules)], 0.85  # [good, bad]

    def posterior(p: tuple[int, ...]) -> float:
        g, b = math.log(prior), math.log(1 - prior)
        for v, (rg, rb) in zip(p, right, strict=True):
            if v != ABSTAIN:
                g += math.log(rg if v == GOOD else 1 - rg)
                b += math.log(1 - rb if v == GOOD else rb)
        return 1 / (1 + math.exp(min(700.0, b - g)))

    for _ in range(rounds):
        soft = [(p, n, posterior(p)) for p, n in patterns]
        total = sum(n for _, n, _ in soft)
        prior = min(0.99, max(0.5, sum(n * q for _, n, q in soft) / total))
        for j in range(rules):
            for k, (vote, weight) in enumerate(((GOOD, lambda q: q), (BAD, lambda q: 1 - q))):
                seen = 1.0 + sum(n * weight(q) for p, n, q in soft if p[j] != ABSTAIN)
                hit = 0.9 * (1 - k / 2) + sum(n * weight(q) for p, n, q in soft if p[j] == vote)
                right[j][k] = min(ceiling, hit / seen)
            right[j][0] = max(0.6, right[j][0])
            right[j][1] = max(2 * (1 - right[j][0]), right[j][1])
    return {p: posterior(p) for p, _ in patterns}


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Measures, the contract's base verdict, ``p_good`` and ``kept`` per row."""
    spark = docs.sparkSession
    rules = votes()
    voted = stash(measures(docs).select("*", F.concat(*[v.cast("string") for v in rules.values()]).alias("votes")))
    # At most 3^rules patterns, whatever the input.
    counted = [(tuple(int(x) for x in r["votes"]), r["n"]) for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()]
    fitted = fit_label_model(sorted(counted))
    posterior = spark.createDataFrame([("".join(map(str, p)), q) for p, q in fitted.items()], "votes string, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.join(F.broadcast(posterior), "votes", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("p_good") >= threshold)).alias("kept"), "p_good")
