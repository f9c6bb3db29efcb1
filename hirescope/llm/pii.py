"""Operator 3, personal data by candidate gradient boosting.

Strict patterns with validators give the base spans. High-recall generators
propose further spans (obfuscated addresses, every run of digits with common
separators), which may overlap the base ones. Boosted trees judge each candidate
by its format and context; calibrated thresholds, one per kind, select spans,
which are added where they do not overlap a base span.

The trees learn from the corpus itself: a candidate is a positive of a kind if it
passes that kind's validator (Luhn sum, octet range, country prefix, full domain).
For addresses, how the at sign and the dots are written is left out of the features,
and only candidates in plain notation, which the validator can judge, are learned
from; so equal format in equal context carries over to spellings the strict rule
misses. (The features of numbers hold much of what their validators see.) All features are
bits, so all candidates of the corpus collapse into counts per bit pattern (at
most 2^14 of them); only these counts reach the driver, where trees are fitted,
and what comes back to the rows is the set of selected patterns.

Everything on the rows is DataFrame expressions without a shuffle; Java's regular
expressions are written with possessive quantifiers, so that they take linear
time and no deep recursion on very long runs. No match crosses a line break.

Defined results: a null text counts as empty (no spans); rows keep their number,
also with repeated or null ids; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import stash

KINDS = ("email", "ip", "card", "phone")

# Strict patterns: leftmost non-overlapping matches, as the contract defines them.
# A match can only begin where a run of its first class begins, or where the match
# before it ended (\G); the look-behind says so and keeps the search linear.
_LOCAL = "[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IP_RANGE = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?+(?:@|\(at\)|\[at\]) ?+[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+",
    "number": r"(?<![0-9])\(?+[0-9](?:[\x20().-]{0,2}+[0-9])++",
}
TRIGGER = {"email": r"@|[(\[]at[)\]]", "number": "[0-9]"}


def running_sum(a: Column) -> Column:
    """Sums of the elements before each one. Two levels, so that the work grows
    with the length and not with its square."""
    start = F.struct(F.lit(0).alias("t"), F.array().cast("array<int>").alias("out"))
    sums = lambda x: F.aggregate(x, start, lambda s, v: F.struct(
        (s["t"] + v).alias("t"), F.concat(s["out"], F.array(s["t"])).alias("out")))["out"]
    step = 256
    chunks = F.transform(F.sequence(F.lit(0), ((F.size(a) - 1) / step).cast("int")), lambda c: F.slice(a, c * step + 1, F.lit(step)))
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda s, v: s + v))
    return F.when(F.size(a) == 0, F.array().cast("array<int>")).otherwise(
        F.flatten(F.zip_with(chunks, sums(totals), lambda c, o: F.transform(sums(c), lambda x: x + o))))


def matches(df: DataFrame, out: str, pattern: str, trigger: Column) -> DataFrame:
    """Adds column ``out``: start, end (code points, end exclusive), text, and up to
    24 characters before and 2 after, of each match in ``text``."""
    found = F.when(trigger, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    between = F.when(trigger, F.split("text", pattern, -1)).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("_m", found).withColumn("_b", F.when(F.size("_m") > 0, between).otherwise(F.array().cast("array<string>")))
    sizes = F.zip_with(F.slice("_b", F.lit(1), F.size("_m")), F.col("_m"), lambda b, m: F.length(b) + F.length(m))
    df = df.withColumn("_sizes", sizes).withColumn("_at", running_sum(F.col("_sizes")))
    zipped = F.arrays_zip(F.col("_m").alias("m"), F.slice("_b", F.lit(1), F.size("_m")).alias("b"),
                          F.slice("_b", F.lit(2), F.size("_m")).alias("a"), F.col("_at").alias("at"))
    spans = F.transform(zipped, lambda z: F.struct(
        (z["at"] + F.length(z["b"])).alias("s"), (z["at"] + F.length(z["b"]) + F.length(z["m"])).alias("e"), z["m"].alias("m"),
        F.right(z["b"], F.lit(24)).alias("before"), F.left(z["a"], F.lit(2)).alias("after")))
    return df.withColumn(out, spans).drop("_m", "_b", "_sizes", "_at")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """13 to 19 digits whose Luhn sum ends in 0."""
    rev = F.reverse(_digits(m))
    value = lambda i: F.substr(rev, i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 1, value(i)).when(value(i) > 4, 2 * value(i) - 9).otherwise(2 * value(i))
    total = F.aggregate(F.sequence(F.lit(1), F.length(rev)), F.lit(0), lambda s, i: s + part(i))
    return F.when(F.length(rev).between(13, 19), total % 10 == 0).otherwise(F.lit(False))


VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(IP_RANGE),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def _valid(kind: str) -> Callable[[Column], Column]:
    return lambda x: VALID[kind](x["m"])


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


def _bits(conditions: list[Column]) -> Column:
    """The conditions as a number, first one lowest."""
    total = F.lit(0)
    for i, c in enumerate(conditions):
        total = total + F.when(c, F.lit(1 << i)).otherwise(F.lit(0))
    return total


def _number_bits(c: Column) -> Column:
    m, n, before = c["m"], F.length(_digits(c["m"])), F.lower(c["before"])
    return _bits([
        F.contains(m, F.lit("(")), F.contains(m, F.lit(".")), F.contains(m, F.lit("-")), F.contains(m, F.lit(" ")),
        n < 10, n.between(10, 11), n.between(12, 15), n == 16, m.rlike("[0-9]{3}[- .][0-9]{4}$"),
        m.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), before.rlike("(?:call|tel|phone|fax|mobil)[^0-9]*$"),
        before.rlike("[a-z0-9_=\"'/]$"), c["after"].rlike("^[A-Za-z0-9_@/\"']"), before.rlike(r"[.,;:-]\s?\+?$")])


def _email_bits(c: Column) -> Column:
    # How the at sign and the dots are written is what the validator looks at: no feature.
    m, before = c["m"], F.lower(c["before"])
    return _bits([
        m.rlike(r"(?:\.|dot[)\]]) ?[A-Za-z]{2,10}$"), m.rlike(r"^[^@ (\[]*[0-9]"), m.rlike(r"^[._%+-]"), m.rlike(r"^[A-Za-z0-9]{1,2}[^A-Za-z0-9]"),
        c["after"].rlike("^[A-Za-z0-9_@/]"), before.rlike("[@/]$"), before.rlike("(?:mail|contact|write|reach|ask)[^a-z]*(?:to|at|us)?[^a-z]*$"),
        F.length(m) > 60])


N_BITS = {"number": 14, "email": 8}


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, a validated span array per kind, and the candidates with feature
    bits and the kinds whose validator they pass."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    df = df.withColumn("_email", F.col("text").rlike(TRIGGER["email"])).withColumn("_number", F.col("text").rlike(TRIGGER["number"]))
    for kind in KINDS:
        df = matches(df, kind, STRICT[kind], F.col("_email") if kind == "email" else F.col("_number"))
        df = df.withColumn(kind, _plain(F.filter(kind, _valid(kind))))
    df = matches(matches(df, "c_email", LOOSE["email"], F.col("_email")), "c_number", LOOSE["number"], F.col("_number"))
    numbers = F.filter("c_number", lambda c: F.length(_digits(c["m"])).between(7, 19))
    df = df.withColumn("c_number", F.transform(numbers, lambda c: F.struct(
        c["s"].alias("s"), c["e"].alias("e"), _number_bits(c).alias("code"), F.lit(1).alias("judged"),
        c["m"].rlike(IP_RANGE).cast("int").alias("ip"), (_luhn(c["m"]) & c["m"].rlike(r"^[0-9](?:[\x20-]?[0-9]){12,18}$")).cast("int").alias("card"),
        (c["before"].rlike(r"\+$") & F.length(_digits(c["m"])).between(9, 15)).cast("int").alias("phone"))))
    df = df.withColumn("c_email", F.transform("c_email", lambda c: F.struct(
        c["s"].alias("s"), c["e"].alias("e"), _email_bits(c).alias("code"), (~c["m"].rlike(r"[ (\[]")).cast("int").alias("judged"),
        c["m"].rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$").cast("int").alias("email"))))
    return df.select("doc_id", *KINDS, "c_email", "c_number")


def boost(counts: list[tuple[int, int, int]], bits: int, rounds: int = 40, rate: float = 0.3, depth: int = 3, ridge: float = 5.0) -> dict[int, float]:
    """Gradient boosting with logistic loss over (pattern, rows, positives); returns
    the probability of each pattern. Trees split on bits, greedily, by Newton gain."""
    codes = np.array([c for c, _, _ in counts])
    x = (codes[:, None] >> np.arange(bits)) & 1
    n, y = np.array([c for _, c, _ in counts], float), np.array([c for _, _, c in counts], float)
    prior = (y.sum() + 0.5) / (n.sum() + 1.0)
    f = np.full(len(codes), math.log(prior / (1 - prior)))

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> None:
        gt, ht = g[rows].sum(), h[rows].sum()
        if level:
            g1, h1 = g[rows] @ x[rows], h[rows] @ x[rows]
            gain = g1 ** 2 / (h1 + ridge) + (gt - g1) ** 2 / (ht - h1 + ridge) - gt ** 2 / (ht + ridge)
            best = int(gain.argmax())
            if gain[best] > 1e-6:
                grow(rows[x[rows, best] == 1], g, h, level - 1)
                grow(rows[x[rows, best] == 0], g, h, level - 1)
                return
        f[rows] += rate * gt / (ht + ridge)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        grow(np.arange(len(codes)), y - n * p, n * p * (1 - p), depth)
    return dict(zip(codes.tolist(), (1 / (1 + np.exp(-f))).tolist(), strict=True))


def calibrate(counts: list[tuple[int, int, int]], prob: dict[int, float], precision: float, least: int) -> float:
    """The lowest threshold at and above which candidates keep ``precision`` (with
    one false positive added for caution) and number ``least`` positives; above 1 if none does."""
    cut, n, y = 1.01, 0, 0
    rows = sorted(counts, key=lambda c: -prob[c[0]])
    for i, (code, rows_n, pos) in enumerate(rows):
        n, y = n + rows_n, y + pos
        last = i + 1 == len(rows) or prob[rows[i + 1][0]] < prob[code]
        if last and y >= least and y / (n + 1) >= precision:
            cut = prob[code]
    return cut


def fit_selector(scanned: DataFrame, precision: float = 0.95, least: int = 20) -> dict[str, list[int]]:
    """For each kind, the feature patterns whose candidates are redacted."""
    chosen: dict[str, list[int]] = {}
    for column, kinds in (("c_email", ("email",)), ("c_number", ("ip", "card", "phone"))):
        sums = [F.sum(f"c.{k}").alias(k) for k in kinds]
        table = scanned.select(F.explode(column).alias("c")).groupBy("c.code").agg(F.sum("c.judged").alias("n"), *sums).where("n > 0").collect()
        taken: dict[int, tuple[float, str]] = {}
        for kind in kinds:
            counts = sorted((r["code"], r["n"], r[kind]) for r in table)
            if counts:
                prob = boost(counts, N_BITS[column[2:]])
                cut = calibrate(counts, prob, precision, least)
                # A pattern also has to be that precise by itself, not only with better ones.
                own = {c: y / (n + 1) for c, n, y in counts}
                for code, p in prob.items():
                    if p >= cut and own[code] >= precision - 0.1 and p > taken.get(code, (0.0, ""))[0]:
                        taken[code] = (p, kind)
        for kind in kinds:
            chosen[kind] = sorted(c for c, (_, k) in taken.items() if k == kind)
    return chosen


def _apart(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``."""
    return F.filter(spans, lambda c: ~F.exists(others, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))


def _written(kind: str, spans: Column) -> Column:
    return F.transform(F.sort_array(spans), lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def find_pii(docs: DataFrame, **calibration) -> DataFrame:
    """Span arrays per kind: ``base_<kind>`` and, with the method's additions, ``<kind>``."""
    scanned = stash(scan(docs))
    chosen = fit_selector(scanned, **calibration)
    df = scanned.withColumn("base", F.concat(*KINDS))
    for kind in KINDS:
        column = "c_email" if kind == "email" else "c_number"
        codes = chosen[kind] or [-1]
        picked = _plain(F.filter(column, lambda c: c["code"].isin(codes)))  # noqa: B023
        df = df.withColumn(f"add_{kind}", _apart(picked, F.col("base"))).withColumn("base", F.concat("base", f"add_{kind}"))
    return df.select("doc_id", *[F.col(k).alias(f"base_{k}") for k in KINDS], *[F.concat(k, f"add_{k}").alias(k) for k in KINDS])


def redact(text: Column, spans: dict[str, Column]) -> Column:
    """``text`` with every span replaced by its kind in brackets (spans apart)."""
    named = lambda k, v: F.transform(v, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(k).alias("k")))
    marks = F.sort_array(F.concat(*[named(k, v) for k, v in spans.items()]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(marks, start, lambda a, x: F.struct(
        x["e"].alias("at"), F.concat(a["out"], F.substr(text, a["at"] + 1, x["s"] - a["at"]), F.lit("["), x["k"], F.lit("]")).alias("out")))
    return F.concat(done["out"], F.substr(text, done["at"] + 1))


def pii_digest(docs: DataFrame, **calibration) -> DataFrame:
    found = find_pii(docs, **calibration)
    base = F.array_join(F.concat(*[_written(k, F.col(f"base_{k}")) for k in KINDS]), ",")
    return found.select("doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(base, 256).alias("base_sha256"),
                        F.array_join(F.concat(*[_written(k, F.col(k)) for k in KINDS]), ",").alias("spans"))
