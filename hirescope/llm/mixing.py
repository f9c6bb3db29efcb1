"""Operator 9, mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; each cell's token count is
raked until its sums by source, by language and by topic meet the targets, and
every document of a cell is then drawn with the cell's calibrated expectation ``p``:
the raked share over the actual share, scaled so that the expected number of tokens
is ``rate`` of the input's. Where a cell needs more tokens than it has, p exceeds 1:
a document is taken floor(p) times, and once more with the probability that is left.
So shares and rate are both held, whatever the targets.

Targets are the actual shares raised to ``power`` and normalised (tempered sampling),
so that small sources, languages and topics gain; others can be passed. The topic is
read off the text by simple rules (``topic_of``). Documents are reduced to cells in
one grouped sum; raking runs on the cell table with window sums, the
lineage cut after each sweep; cells are joined back to the documents. Whether a document
is drawn depends on a hash of its id, so a rerun draws the same ones.

Defined results: null source, language or text are categories of their own (shown
as ""), a null text has no tokens; a document without tokens is drawn with its
cell's probability (0 for a cell without tokens); rows that repeat an id are drawn
alike if their cells are equal; a null id hashes as ""; an empty table gives an
empty result; other columns are ignored by ``mix`` and kept by ``sample_mixture``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.llm.common import fresh, stash

AXES = ("source", "lang", "topic")
SWEEPS = 12
SWEEPS_PER_CUT = 1


def topic_of(text: Column) -> Column:
    """A coarse topic: the first rule that holds."""
    return (F.when(text.contains("Licensed under"), "license").when(text.contains(" | "), "table")
            .when(text.contains("@"), "contact").when(text.rlike("[0-9]"), "figures").otherwise("prose"))


def token_count(text: Column) -> Column:
    """Words: runs of characters other than spaces, tabs and line ends."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\r\n]+"), lambda w: w != "")).cast("long")


def cells_of(docs: DataFrame, topic: Callable[[Column], Column] = topic_of) -> DataFrame:
    """``doc_id``, the three axes and ``tokens`` of every row."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("lang", F.lit("")).alias("lang"),
                       topic(F.coalesce("text", F.lit(""))).alias("topic"), token_count(F.col("text")).alias("tokens"))


def tempered(cells: DataFrame, axis: str, power: float) -> DataFrame:
    """Target share of each category of ``axis``."""
    sums = cells.groupBy(axis).agg(F.sum("tokens").alias("t")).where("t > 0")
    raised = sums.select(axis, F.pow(F.col("t").cast("double"), power).alias("p"))
    total = raised.agg(F.coalesce(F.sum("p"), F.lit(1.0))).first()[0]
    return raised.select(axis, (F.col("p") / F.lit(float(total))).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (the axes and ``tokens``) with ``weight``, raked to the targets."""
    fitted = cells.where("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    for axis, target in targets.items():
        fitted = fitted.join(broadcast_if_small(target.withColumnRenamed("target", f"to_{axis}")), axis)
    fitted = stash(fitted)
    for sweep in range(sweeps):
        for axis in targets:
            fitted = fitted.withColumn("weight", F.col("weight") * F.col(f"to_{axis}") / F.sum("weight").over(Window.partitionBy(axis)))
        if sweep % SWEEPS_PER_CUT == SWEEPS_PER_CUT - 1:
            fitted = stash(fitted)
    return fitted.select(*AXES, "tokens", "weight")


def cell_probabilities(rows: DataFrame, rate: float, power: float, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The axes and ``p``, how often a cell's documents are expected to be drawn."""
    cells = stash(rows.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")))
    raked = stash(rake(cells, targets or {a: tempered(cells, a, power) for a in AXES}))
    total, weight = raked.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).first()
    return raked.select(*AXES, (F.lit(rate * float(total) / weight) * F.col("weight") / F.col("tokens")).alias("p"))


def _drawn(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from the id: 52 bits of an md5 digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _copies(doc_id: Column, p: Column, seed: int) -> Column:
    """How often a document with expectation ``p`` is taken."""
    return (F.floor(p) + (_drawn(doc_id, seed) < p - F.floor(p)).cast("long")).cast("long")


def mix(docs: DataFrame, rate: float = 0.5, power: float = 0.6, seed: int = 9, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every row's axes, ``tokens``, ``p``, its ``copies`` in the sample, and whether it is ``sampled`` at all."""
    rows = cells_of(docs)
    cell = broadcast_if_small(cell_probabilities(rows, rate, power, targets))
    p = F.coalesce("p", F.lit(0.0))
    copies = _copies(F.col("doc_id"), p, seed)
    return rows.join(cell, list(AXES), "left").select("doc_id", *AXES, "tokens", p.alias("p"), copies.alias("copies"), (copies > 0).alias("sampled"))


def sample_mixture(docs: DataFrame, rate: float = 0.5, power: float = 0.6, seed: int = 9) -> DataFrame:
    """The rows of ``docs`` that are drawn, as often as they are, with all their columns."""
    p = cell_probabilities(cells_of(docs), rate, power)
    names = {a: fresh(docs, f"cell_{a}") for a in (*AXES, "p")}
    marked = docs.withColumns({names["source"]: F.coalesce("source", F.lit("")), names["lang"]: F.coalesce("lang", F.lit("")),
                               names["topic"]: topic_of(F.coalesce("text", F.lit("")))})
    joined = marked.join(broadcast_if_small(p.select(*[F.col(a).alias(names[a]) for a in (*AXES, "p")])), [names[a] for a in AXES])
    times = F.array_repeat(F.lit(0), _copies(F.col("doc_id"), F.col(names["p"]), seed).cast("int"))
    return joined.select(*docs.columns, F.explode(times).alias(fresh(docs, "copy"))).select(*docs.columns)


def oracle_sql(rate: float = 0.5, power: float = 0.6, seed: int = 9, sweeps: int = SWEEPS) -> str:
    """DuckDB SQL for the rows of ``mix``."""
    steps, last = [], "w0"
    for i in range(sweeps):
        for axis in AXES:
            name = f"w{i}_{axis}"
            steps.append(f"{name} AS MATERIALIZED (SELECT c.* REPLACE (c.weight * t.target / sum(c.weight) OVER (PARTITION BY c.{axis}) AS weight) "
                         f"FROM {last} c JOIN t_{axis} t USING ({axis}))")
            last = name
    targets = ",\n".join(
        f"t_{a} AS MATERIALIZED (SELECT {a}, p / sum(p) OVER () AS target FROM (SELECT {a}, pow(sum(tokens)::DOUBLE, {power}) AS p FROM w0 GROUP BY {a}))" for a in AXES)
    return rf"""
WITH given AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(coalesce(text, ''), 'Licensed under') THEN 'license' WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
              WHEN contains(coalesce(text, ''), '@') THEN 'contact' WHEN regexp_matches(coalesce(text, ''), '[0-9]') THEN 'figures' ELSE 'prose' END AS topic,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\r\n]+'), lambda w: w <> ''))::BIGINT AS tokens
  FROM documents),
w0 AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE AS weight FROM given GROUP BY ALL HAVING sum(tokens) > 0),
{targets},
{", ".join(steps)},
cell AS (SELECT source, lang, topic, {rate} * sum(tokens) OVER () * weight / sum(weight) OVER () / tokens AS p FROM {last}),
drawn AS (
  SELECT given.*, coalesce(p, 0.0) AS p,
         ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / {1 << 52}.0 AS u
  FROM given LEFT JOIN cell USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, p, floor(p)::BIGINT + (u < p - floor(p))::BIGINT AS copies,
       floor(p)::BIGINT + (u < p - floor(p))::BIGINT > 0 AS sampled
FROM drawn
"""
