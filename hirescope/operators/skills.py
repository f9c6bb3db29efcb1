"""Lexicon, skill extraction and derived skill tables.

Extraction plan: the lexicon becomes a trie, one row for each distinct beginning of a
phrase (``phrase_trie``). Each text is tokenised once; its tokens meet the trie's first
level inside one generated stage, and only where a token begins a phrase a row is made,
with the few tokens that follow. Such a row walks the trie a level at a time, a join on
(node, next token) each, until no edge fits. All levels are broadcast after a check of
their rows and bytes; above the bound the planner joins them by shuffle. The phrases
met are told apart as numbers: the partial aggregate of the final ``distinct`` removes
every repeat within a text before the shuffle, and the phrase's words come back last.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirescope.execution import broadcast_if_small, cut_lineage
from hirescope.functions.text import norm
from hirescope.functions.text import text_tokens as tokenize

LEXICON_BROADCAST_ROWS = 1_000_000  # phrases of at most a few words


def build_lexicon(raw: DataFrame, min_len: int = 1, max_len: int = 3, column: str | None = None) -> DataFrame:
    """A2: distinct normalised phrases with ``min_len..max_len`` words.

    Takes column ``Skill`` if present (exact case), else the first column.
    Returns ``(phrase string, n_words int)``.
    """
    col = column or ("Skill" if "Skill" in raw.columns else raw.columns[0])
    ph = (raw.select(F.col(col).cast("string").alias("raw")).where(F.col("raw").isNotNull())
             .select(norm("raw").alias("phrase")))
    nw = F.size(F.split("phrase", " "))
    return (ph.where(F.col("phrase") != "").select("phrase", nw.alias("n_words"))
              .where((F.col("n_words") >= min_len) & (F.col("n_words") <= max_len))
              .distinct())


def text_tokens(postings: DataFrame, id_col: str = "posting_id", text_col: str = "description") -> DataFrame:
    """(id, toks): missing text counts as ''."""
    return postings.select(F.col(id_col).alias(id_col),
                           tokenize(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("toks"))


@dataclass(frozen=True)
class PhraseTrie:
    """``nodes``: one row per distinct beginning of a phrase, with ``depth``, ``parent``
    (the node of the beginning one word shorter), ``word``, ``node`` and ``phrase`` (the
    whole phrase where one ends, else null)."""
    nodes: DataFrame
    depth: int
    rows: int
    bytes: int

    def small(self, part: DataFrame) -> DataFrame:
        """``part`` of the nodes, broadcast if the whole trie may be."""
        return broadcast_if_small(part, LEXICON_BROADCAST_ROWS, self.rows, self.bytes)


def phrase_trie(lexicon: DataFrame) -> PhraseTrie:
    """The trie of the lexicon's phrases, written once.

    A node is a 64-bit hash of its beginning, under the first seed that gives every
    beginning a node of its own, so that walks are exact."""
    ends = F.size("w")
    begun = cut_lineage(
        lexicon.select("phrase", F.split("phrase", " ").alias("w"))
               .select("phrase", "w", ends.alias("n"), F.explode(F.sequence(F.lit(1), ends)).alias("depth"))
               .select("depth", F.array_join(F.slice("w", F.lit(1), F.col("depth")), " ").alias("begin"),
                       F.when(F.col("depth") == F.col("n"), F.col("phrase")).alias("phrase"))
               .groupBy("depth", "begin").agg(F.max("phrase").alias("phrase")))
    for seed in count():
        node = lambda text: F.xxhash64(F.lit(seed), text)  # noqa: B023, E731
        seen = begun.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(node(F.col("begin"))).alias("nodes"),
                         F.max("depth").alias("depth"), F.sum(F.octet_length("begin")).alias("octets")).first()
        if seen["nodes"] == seen["rows"]:
            break
    word, before = F.substring_index("begin", " ", -1), F.regexp_replace("begin", " ?[^ ]*$", "")
    nodes = begun.select("depth", node(before).alias("parent"), word.alias("word"), node(F.col("begin")).alias("node"), "phrase")
    # A word and a phrase are no longer than the beginning; 64 for the rest of a row.
    return PhraseTrie(nodes, seen["depth"] or 0, seen["rows"], 2 * (seen["octets"] or 0) + 64 * seen["rows"])


def extract_skills(postings: DataFrame, lexicon: DataFrame | PhraseTrie, id_col: str = "posting_id",
                   text_col: str = "description") -> DataFrame:
    """Distinct (id, skill) for every lexicon phrase found in a text.

    Overlapping and nested matches all count; rows sharing an id get the union
    of their skills (C2 semantics). The lexicon may be given as a trie already built.
    """
    trie = lexicon if isinstance(lexicon, PhraseTrie) else phrase_trie(lexicon)
    if not trie.depth:
        return postings.select(id_col, F.lit("").alias("skill")).limit(0)

    def level(k: int) -> DataFrame:
        return trie.small(trie.nodes.where(F.col("depth") == k).select(
            F.col("parent").alias(f"__parent{k}"), F.col("word").alias(f"__word{k}"), F.col("node").alias(f"__node{k}"),
            F.col("phrase").isNotNull().alias(f"__ends{k}")))

    at = text_tokens(postings.select(id_col, text_col), id_col, text_col).select(id_col, "toks", F.posexplode("toks").alias("__at", "__word"))
    walk = at.join(level(1), F.col("__word") == F.col("__word1")).select(
        id_col, "__node1", "__ends1", F.slice("toks", F.col("__at") + 2, F.lit(max(trie.depth - 1, 1))).alias("__rest"))
    for k in range(2, trie.depth + 1):
        fits = (F.col(f"__node{k - 1}") == F.col(f"__parent{k}")) & (F.get("__rest", F.lit(k - 2)) == F.col(f"__word{k}"))
        walk = walk.join(level(k), fits, "left").drop(f"__parent{k}", f"__word{k}")
    met = F.array(*[F.when(F.col(f"__ends{k}"), F.col(f"__node{k}")) for k in range(1, trie.depth + 1)])
    found = walk.select(id_col, F.explode(F.array_compact(met)).alias("node")).distinct()
    phrases = trie.small(trie.nodes.where("phrase IS NOT NULL").select("node", F.col("phrase").alias("skill")))
    return found.join(phrases, "node").select(id_col, "skill")


def skill_flags(postings: DataFrame, skills: DataFrame, id_col: str = "posting_id") -> DataFrame:
    """Postings with a sorted ``skills`` array (empty when none), joined on id.

    A skill list per posting is bounded by the lexicon, so ``collect_set`` per
    posting is safe; nothing is collected per skill.
    """
    per = skills.groupBy(id_col).agg(F.array_sort(F.collect_set("skill")).alias("skills"))
    return (postings.join(per, id_col, "left")
                    .withColumn("skills", F.coalesce("skills", F.array().cast("array<string>"))))


def distinct_descriptions(postings: DataFrame, id_col: str = "posting_id", text_col: str = "description") -> DataFrame:
    """One row per distinct text (missing = ''), keeping the smallest id.

    Texts are told apart by a 256-bit digest, so whole texts are not sort keys; the
    text of the smallest id comes with it."""
    rows = postings.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text_col))
    first = rows.groupBy(F.unhex(F.sha2(text_col, 256)).alias("__digest")).agg(
        F.min_by(F.struct(id_col, text_col), F.col(id_col)).alias("r"))
    return first.select(f"r.{id_col}", f"r.{text_col}")


def skill_doc_freq(skills: DataFrame, min_df: int = 1) -> DataFrame:
    """Number of texts per skill, kept when >= ``min_df``."""
    return (skills.groupBy("skill").agg(F.count(F.lit(1)).alias("doc_freq"))
                  .where(F.col("doc_freq") >= min_df))


def skill_postings(skills: DataFrame, id_col: str = "posting_id") -> DataFrame:
    """The inverted index skill -> postings, kept in long form (skill, id).

    A single skill can cover a third of all postings, so we never collect a
    skill's postings into one row.
    """
    return skills.select("skill", id_col).distinct()


def skill_wide(postings: DataFrame, skills: DataFrame, id_col: str = "posting_id",
               names: list[str] | None = None) -> DataFrame:
    """One 0/1 int column ``skill_<name>`` per skill (export form), 0 by default.

    The caller may name the skills to show; otherwise every matched skill becomes a
    column (they are bounded by the lexicon). The long table stays the data model.
    """
    if names is None:
        names = [r[0] for r in skills.select("skill").distinct().orderBy("skill").collect()]
    clash = {f"skill_{n}".lower() for n in names} & {c.lower() for c in postings.columns}
    if clash:
        raise ValueError(f"export columns clash with posting columns: {sorted(clash)}")
    held = skills.where(F.col("skill").isin(names)).groupBy(id_col).agg(F.collect_set("skill").alias("__held"))
    out = postings.join(held, id_col, "left")
    flag = lambda n: F.coalesce(F.array_contains("__held", F.lit(n)), F.lit(False)).cast("int")
    return out.select(*postings.columns, *[flag(n).alias(f"skill_{n}") for n in names])


def skill_matrix(postings: DataFrame, lexicon_raw: DataFrame, company: str | None = None,
                 title: str | None = None, max_phrase_len: int = 3, min_skill_df: int = 10,
                 id_col: str = "posting_id") -> tuple[DataFrame, DataFrame]:
    """Binary skill matrix of the distinct texts, in long form.

    Steps: B8 (company equality), B9 (title contains, case-insensitive literal),
    D11 (distinct texts), A2 + J32 (phrases of 1..max_phrase_len words), D10
    (keep skills in >= min_skill_df texts), F8 (sorted vocabulary -> index).
    Returns ``(matrix(id, skill, col), vocabulary(col, skill))``.
    """
    df = postings
    if company:
        df = df.where(F.col("company_name") == F.lit(company))
    if title:
        df = df.where(F.coalesce(F.contains(F.lower(F.col("title")), F.lower(F.lit(title))), F.lit(False)))
    docs = distinct_descriptions(df, id_col)
    lex = build_lexicon(lexicon_raw, 1, max_phrase_len)
    found = extract_skills(docs, lex, id_col)
    keep = skill_doc_freq(found, min_skill_df).select("skill")
    # The vocabulary is bounded by the lexicon, so one ordered window over it is fine.
    vocab = keep.select("skill", (F.row_number().over(Window.orderBy("skill")) - 1).alias("col"))
    matrix = found.join(broadcast_if_small(vocab, LEXICON_BROADCAST_ROWS), "skill").select(id_col, "skill", "col")
    return matrix, vocab.select("col", "skill")
