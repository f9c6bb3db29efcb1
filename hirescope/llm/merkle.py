"""Operator 12, document fingerprints: a Merkle tree over paragraphs and sections.

A text is cut, without loss, into paragraph pieces: sentences, ended by sentence marks
or line ends, of at most 240 code points. A section is a stretch of pieces that ends
behind a piece whose digest says so (one in eight), so an inserted or deleted piece
moves no later border. A leaf is the md5 of its piece, a section the md5 of its leaves,
the root the sha256 of the sections. The fingerprint writes the tree down: 32 hex digits
of the root, then for each section 16 of its digest and 8 of each leaf.

Equal roots mean equal texts. Otherwise sections that both trees hold are alike whole,
and only the differing branches are followed to their leaves: ``likeness`` is the share
of distinct leaves in both (Dice), ``changed_pieces`` the leaves of one tree that the
other lacks, by section and place.

The document after another one is found without a global sort in one task: ids are
dealt by range, ordered within a range, and only the ends of the ranges meet. Texts are
shuffled once, by id; what a document needs of the next one (its first characters and
its fingerprint) goes to it by id.

Defined results: null text counts as empty (its tree has no sections); the next document
is that of the least greater id, of rows that share that id the one with the least
fingerprint; the last id is followed by the first, a single id by itself; a row without
id stands outside the order: nothing replaces what its edit removes, and ``near_next`` is
0; two empty texts are alike (1), an empty one and another are not (0); rows keep their
number; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirescope.execution import broadcast_if_small
from hirescope.llm.common import stash

# A sentence with its marks and the space behind them, else 240 code points of one.
PIECE = r"[^.!?。！？\n]{0,240}+[.!?。！？\n]+[ \t\r]*+|[^.!?。！？\n]{1,240}"
SECTION_ENDS_BELOW = "2"  # of 16 leading digits, 0 and 1
ROOT_DIGITS, SECTION_DIGITS, LEAF_DIGITS = 32, 16, 8


def pieces(text: Column) -> Column:
    """The paragraph pieces of a non-null text; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(PIECE), 0)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of its non-null column ``text``."""
    leaves, ends = f"__{out}_leaves", f"__{out}_ends"
    keep = df.columns
    cut = df.select(*keep, F.transform(pieces(F.col(text)), lambda p: F.md5(p.cast("binary"))).alias(leaves))
    count = F.size(leaves)
    closes = lambda i: (F.get(leaves, i - 1) < SECTION_ENDS_BELOW) | (i == count)
    placed = cut.select(*keep, leaves, F.when(count == 0, F.array().cast("array<int>")).otherwise(
        F.filter(F.sequence(F.lit(1), count), closes)).alias(ends))
    since = lambda k: F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
    digests = F.transform(ends, lambda end, k: F.slice(leaves, since(k) + 1, end - since(k)))
    told = placed.select(*keep, F.when(F.size(ends) == 0, F.array().cast("array<array<string>>")).otherwise(digests).alias(leaves))
    section = lambda s: F.concat(
        F.substring(F.md5(F.array_join(s, "").cast("binary")), 1, SECTION_DIGITS), F.lit("="),
        F.array_join(F.transform(s, lambda x: F.substring(x, 1, LEAF_DIGITS)), ""))
    whole = F.transform(leaves, lambda s: F.md5(F.array_join(s, "").cast("binary")))
    root = F.substring(F.sha2(F.array_join(whole, "").cast("binary"), 256), 1, ROOT_DIGITS)
    return told.select(*keep, F.concat_ws(":", root, F.array_join(F.transform(leaves, section), ";")).alias(out))


def root_of(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def sections_of(fingerprint: Column) -> Column:
    """The sections as written: digest, '=', leaves."""
    return F.filter(F.split(F.substring_index(fingerprint, ":", -1), ";"), lambda s: s != "")


def _leaves(sections: Column) -> Column:
    """The distinct leaves of sections as written."""
    each = F.transform(sections, lambda s: F.regexp_extract_all(F.substring_index(s, "=", -1), F.lit("[0-9a-f]{8}"), 0))
    return F.array_distinct(F.flatten(each))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``df`` with the likeness (0 to 1) of its fingerprints ``a`` and ``b``; a null one is like none.

    Equal roots decide alone. Sections that are in both are alike with all their
    leaves; the leaves of the other branches are compared."""
    keep, sa, sb, both = df.columns, f"__{out}_a", f"__{out}_b", f"__{out}_both"
    differ = root_of(F.col(a)) != root_of(F.col(b))
    some = lambda c: F.when(differ, sections_of(F.col(c))).otherwise(F.array().cast("array<string>"))
    split = df.select(*keep, some(a).alias(sa), some(b).alias(sb))
    split = split.select(*keep, sa, sb, F.array_intersect(sa, sb).alias(both))
    counted = split.select(*keep, _leaves(F.col(both)).alias(both), _leaves(F.array_except(sa, both)).alias(sa),
                           _leaves(F.array_except(sb, both)).alias(sb))
    # Leaves of one branch may also be in a shared section: sets of distinct leaves count.
    mine, other = F.array_union(both, sa), F.array_union(both, sb)
    shared = F.size(both) + F.size(F.array_except(F.array_intersect(mine, other), both))
    dice = 2 * shared / F.greatest(F.size(mine) + F.size(other), F.lit(1))
    return counted.select(*keep, F.when(F.col(a).isNull() | F.col(b).isNull(), 0.0).when(differ, dice).otherwise(1.0).alias(out))


def changed_pieces(df: DataFrame, text: str, fingerprint: str, other: str) -> DataFrame:
    """Where ``text`` (with its ``fingerprint``) differs from the text behind fingerprint
    ``other``: (columns of ``df``, section, place, piece), from branches that ``other`` lacks.
    ``place`` counts the pieces of the text from 0. ``df`` is read from a table that holds
    the fingerprints; made in the same plan, the optimiser would repeat their making."""
    keep = df.columns
    mine, theirs = sections_of(F.col(fingerprint)), sections_of(F.col(other))
    # Equal roots: nothing to follow.
    follow = F.when(root_of(F.col(fingerprint)) != root_of(F.col(other)), mine)
    lacks = df.select(*keep, pieces(F.col(text)).alias("__pieces"), theirs.alias("__theirs"), F.posexplode(follow).alias("section", "__branch"))
    size = lambda s: F.floor(F.length(F.substring_index(s, "=", -1)) / LEAF_DIGITS)
    before = F.aggregate(F.slice(mine, 1, F.col("section")), F.lit(0).cast("long"), lambda acc, s: acc + size(s))
    branches = (lacks.where(~F.array_contains("__theirs", F.col("__branch")))
                     .select(*keep, "__pieces", "section", before.alias("__before"), _leaves(F.col("__theirs")).alias("__known"),
                             F.regexp_extract_all(F.substring_index("__branch", "=", -1), F.lit("[0-9a-f]{8}"), 0).alias("__own")))
    rows = branches.select(*keep, "__pieces", "section", "__before", "__known", F.posexplode("__own").alias("__at", "__leaf"))
    place = F.col("__before") + F.col("__at")
    return (rows.where(~F.array_contains("__known", F.col("__leaf")))
                .select(*keep, "section", place.alias("place"), F.get("__pieces", place.cast("int")).alias("piece")))


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of every distinct non-null id; the last is followed by the first.

    A range's last id is followed by the first of the next range that has any; ranges
    are a shuffle's partitions, so their ends are few."""
    spark = ids.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = ids.where("doc_id IS NOT NULL").distinct()
    # Written once: an id's range cannot change between its uses.
    dealt = stash(distinct.repartitionByRange(ranges, "doc_id").select("doc_id", F.spark_partition_id().alias("range")))
    within = dealt.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("range").orderBy("doc_id")))
    heads = dealt.groupBy("range").agg(F.min("doc_id").alias("least"))
    # At most one row a range.
    ordered = F.array_sort(F.collect_list("least"))
    starts = heads.agg(ordered.alias("s")).select(F.explode(F.arrays_zip(
        F.col("s").alias("least"), F.concat(F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))), F.slice("s", 1, 1)).alias("follower"))).alias("x"))
    ends = heads.join(broadcast_if_small(starts.select("x.least", "x.follower"), known_rows=ranges), "least").select("range", "follower")
    return (within.join(broadcast_if_small(ends, known_rows=ranges), "range")
                  .select("doc_id", F.coalesce("next_id", "follower").alias("next_id")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every row of ``docs`` (doc_id, text)."""
    return with_fingerprint(docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")), "text", "fingerprint")


def fingerprint_digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns: every text, and its edit, whose last quarter is replaced by
    the beginning of the next document's text."""
    # A cast that does nothing would leave an alias, and the two readings of ``named`` would differ.
    key = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long")
    rows = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    named = rows.where("doc_id IS NOT NULL")
    sizes = named.groupBy("doc_id").agg(F.max(F.floor(F.length("text") / 4)).alias("take"))
    links = next_ids(named.select("doc_id")).join(sizes, "doc_id").select(F.col("doc_id").alias("to"), "take", F.col("next_id").alias("doc_id"))
    # Both joins deal ``named`` by id, so its texts are shuffled once.
    given = with_fingerprint(named.join(links, "doc_id"), "text", "next_fingerprint").select(
        F.col("to").alias("doc_id"), F.struct("next_fingerprint", F.left("text", F.col("take").cast("int")).alias("head")).alias("next"))
    after = given.groupBy("doc_id").agg(F.min("next").alias("next"))
    alone = F.lit(None).cast("struct<next_fingerprint:string,head:string>").alias("next")
    told = named.join(after, "doc_id").select("doc_id", "text", "next").unionByName(
        rows.where("doc_id IS NULL").select("doc_id", "text", alone))
    n, cut = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.left("text", n - cut), F.left(F.coalesce("next.head", F.lit("")), cut))
    pair = told.select(
        "doc_id", "text", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("next.next_fingerprint").alias("next_fingerprint"))
    both = with_fingerprint(with_fingerprint(pair, "text", "fingerprint"), "edited", "edited_fingerprint")
    out = both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", "next_fingerprint")
    near = with_likeness(with_likeness(out, "fingerprint", "edited_fingerprint", "near_edited"), "fingerprint", "next_fingerprint", "near_next")
    return near.drop("next_fingerprint")
