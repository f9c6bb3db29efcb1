"""Operator 13 against a brute-force audit, document by document and order by order."""

from collections import defaultdict
from itertools import permutations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hirescope.llm import audit
from hirescope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute_audit(docs, labels):
    """docs: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    least = {}
    for i, _, text in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, bad = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    marked = []
    for i, source, text in docs:
        text = text or ""
        w = text.encode().split()
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
                 "D": any(c in "#$%&*|" for c in text), "E": i is not None and i > least[text]}
        marked.append((source or "", {f for f in fails if fails[f]}, i is not None and i in good, i is not None and i in bad))
    out, removed_by = defaultdict(lambda: [0] * 7), defaultdict(int)
    for part in {m[0] for m in marked}:
        own = [m for m in marked if m[0] == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                row, before = out[part, "".join(order), step], set(order[:step - 1])
                for _, fails, is_good, is_bad in own:
                    gone = f in fails and not fails & before
                    row[0] += not fails & (before | {f})
                    row[1] += gone
                    row[2] += f in fails and bool(fails & before)
                    row[3] += fails == {f}
                    row[4] += gone and is_good
                    row[5] += gone and is_bad
                removed_by[part, f] += row[1]
    for (part, order, step), row in out.items():
        row[6] = removed_by[part, order[step - 1]]
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert rows_of(QUERIES["op13_filter_audit"][0](spark, SF)) == brute_audit(docs, labels)


@pytest.mark.parametrize("shard_words", [3, 1 << 18])
def test_edges(spark, monkeypatch, shard_words):
    monkeypatch.setattr(audit, "SHARD_WORDS", shard_words)  # one shard for every text or two
    long_text = "word ÄÖ " * 30000
    docs = [(1, "a", None), (2, "a", ""), (2, "a", ""), (3, None, "X y"), (4, "b", "X y"), (None, "b", "X y"), (None, None, None),
            (5, "a", long_text), (6, "hot", long_text), (7, "a", " ".join(f"w{i}" for i in range(300)) + " |"), (8, "", "ÀÉ ab " * 100)]
    labels = [(1, 1, 0), (1, 0, 1), (4, None, 1), (5, 1, None), (None, 1, 1), (9, 1, 1)]
    given = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, source string, text string, n long, mask int")
    marks = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, part string")
    assert rows_of(audit.filter_audit(given, marks)) == brute_audit(docs, labels)


def test_empty_tables(spark):
    given = spark.createDataFrame([], "doc_id long, source string, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(given, marks).count() == 0
    one = spark.createDataFrame([(1, "a", "b")], "doc_id long, source string, text string")
    assert audit.filter_audit(one, marks).count() == 600


def test_matrix_holds_every_count(spark):
    """The shards' cells, in global numbers, are the counts of the words."""
    docs = [(i, "s", " ".join(f"w{j % (i + 1)}" for j in range(20))) for i in range(12)]
    matrix, dictionary = audit.term_matrix(spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(3))
    word = {r.word_id: r.word for r in dictionary.collect()}
    assert len(word) == len(set(word.values())) == 12
    got = {}
    for r in matrix.collect():
        for k, doc in enumerate(r.doc_id):
            got[doc] = {word[r.columns[r.indices[c]]]: r.counts[c] for c in range(r.indptr[k], r.indptr[k + 1])}
    assert got == {i: {w: t.split().count(w) for w in t.split()} for i, _, t in docs}


def test_words_with_one_number_get_others(spark, tmp_path):
    """A seed under which two words collide is given up (the hash is coarsened for it)."""
    given = spark.createDataFrame([(1, "s", "a b c d e f"), (2, "s", "a x")], "doc_id long, source string, text string")
    real = audit.shards

    def coarse(docs, seed):
        made = real(docs, seed)
        return made.withColumn("new_ids", F.transform("new_ids", lambda x: F.when(F.lit(seed) == 0, x % 2).otherwise(x)))

    audit.shards = coarse
    try:
        matrix, dictionary = audit.term_matrix(given)
    finally:
        audit.shards = real
    assert dictionary.count() == 7 and {x for r in matrix.collect() for x in r.columns} == {r.word_id for r in dictionary.collect()}


def test_a_row_group_holds_few_shards(spark, monkeypatch):
    """Spark's reader holds a whole row group (up to 4,096 rows), and a shard is a row of megabytes."""
    monkeypatch.setattr(audit, "SHARD_WORDS", 3)
    rows = [(i, "s", f"one two three {i}") for i in range(300)]
    matrix, dictionary = audit.term_matrix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(2))
    files = {f.removeprefix("file:") for f in matrix.inputFiles()}
    groups = [pq.ParquetFile("/" + f.lstrip("/")).metadata for f in files]
    assert sum(m.num_rows for m in groups) == 300 and dictionary.count() == 303
    assert max(m.row_group(i).num_rows for m in groups for i in range(m.num_row_groups)) <= 4


def test_texts_are_split_in_pieces_of_bounded_size(monkeypatch):
    monkeypatch.setattr(audit, "PIECE_OCTETS", 10)
    texts = ["aaaa", "", "bbbb", "cc", "d" * 40, "", "eeeeeeeee", "ff"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(range(8)), pa.array(range(8)), pa.array(texts)], ["a", "b", "c", "text"])
    given = [batch.slice(0, 5), batch.slice(5, 3), batch.slice(0, 0)]
    got = [p.column(3).to_pylist() for p in audit._pieces(iter(given))]
    assert sum(got, []) == texts and all(len("".join(p)) <= 10 or len(p) == 1 for p in got) and len(got) == 4
