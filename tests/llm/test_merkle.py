"""Operator 12 against a plain Merkle tree in Python, its edits, and its edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from hirescope.llm import merkle
from hirescope.llm.common import stash
from hirescope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_pieces(text):
    return re.findall(merkle.PIECE, text)


def brute_fingerprint(text):
    leaves = [hashlib.md5(p.encode()).hexdigest() for p in brute_pieces(text)]
    sections, own = [], []
    for i, leaf in enumerate(leaves):
        own.append(leaf)
        if leaf[0] in "01" or i + 1 == len(leaves):
            sections.append(own)
            own = []
    digests = [hashlib.md5("".join(s).encode()).hexdigest() for s in sections]
    root = hashlib.sha256("".join(digests).encode()).hexdigest()[:32]
    return root + ":" + ";".join(d[:16] + "=" + "".join(x[:8] for x in s) for d, s in zip(digests, sections, strict=True))


def brute_likeness(a, b):
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    x, y = ({leaf for s in f.split(":")[1].split(";") if s for leaf in re.findall(".{8}", s.split("=")[1])} for f in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def brute_digest(docs):
    """docs: (doc_id, text), ids not null."""
    nexts = {}
    for i, t in docs:
        nexts.setdefault(i, []).append((brute_fingerprint(t or ""), t or ""))
    ids = sorted(nexts)
    out = []
    for i, t in docs:
        t = t or ""
        fp, nt = min(nexts[ids[(ids.index(i) + 1) % len(ids)]])
        cut = len(t) // 4
        edited = t[:len(t) - cut] + nt[:cut]
        own, changed = brute_fingerprint(t), brute_fingerprint(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own, changed,
                    brute_likeness(own, changed), brute_likeness(own, fp)))
    return sorted(out)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_merkle"][0](spark, SF).collect())
    assert got == brute_digest(docs)
    near = sorted(r[5] for r in got if r[1] >= 1000)
    assert near[len(near) // 20] > 0.5 and sum(near) / len(near) > 0.7


@pytest.mark.parametrize("docs", [
    [], [(4, "Only one. Two?")], [(1, None), (2, ""), (3, "a"), (9, "abcdefgh")],
    [(1, "One. Two. Three!\n\nFour"), (1, "Another. Text. Here."), (5, "x" * 1000 + ". y"), (5, "x" * 1000 + ". y")],
    [(-5, "Ünï. cödé 😀😀 end。次の文！" * 40), (2**62, "l. " * 40000), (0, "no marks at all " * 5000)]])
def test_edges(spark, docs):
    given = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, next string, take int")
    assert sorted(tuple(r) for r in merkle.fingerprint_digest(spark, given).collect()) == brute_digest(docs)


def test_null_ids_stand_outside(spark):
    given = spark.createDataFrame([(None, "Abc. Defg. Hij."), (None, None), (3, "Own. Text.")], "doc_id long, text string")
    got = {r.n_chars: r for r in merkle.fingerprint_digest(spark, given).collect()}
    assert len(got) == 3 and got[15].near_next == 0.0 and got[0].near_edited == 1.0
    assert got[15].edited_sha256 == hashlib.sha256(b"Abc. Defg. H").hexdigest()
    assert got[10].near_next == 1.0  # a single id is followed by itself


def test_pieces_lose_nothing(spark):
    texts = ["", "a", "a.b. c\n\n d!?  e" * 9, "é" * 700 + "." + "\t\n" * 3, "。！？\r\n x", "." * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.array_join(merkle.pieces(F.col("t")), "").alias("u"))
    assert all(r.t == r.u for r in df.collect())


def test_changed_pieces_locate_an_edit(spark):
    said = [f"Sentence number {i} says {i * i}. " for i in range(300)]
    old, new = "".join(said), "".join([*said[:120], "Put in here. ", *said[120:200], *said[203:]])
    rows = spark.createDataFrame([(1, old, new)], "doc_id long, old string, new string")
    rows = stash(merkle.with_fingerprint(merkle.with_fingerprint(rows, "old", "fp_old"), "new", "fp_new"))
    added = merkle.changed_pieces(rows, "new", "fp_new", "fp_old").select("place", "piece").collect()
    gone = merkle.changed_pieces(rows, "old", "fp_old", "fp_new").select("place", "piece").orderBy("place").collect()
    assert [tuple(r) for r in added] == [(120, "Put in here. ")]
    assert [tuple(r) for r in gone] == [(i, said[i]) for i in (200, 201, 202)]
    # Most sections are left as they were.
    a, b = (set(r[0].split(":")[1].split(";")) for r in (rows.select("fp_old").first(), rows.select("fp_new").first()))
    assert len(a & b) >= 0.8 * len(a)


def test_next_ids_over_many_ranges(spark):
    ids = [i * i * 7 - 50 for i in range(500)] + [None]
    df = spark.createDataFrame([(i,) for i in ids * 2], "doc_id long").repartition(5)
    got = {r.doc_id: r.next_id for r in merkle.next_ids(df).collect()}
    order = sorted(ids[:-1])
    assert got == dict(zip(order, [*order[1:], order[0]], strict=True))
