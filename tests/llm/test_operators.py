"""Each operator against a brute-force version, an exact round trip, or held-out rows."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
import xxhash

from hirescope.llm import chat, decontaminate, langid, lines, lm, mixing, pii, quality, simhash, toxicity
from hirescope.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\|im_end|>", "a<", "\\", "<|im_start|>user\n<|im_end|>\n", "", None, "line\n\n", "<<\\\\/s>", "%0A%25"]
    given = [(i, 0, "user", t) for i, t in enumerate(nasty)] + [(i, 1, "assistant", t) for i, t in enumerate(nasty)]
    given += [(100, 0, "assistant", "x"), (101, 0, "user\nrole", "y"), (101, 1, None, "z"), (102, 1, "user", "b"), (102, 1, "user", "a")]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.chat_digest(df).collect()}
    by = {}
    for c, t, role, text in given:
        by.setdefault(c, []).append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].valid == (c < 100)


def test_template_rejects_ambiguous_controls():
    with pytest.raises(ValueError):
        chat.ChatTemplate(controls=("<|im_start|>", "<|im_end|>", "<<SYS>>"))


def test_language_held_out(docs):
    got = langid.language_id(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert len(got) == docs.count() and (held.lang == held.lang_pred).mean() > 0.95
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()


def test_pii_base_against_regex(spark, rows):
    made = ["a@b.com_x@c.org and x@y", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255", "4111 1111 1111 1111, 4111111111111112 0 0", "+1 (930) 555-2361 +12 +1 2",
            "é 😀 me@ex-am.ple.com +49 30 1234567 10.0.0.1", "@@@ a@b 1234", "", None, "a" * 30000 + "@x.de", "1 " * 8000, "+1" + " " * 5000, "7" * 40000]
    given = rows + [(10_000 + i, t) for i, t in enumerate(made)]
    got = {r.doc_id: r for r in pii.pii_digest(spark.createDataFrame(given, "doc_id long, text string")).collect()}

    def luhn(m):
        d = [int(x) for x in m if x.isdigit()][::-1]
        return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0

    rules = {
        "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", luhn),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(x.isdigit() for x in m) <= 15),
    }
    for i, text in given:
        if text and len(text) > 20000 and "@" in text:  # quadratic for Python's own search
            spans = {"email": [(0, 30005)], "ip": [], "card": [], "phone": []}
        else:
            spans = {k: [m.span() for m in re.finditer(p, text or "") if (len(m[0]) < 4000 or k == "email") and ok(m[0])] for k, (p, ok) in rules.items()}
        base = ",".join(f"{k}:{s}:{e}" for k in rules for s, e in spans[k])
        r = got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in rules), i
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_pii_learns_formats_and_redacts(spark):
    told = [(i, f"call me on +1 ({200 + i}) 555-{1000 + i} today") for i in range(80)] + [(100 + i, f"total of {10 ** 9 + i} items") for i in range(80)]
    loose = [(500, "call me on 1 (777) 555-4321 today"), (501, "total of 1000000123 items")]
    found = pii.find_pii(spark.createDataFrame(told + loose, "doc_id long, text string")).cache()
    got = {r.doc_id: r for r in found.collect()}
    assert len(got[500].phone) == 1 and not got[500].base_phone and not got[501].phone
    text = spark.createDataFrame([(3, "call me on +1 (203) 555-1003 today")], "doc_id long, text string").join(found, "doc_id")
    assert text.select(pii.redact(text["text"], {k: text[k] for k in pii.KINDS})).first()[0] == "call me on [phone] today"


def test_running_sum(spark):
    a = list(range(1000))
    df = spark.createDataFrame([(a,), ([],)], "a array<int>")
    assert [r[0] for r in df.select(pii.running_sum(df["a"])).collect()] == [list(itertools.accumulate([0, *a[:-1]])), []]


def test_toxicity_held_out(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = table(spark, big, "documents"), table(spark, big, "labels")
    got = toxicity.toxicity(docs, labels).toPandas()
    marked = got.merge(labels.toPandas(), on="doc_id")
    held = marked[marked.held_out]
    pos, neg = held[held.toxic == 1].score, held[held.toxic == 0].score
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert sum((p > neg).mean() for p in pos) / len(pos) > 0.85
    assert (neg >= toxicity.THRESHOLD).mean() < 0.1 and (got.predicted == (got.score >= 0.3)).all()


def test_units_are_small_and_lose_no_window():
    from hirescope.llm.langid import GAP, units
    words = [chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) for i in range(15_000)]
    got = list(units([" ".join(words), None, "x y"], gap=3))
    assert max(len(flat) for flat, _, _ in got) < 10_000
    windows = {tuple(flat[i:i + 3]) for flat, _, _ in got for i in range(len(flat) - 2) if GAP not in flat[i:i + 3]}
    assert windows == {tuple(words[i:i + 3]) for i in range(len(words) - 2)}
    assert sorted(o for _, _, owners in got for o in set(owners.tolist()) if o) == [1, 2]


def test_lm_counts_against_brute_force(docs, rows):
    got = lm.lm_scores(docs, head=500).toPandas().set_index("doc_id")
    tokens = {i: [*(t or "").encode().lower().split(), lm.END] for i, t in rows}
    train = Counter(x for i, ts in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for x in ts)
    n, v = sum(train.values()), len(train)
    for i, ts in tokens.items():
        r = got.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ts), sum(x in train for x in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[x] + 1) / (n + v + 1)) for x in ts), rel=1e-9)
        assert -12 * len(ts) * 8 < r.score < 0
    assert (got.score / got.n_tokens).mean() > -6
    other = lm.lm_scores(docs, head=20).toPandas().set_index("doc_id")
    assert (abs(other.score - got.score) < 1e-3).all()


def test_lm_model_is_a_distribution():
    import numpy as np
    tokens = [b"ab", b"abc", b"b", lm.END]
    coded = lm.Coded(tokens)
    table = np.zeros((lm.ORDERS, 2, lm.SLOTS), np.float32)
    for token, bits, _, slots in coded.blocks():
        for k in range(lm.ORDERS):
            np.add.at(table[k], (bits, slots[k]), 10)
    model = lm.Model(table, np.full((lm.GATES, lm.ORDERS), 0.3), np.zeros((2, 256 * lm.APM_BUCKETS)))
    singles = [bytes([x]) for x in range(256) if x not in b" "]
    assert 10 ** model.log10p(tokens).max() < 1 and (10 ** model.log10p(singles)).sum() <= 1.0001
    assert model.log10p([b"zzz"])[0] < model.log10p([b"ab"])[0]


def test_lm_classes_are_a_distribution_in_context():
    import numpy as np
    classes = lm.Classes([b"ab", b"cd", lm.END], [5, 3, 2], np.arange(256) % 7)
    learner = lm.ClassLearner(classes)
    for _ in range(20):
        learner.learn([[b"ab", b"cd", b"ab", b"zz", lm.END], [lm.END]])
    assert learner.table[0].sum() == learner.table[3].sum() == 20 * classes.length[[256, 257, 256, ord("z"), 258, 258]].sum()
    model = lm.ClassModel(classes, learner.learned())
    tokens = [*(bytes([x]) + b"~" for x in range(256)), *classes.of]
    after = {}
    for text in ([], [b"ab"], [b"ab", b"cd"]):
        p = 10 ** (model.log10p([[*text, w] for w in tokens]) - (model.log10p([text])[0] if text else 0))
        assert p.sum() == pytest.approx(1, abs=1e-3)
        after[len(text)] = p[tokens.index(b"cd")]
    assert after[1] > 3 * after[2]


def test_lm_reads_across_tokens(spark):
    import random
    rng, names = random.Random(1), ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]

    def chain(n):
        at = rng.randrange(6)
        return [names[(at + 2 * i + i // 3) % 6] for i in range(n)]

    given = [(i, " ".join(chain(60))) for i in range(200)]
    held = [i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 7 == 2][:10]
    texts = [chain(60) for _ in held]
    given += [(i, " ".join(t)) for i, t in zip(held, texts)] + [(i + 7000, " ".join(sorted(t))) for i, t in zip(held, texts)]
    got = {r.doc_id: r for r in lm.lm_scores(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    for i in held:
        assert got[i].base_score == pytest.approx(got[i + 7000].base_score)
        assert got[i].score > 0.7 * got[i + 7000].score and got[i].score > 0.7 * got[i].base_score


def brute_fingerprint(text):
    ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_against_brute_force(spark, rows):
    base = brute_fingerprint(rows[0][1])
    given = rows + [(5000, None), (5001, " \n"), (5002, "One two"), (5003, "one TWO")]
    got = simhash.simhash_digest(spark.createDataFrame(given, "doc_id long, text string")).toPandas().set_index("doc_id")
    fps = {i: brute_fingerprint(t) for i, t in given}
    assert {i: f"{f:016x}" for i, f in fps.items()} == got.fingerprint.to_dict() and base
    root = {i: i for i in fps}
    for _ in fps:
        new = {i: min(root[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2) for i in fps}
        if new == root:
            break
        root = new
    assert got.component_id.to_dict() == root


def test_simhash_links_of_chosen_fingerprints(spark):
    import random
    rng = random.Random(4)
    fps = set()
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for _ in range(rng.choice((1, 2, 3))):
                f ^= 1 << rng.randrange(64)
    fps |= {0, 1, 3, 1 << 63, (1 << 64) - 1}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    from hirescope.llm.components import connected_components
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long")).cache()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in links.collect())
    got = {r.node: r.root for r in connected_components(links).collect()}
    root = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(signed, 2):
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert {x: got.get(x, x) for x in signed} == root


def test_components_of_a_long_chain_and_a_hub(spark):
    from hirescope.llm.components import connected_components
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 201)} == {0} and {got[i] for i in range(1001, 1300)} == {1000} and 5000 not in got


def test_decontamination_small(spark):
    item = " ".join(f"Word{i}" for i in range(30))
    long = " ".join(f"w{i}" for i in range(400))
    part = " ".join(f"word{i}" for i in range(14))
    items = [(1, item), (2, "Two words"), (3, ""), (4, None), (5, long), (None, "no id here at all today")]
    docs = [(1, f"before {item.upper()}! after"), (2, part), (3, "these two, words here"), (4, None), (5, ""), (6, f"x {long}"),
            (7, item.replace("Word3 ", "other ")), (8, item.replace("Word10 ", "other ").replace("Word20 ", "more ")), (None, item), (9, "two"), (9, item)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in got.collect()}
    assert found == {(1, 1): (26, 26), (3, 2): (1, 1), (6, 5): (396, 396), (7, 1): (26, 22), (9, 1): (26, 26)}
    none = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 0 and none.columns == got.columns
    left = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(x or 0 for x, in left.select("doc_id").collect()) == [0, 2, 4, 5, 8]


def line_sets(text):
    return {text[i:i + lines.SHINGLE] for i in range(max(1, len(text) - lines.SHINGLE + 1))}


def brute_lines(given):
    occurrences = [(i, n, s.strip(" \t\n\x0b\f\r").lower()) for i, t in given for n, s in enumerate((t or "").split("\n"))]
    occurrences = [o for o in occurrences if o[2]]
    distinct = sorted({o[2] for o in occurrences})
    sets, root = {s: line_sets(s) for s in distinct}, {s: s for s in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(distinct, 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            root[find(b)] = find(a)
    first = {}
    for i, n, s in sorted(occurrences):
        first.setdefault(find(s), (i, n))
    return {(i, n): first[find(s)] for i, n, s in occurrences}


def test_line_dedup_against_brute_force(spark, rows):
    base = " ".join(f"token{i}" for i in range(40))
    variants = [base.replace(f"token{i} ", f"other{i} ", 1) for i in range(1, 30)]
    given = rows[:120] + [(9000, "\n".join(variants[:15])), (9001, "\n".join(variants[15:]) + "\n" + base), (9002, "  Yes.  \nyes.\n\n \nno")]
    got = lines.dedup_lines(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in got} == brute_lines(given)
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.first_doc, r.first_line)) for r in got)
    left = {r.doc_id: r.text for r in lines.drop_repeated_lines(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    assert left[9000] == variants[0] and left[9001] == "" and left[9002] == "  Yes.  \n\n \nno"


def test_mixing_meets_targets(docs):
    from pyspark.sql import functions as F
    cells = mixing.cells_of(docs).groupBy(*mixing.AXES).agg(F.sum("tokens").alias("tokens"))
    targets = {a: mixing.tempered(cells, a, 0.6) for a in ("source", "lang")}
    raked = mixing.rake(cells, targets, sweeps=40).toPandas()
    for axis in targets:
        want = targets[axis].toPandas().set_index(axis).target
        have = raked.groupby(axis).weight.sum() / raked.weight.sum()
        assert (abs(have - want[have.index]) < 1e-3).all()


def brute_quality(text):
    ws = words(text)
    windows = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    full = [s for s in (text or "").split("\n") if words(s)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(full) - len(set(full)), len(covered))


def test_quality_against_brute_force(spark, rows):
    given = rows + [(7000, None), (7001, ""), (7002, "a b c d e " * 500), (7003, "x\ny\n x\nx\n\n\n"), (7004, " \x0b\f a\x0bb "), (7004, "a é😀 b")]
    got = quality.quality_rules(spark.createDataFrame(given, "doc_id long, text string")).collect()
    want = sorted((i, *brute_quality(t)) for i, t in given)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    marked = [(r.kept, labels[r.doc_id]) for r in got if r.doc_id in labels.index]
    assert sum(k for k, q in marked if q == 1) / sum(q == 1 for _, q in marked) > 0.9


def test_label_model_separates():
    G, B, A = quality.GOOD, quality.BAD, quality.ABSTAIN
    prob = quality.fit_label_model([((G, G, G), 900), ((B, G, G), 5), ((B, B, G), 40), ((B, B, A), 30), ((A, A, A), 3)])
    assert prob[G, G, G] > 0.9 > 0.5 > prob[B, B, G]
    assert quality.fit_label_model([]) == {}


def test_numerals_are_no_letters():
    from hirescope.llm.langid import letter_words
    assert letter_words("½ ② Ⅷ ٣ x²y _a1é") == ["x", "y", "a", "é"]


def test_a_text_too_long_for_the_sample_is_passed_over(spark):
    """One training text longer than a class's half of the bound changes no sample but its own."""
    words = ["river", "stone", "cloud", "table", "green", "paper"]
    rows = [(i, " ".join(words[(i + k) % 6] for k in range(12)) + (" awful slur" if i % 2 else " kind note")) for i in range(400)]
    long_ids = [i for i in range(400, 480)]
    docs = spark.createDataFrame(rows + [(i, "word " * 30000) for i in long_ids], "doc_id long, text string").selectExpr("*", "'en' AS lang")
    marks = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(i, 0) for i in long_ids], "doc_id long, toxic int")
    model = toxicity.toxicity_model(docs, marks, max_words=40_000)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert model["net"] is not None
    assert sum(got[i] for i in range(1, 400, 2)) > 2 * sum(got[i] for i in range(0, 400, 2))


def test_pii_finds_obfuscated_addresses_and_leaves_junk(spark, rows):
    """Addresses written with (at) and (dot) are added by their format; handles and
    hosts without a domain are not; base spans stay."""
    given = rows[:400] + [(50_000 + i, f"Ask joe{i} (at) site{i} (dot) com about it") for i in range(60)]
    given += [(60_000 + i, f"thanks @bob{i} and root@host{i} said so at noon (dot)") for i in range(60)]
    given += [(70_000 + i, f"please write to ann{i}@place{i}.org today") for i in range(120)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(given, "doc_id long, text string")).collect()}
    for i in range(60):
        text = given[[g[0] for g in given].index(50_000 + i)][1]
        assert [text[s.s:s.e] for s in got[50_000 + i].email] == [f"joe{i} (at) site{i} (dot) com"]
        assert got[50_000 + i].base_email == [] and got[60_000 + i].email == []
    assert all(set(r.base_email) <= set(r.email) for r in got.values())


def test_toxicity_learns_from_every_labelled_row(spark):
    """Class counts hold all rows, and a word that only the last few rows hold is learned."""
    import numpy as np
    plain = ["river", "stone", "cloud", "table", "green", "paper"]
    given = [(i, " ".join(plain[(i + k) % 6] for k in range(8)) + (" qzvkj" if i >= 9000 and i % 3 == 0 else ""), int(i >= 9000 and i % 3 == 0))
             for i in range(9300)]
    rows = spark.createDataFrame(given, "doc_id long, text string, toxic int").repartition(4)
    seen, n = toxicity.class_counts(toxicity.word_groups(rows.select("text", "toxic"), 10_000))
    assert n.tolist() == [9200, 100] and seen[:, toxicity.word_ids("qzvkj")[0]].tolist() == [0, 100]
    model = toxicity.fit_toxicity(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), langid.fit_lang_model(rows.selectExpr("doc_id", "text", "'en' AS lang")))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(rows.select("doc_id", "text"), model).collect()}
    assert all((got[i] >= toxicity.THRESHOLD) == (y == 1) for i, _, y in given)
    assert np.isfinite(model["net"].embed).all()
