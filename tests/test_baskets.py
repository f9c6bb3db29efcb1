"""J2/J3 against brute force, thresholds, and the FPGrowth cross-check."""

import itertools
import math
import random


from hirescope.operators.baskets import association_rules, frequent_itemsets, side_min_count, union_min_count


def brute_rules(baskets, n, s, N):
    items = sorted({i for b in baskets for i in b})
    cnt = {}
    for k in range(1, 2 * N + 1):
        for c in itertools.combinations(items, k):
            v = sum(1 for b in baskets if set(c) <= b)
            if v:
                cnt[c] = v
    side_min = math.ceil(n * s)
    F_ = {k: v for k, v in cnt.items() if len(k) <= N and v >= side_min}
    out = set()
    keys = sorted(F_)
    for a, b in itertools.combinations(keys, 2):
        if set(a) & set(b):
            continue
        u = tuple(sorted(set(a) | set(b)))
        cu = cnt.get(u, 0)
        if cu / n < s:
            continue
        sup = cu / n
        c1 = sup / (F_[a] / n)
        c2 = sup / (F_[b] / n)
        out.add((a, b, round(sup, 4), round(c1, 4), round(c1 / (F_[b] / n), 4)))
        out.add((b, a, round(sup, 4), round(c2, 4), round(c2 / (F_[a] / n), 4)))
    return out


def test_rules_match_brute_force(spark):
    rnd = random.Random(7)
    items = list("abcdefg")
    baskets = [set(rnd.sample(items, rnd.randint(0, 5))) for _ in range(120)]
    n = len(baskets) + 10  # baskets without items count in n
    rows = [(i, it) for i, b in enumerate(baskets) for it in b]
    df = spark.createDataFrame(rows, "posting_id long, skill string")
    for s, N in [(0.05, 2), (0.1, 3), (0.2, 1)]:
        got = {(tuple(r.antecedent), tuple(r.consequent), r.support, r.confidence, r.lift)
               for r in association_rules(df, n, s, N).collect()}
        want = brute_rules(baskets, n, s, N)
        assert {g[:2] for g in got} == {w[:2] for w in want}, (s, N)
        gm = {g[:2]: g[2:] for g in got}
        for w in want:
            assert all(abs(x - y) < 1e-9 for x, y in zip(gm[w[:2]], w[2:]))


def test_threshold_in_doubles():
    # ceil(100 * 0.07) is 8 in doubles, but 7 / 100 >= 0.07 holds.
    assert side_min_count(100, 0.07) == 8
    assert union_min_count(100, 0.07) == 7


def test_seven_of_hundred_gives_no_rule(spark):
    rows = [(i, x) for i in range(7) for x in ("a", "b")]
    df = spark.createDataFrame(rows, "posting_id long, skill string")
    assert association_rules(df, 100, 0.07, 1).count() == 0


def test_frequent_itemsets_vs_fpgrowth(spark):
    from pyspark.ml.fpm import FPGrowth
    rnd = random.Random(3)
    baskets = [sorted(set(rnd.sample(list("abcdef"), rnd.randint(1, 4)))) for _ in range(80)]
    df = spark.createDataFrame([(i, it) for i, b in enumerate(baskets) for it in b], "posting_id long, skill string")
    ours = {(tuple(r["items"]), r["count"]) for r in frequent_itemsets(df, 80, 0.1, 6).collect()}
    fp = FPGrowth(itemsCol="items", minSupport=0.1).fit(
        spark.createDataFrame([(b,) for b in baskets], "items array<string>"))
    theirs = {(tuple(sorted(r["items"])), r["freq"]) for r in fp.freqItemsets.collect() if r["freq"] >= 8}
    assert ours == theirs
