"""Exact grouped quantiles vs numpy, including a hot group and heavy ties."""

import numpy as np

from hirescope.operators.quantiles import exact_quantiles


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in rng.normal(0, 1, 20000)]
    rows += [("ties", float(x)) for x in rng.integers(0, 5, 3000)]
    rows += [("one", 7.0), ("two", 1.0), ("two", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "g", "v", (0.25, 0.5, 0.75)).collect()}
    for g in ("hot", "ties", "one", "two"):
        vals = np.array([v for gg, v in rows if gg == g])
        want = np.percentile(vals, [25, 50, 75])
        assert got[g].n == len(vals)
        assert np.allclose([got[g].q25, got[g].q50, got[g].q75], want, rtol=0, atol=1e-12), g


def test_quantiles_of_all_kinds_of_doubles(spark):
    """Signs, zeros, extreme exponents, missing and not-a-number values, a null group."""
    rng = np.random.default_rng(3)
    odd = [-1e308, -5e-324, 0.0, 5e-324, 1e-300, 2.5, 1e308, float("inf"), -7.25]
    rows = [("odd", v) for v in odd] + [("odd", float("nan")), ("odd", None), ("none", None), (None, 3.0), (None, -3.0)]
    rows += [("wide", float(s * 10.0 ** e)) for s, e in zip(rng.choice([-1, 1], 400), rng.uniform(-200, 200, 400))]
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", (0, 0.1, 0.5, 1)).collect()}
    assert got.keys() == {"odd", "wide", None} and got["odd"].n == len(odd)
    for g, r in got.items():
        vals = np.array([v for gg, v in rows if gg == g and v is not None and v == v])
        for q, have in zip((0, 0.1, 0.5, 1), (r.q0, r.q10, r.q50, r.q100), strict=True):
            s, p = np.sort(vals), q * (len(vals) - 1)
            lo, hi = int(np.floor(p)), int(np.ceil(p))
            want = s[lo] if lo == hi else (hi - p) * s[lo] + (p - lo) * s[hi]
            assert have == want or abs(have - want) <= 1e-12 * abs(want), (g, q)
