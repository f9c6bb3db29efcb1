"""J23/J27 against numpy pinv and the closed form."""

import numpy as np

from hirescope.operators.linear import fit_least_squares, min_norm_solve


def test_min_norm_hand_case():
    X = np.array([[1, 1, 0, 0], [1, 1, 0, 1], [1, 1, 0, 0], [1, 0, 1, 0], [1, 0, 1, 1], [1, 0, 1, 1]], float)
    y = np.array([1, 2, 1.5, 4, 5, 6], float)
    b = min_norm_solve(X.T @ X, X.T @ y)
    assert np.allclose(b, [1.791667, -0.666667, 2.458333, 1.125], atol=1e-6)


def test_fit_matches_numpy_pinv(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        rows.append((i, f"c{rng.integers(0, 4)}", f"l{rng.integers(0, 3)}", float(rng.normal(100, 20))))
    df = spark.createDataFrame(rows, "posting_id long, company_name string, location string, normalized_salary double")
    sk = spark.createDataFrame([(i, "py") for i in range(0, 300, 3)] + [(i, "sql") for i in range(0, 300, 5)],
                               "posting_id long, skill string")
    m = fit_least_squares(df, sk, ["company_name", "location"], ["py", "sql"], k_folds=3)
    # numpy design in the model's column order
    has = {("py", i) for i in range(0, 300, 3)} | {("sql", i) for i in range(0, 300, 5)}
    X = np.array([[1.0] + [1.0 if (n == f"company_name_{c}" or n == f"location_{l}" or (n, pid) in has) else 0.0
                           for n in m.names[1:]] for pid, c, l, _ in rows])
    y = np.array([r[3] for r in rows])
    beta = np.linalg.pinv(X.T @ X) @ (X.T @ y)
    assert np.allclose(X @ beta, X @ m.beta, atol=1e-6)
    assert len(m.folds) == 3 and sum(f["n_test"] for f in m.folds) == 300


def test_conjugate_gradient_path_matches_dense(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"t{rng.integers(0, 12)}", f"c{rng.integers(0, 3)}", float(rng.normal(50, 10))) for i in range(200)]
    df = spark.createDataFrame(rows, "posting_id long, title string, company_name string, normalized_salary double")
    dense = fit_least_squares(df, None, ["company_name", "title"], [], k_folds=3)
    cg = fit_least_squares(df, None, ["company_name", "title"], [], k_folds=3, dense_max=1)
    assert dense.names == cg.names
    assert np.allclose(dense.beta, cg.beta, atol=1e-6)
    for a, b in zip(dense.folds, cg.folds):
        assert abs(a["r2"] - b["r2"]) < 1e-8 and a["n_test"] == b["n_test"]


def test_choose_features():
    import pytest

    from hirescope.operators.linear import choose_features
    assert choose_features({"company_name": "A", "title": None}, ["py"]) == (["company_name"], ["py"])
    with pytest.raises(ValueError):
        choose_features({"company_name": None}, [])


def test_eliminated_levels_match_dense(spark, monkeypatch):
    """Past ``MAX_DENSE_FEATURES`` the widest category leaves the system: crossed and nested
    categories, skills, missing levels, and titles that a fold has for itself."""
    from hirescope.operators import linear as LN

    rng = np.random.default_rng(8)
    schema = "posting_id long, title string, company_name string, location string, normalized_salary double"
    skills = spark.createDataFrame([(i, s) for i in range(240) for s in ("py", "sql") if rng.random() < 0.4], "posting_id long, skill string")
    cats = ["company_name", "location", "title"]
    for nested, sk, used, few in ((False, skills, ["py", "sql"], LN.LEVEL_BROADCAST_ROWS), (True, None, [], 10)):
        rows = []
        for i in range(240):
            t = int(rng.integers(0, 70))
            of = t if nested else int(rng.integers(0, 1000))
            rows.append((i, f"t{t}" if t else None, f"c{of % 4}", f"l{of % 3}", 1000 + float(rng.normal(50, 10))))
        df = spark.createDataFrame(rows, schema)
        dense = fit_least_squares(df, sk, cats, used, k_folds=3)
        with monkeypatch.context() as patch:
            patch.setattr(LN, "MAX_DENSE_FEATURES", 1)
            patch.setattr(LN, "_fit_cg", None)
            patch.setattr(LN, "_fit_dense", None)
            patch.setattr(LN, "LEVEL_BROADCAST_ROWS", few)
            got = fit_least_squares(df, sk, cats, used, k_folds=3)
        assert got.names == dense.names and np.allclose(got.beta, dense.beta, atol=1e-6)
        for a, b in zip(dense.folds, got.folds, strict=True):
            assert a["n_test"] == b["n_test"] and abs(a["r2"] - b["r2"]) < 1e-8
