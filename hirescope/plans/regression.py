"""Salary regression flow (J21, J22, J27-J31): choose features, build the
training set, fit with K-fold CV, predict, tabulate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.operators.filters import dropna_subset
from hirescope.operators.linear import CATEGORY_COLUMNS, LinearModel, choose_features, fit_least_squares, predict, with_skill_array
from hirescope.operators.sampling import seeded_sample

TARGET = "normalized_salary"


def training_set(df: DataFrame, sample_n: int | None = None, id_col: str = "posting_id",
                 seed: int = 42) -> DataFrame:
    """Rows with every model column present; optional seeded sample."""
    cols = [c for c in (*CATEGORY_COLUMNS, TARGET) if c in df.columns]
    out = dropna_subset(df, cols)
    if sample_n is not None:
        out = seeded_sample(out, sample_n, id_col, seed)
    return out


def train_regression(df: DataFrame, skills_long: DataFrame | None, cat_features: Sequence[str],
                     skills_used: Sequence[str], k_folds: int = 3, sample_n: int | None = None,
                     id_col: str = "posting_id", seed: int = 42, dense_max: int | None = None) -> LinearModel:
    """J27 + J28. Raises when fewer rows than folds remain (tested after dropping)."""
    if not cat_features and not skills_used:
        raise ValueError("choose at least one of company, location, title or a skill")
    train = training_set(df, sample_n, id_col, seed)
    if k_folds >= 2 and train.limit(k_folds).count() < k_folds:
        raise ValueError(f"fewer than {k_folds} training rows for {k_folds}-fold CV")
    return fit_least_squares(train, skills_long, cat_features, skills_used, k_folds, TARGET, id_col, seed, dense_max)


def parity_table(model: LinearModel, df: DataFrame, skills_long: DataFrame | None,
                 id_col: str = "posting_id") -> DataFrame:
    """(id, actual, predicted) on the training rows."""
    rows = with_skill_array(df.select(id_col, TARGET, *model.cat_features), skills_long, model.skills_used, id_col)
    pred = predict(model, rows)
    return pred.select(id_col, F.col(TARGET).alias("actual"), "predicted")


def regression_from_inputs(df: DataFrame, skills_long: DataFrame | None, inputs: dict[str, str | None], skills: Sequence[str] = (),
                           k_folds: int = 3, sample_n: int | None = None, id_col: str = "posting_id",
                           seed: int = 42) -> tuple[LinearModel, DataFrame]:
    """J21 to J29 as a user drives them: the categories given a value in ``inputs`` and the
    chosen skills are the features; returns the model and one row with the inputs, the
    skills and the salary predicted for them."""
    cats, chosen = choose_features(inputs, skills)
    model = train_regression(df, skills_long, cats, chosen, k_folds, sample_n, id_col, seed)
    fields = ", ".join(f"{c} string" for c in cats)
    row = df.sparkSession.createDataFrame([(*[inputs[c] for c in cats], chosen)], f"{fields + ', ' if cats else ''}skills array<string>")
    return model, predict(model, row)
