import numpy as np
import pytest

from tierline.llm import mixing
from tierline.llm.common import Store


def test_sample_holds_one_text_of_each_id(spark, monkeypatch):
    rows = [(1, f"same words {i % 7}") for i in range(400)] + [(i, f"text {i}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    kept = {}

    class Kept(Store):
        def keep(self, df, name):
            kept[name] = super().keep(df, name)
            return kept[name]

    mixing.fit(docs, labels, Kept(spark))
    assert kept["sample"].count() == 39


def posteriors(rows):
    """Tokens and diffuse posteriors, the good ones 0.9 on average."""
    r = np.random.default_rng(4)
    good = r.random(rows) < 0.9
    p = np.where(good[:, None], r.dirichlet([12, 0.6, 0.6], rows), r.dirichlet([2, 2, 2], rows))
    return r.integers(20, 900, rows), p


def test_rates_reach_the_targets_with_diffuse_posteriors(spark):
    tokens, p = posteriors(3000)
    names = ["t", "a", "b", "c"]
    rows = [(int(t), *map(float, q)) for t, q in zip(tokens, p)]
    df = spark.createDataFrame(rows, "t long, a double, b double, c double").cache()
    rate = np.ones(len(p))
    for step in mixing.fit_rates(df, names):
        rate = np.maximum(0, rate - p @ np.array(step))
    totals = (rate * tokens) @ p
    assert np.allclose(totals / totals.sum(), mixing.TARGET, atol=2e-4)


def test_targets_out_of_reach_are_reported(spark):
    df = spark.createDataFrame([(10, 0.4, 0.3, 0.3)] * 5, "t long, a double, b double, c double")
    with pytest.warns(UserWarning, match="away from the targets"):
        mixing.fit_rates(df, ["t", "a", "b", "c"])
