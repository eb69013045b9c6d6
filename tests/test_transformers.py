"""IO9: a pipeline of encoders that is saved and loaded gives what the fitted one gives; each against plain Python."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline, PipelineModel

from tastemine.operators import encode
from tastemine.operators import transformers as M
from tastemine.operators.features import fit_reduction

TRAIN = [(1, "b", 4.0, 2.0, 1.0, "Ann, Bob,Ann"), (2, "a", 2.0, 2.0, 0.5, "bob"), (3, None, 8.0, 2.0, 3.0, None), (4, "a", 6.0, 2.0, 2.5, "Cy,ann"), (5, "é", 5.0, 2.0, 9.0, "")]
OTHER = [(10, "a", 10.0, 3.0, 1.0, "ann,ann,zoe"), (11, "new", None, 2.0, 0.0, "zoe"), (12, None, 4.0, 1.0, 2.0, None)]
SCHEMA = "id bigint, name string, x double, same double, y double, people string"


def _stages():
    return [
        M.MinMax(inputCols=["x", "same"], outputCols=["x01", "same01"]), M.Standard(inputCols=["x", "same"], outputCols=["xs", "sames"]),
        M.LabelCodes(inputCol="name", outputCol="code"), M.TfIdf(inputCol="people", outputCol="tfidf", maxFeatures=3), M.Reduction(inputCols=["x", "y", "same"], outputCol="pca", kept=0.5),
    ]


@pytest.fixture(scope="module")
def frames(spark):
    return spark.createDataFrame(TRAIN, SCHEMA), spark.createDataFrame(OTHER, SCHEMA)


def test_saved_and_loaded(spark, frames, tmp_path):
    train, other = frames
    fitted = Pipeline(stages=_stages()).fit(train)
    fitted.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert [type(s) for s in loaded.stages] == [M.MinMaxModel, M.StandardModel, M.LabelCodesModel, M.TfIdfModel, M.ReductionModel]
    assert [s.uid for s in loaded.stages] == [s.uid for s in fitted.stages]
    assert rows(loaded.transform(other), ["id"]) == rows(fitted.transform(other), ["id"])
    fitted.write().overwrite().save(str(tmp_path / "model"))
    Pipeline(stages=_stages()).write().save(str(tmp_path / "plan"))
    again = Pipeline.load(str(tmp_path / "plan")).fit(train)
    assert rows(again.transform(other), ["id"]) == rows(fitted.transform(other), ["id"])


def test_values(frames):
    train, other = frames
    got = {r["id"]: r for r in Pipeline(stages=_stages()).fit(train).transform(other).collect()}
    x = np.array([r[2] for r in TRAIN])
    assert [got[k]["x01"] for k in (10, 11, 12)] == [(10 - 2) / 6, None, (4 - 2) / 6]
    assert [got[k]["same01"] for k in (10, 12)] == [1.0, -1.0]  # constant when fitted: the distance from it
    assert abs(got[10]["xs"] - (10 - x.mean()) / x.std()) < 1e-12 and got[12]["sames"] == -1.0
    assert [got[k]["code"] for k in (10, 11, 12)] == [0, None, None]
    counts = [Counter((r[5] or "").lower().split(",")) for r in TRAIN]
    counts = [Counter({t: n for t, n in c.items() if t}) for c in counts]
    total = sum(counts, Counter())
    kept = sorted(total, key=lambda t: (-total[t], t))[:3]
    idf = {t: math.log((1 + len(TRAIN)) / (1 + sum(t in c for c in counts))) + 1 for t in kept}
    assert got[10]["tfidf"] == [("ann", 1.0)] and "ann" in idf and got[11]["tfidf"] == [] and got[12]["tfidf"] == []
    own = M.TfIdf(inputCol="people", outputCol="tfidf").fit(train).transform(train)
    table = {(r["id"], t["term"]): t["weight"] for r in own.collect() for t in r["tfidf"]}
    long = {(r["id"], r["term"]): r["weight"] for r in encode.tfidf(train, "id", "people").collect()}
    assert table.keys() == long.keys() and all(abs(table[k] - long[k]) < 1e-12 for k in long)


def test_reduction_is_the_projection(frames):
    train, other = frames
    red = fit_reduction(train, ["x", "y", "same"], kept_variance=0.5)
    model = M.Reduction(inputCols=["x", "y", "same"], outputCol="pca", kept=0.5).fit(train)
    some = other.where("x is not null")
    expected = [[r[f"pca_{k}"] for k in range(red.n_components)] for r in red.transform(some, ("id",)).orderBy("id").collect()]
    assert np.allclose([r["pca"] for r in model.transform(some).orderBy("id").collect()], expected, atol=1e-12)
