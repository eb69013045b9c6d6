"""The encoders as Spark ML estimators and models (IO9, E1-E10): fitted on one split, saved, loaded, applied to others.

A fitted model is its params and a table: one row for scalers and the reduction, a vocabulary for label codes and TF-IDF.
``write().save()`` puts the params beside the table (Parquet, written by the executors), so a vocabulary of any size is
saved as it lies. All of them go into a ``Pipeline`` and come back with ``PipelineModel.load``. One-row tables and the
TF-IDF vocabulary (bounded by its size param) are broadcast; label codes are joined.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemine.operators.cluster import standard_params, standard_scale
from tastemine.operators.encode import TFIDF_MAX_FEATURES, TFIDF_TOKEN_PATTERN, minmax_params, minmax_scale
from tastemine.operators.features import VARIANCE_KEPT, VARIANCE_THRESHOLD, fit_reduction
from tastemine.operators.indexing import label_codes
from tastemine.session import checkpoint


class _TableWriter(MLWriter):
    def __init__(self, model: FittedTable):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802  Spark's name
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FittedTable:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.parquet(f"{path}/table")
        return model


class FittedTable(Model, MLWritable, MLReadable):
    """A model that is its params and ``table``."""

    table: DataFrame

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def with_table(self, estimator: Params, table: DataFrame) -> FittedTable:
        """This model with the params of its estimator and a fitted table."""
        estimator._copyValues(self)
        self.table = checkpoint(table)
        return self


class _Fit(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose params are keyword arguments."""

    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _defaults(self) -> None:
        pass


class MinMaxModel(FittedTable, HasInputCols, HasOutputCols):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return minmax_scale(dataset, _inputs(self), self.table)


class MinMax(_Fit, HasInputCols, HasOutputCols):
    """To [0, 1] by the fitted minima and maxima; a constant feature becomes 0."""

    def _fit(self, dataset: DataFrame) -> MinMaxModel:
        return MinMaxModel().with_table(self, minmax_params(dataset, _inputs(self)))


def _inputs(params) -> dict[str, Column]:
    return {o: F.col(f"`{i}`").cast("double") for i, o in zip(params.getInputCols(), params.getOutputCols(), strict=True)}


class StandardModel(FittedTable, HasInputCols, HasOutputCols):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return standard_scale(dataset.withColumns(_inputs(self)), self.getOutputCols(), self.table)


class Standard(_Fit, HasInputCols, HasOutputCols):
    """To mean 0 and population standard deviation 1 by the fitted values."""

    def _fit(self, dataset: DataFrame) -> StandardModel:
        return StandardModel().with_table(self, standard_params(dataset.withColumns(_inputs(self)), self.getOutputCols()))


class LabelCodesModel(FittedTable, HasInputCol, HasOutputCol):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        codes = self.table.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = dataset.join(codes, F.col(f"`{self.getInputCol()}`").cast("string") == F.col("_value"), "left")
        return joined.withColumn(self.getOutputCol(), F.col("_code")).drop("_value", "_code")


class LabelCodes(_Fit, HasInputCol, HasOutputCol):
    """The place of a value, as text, among the sorted distinct fitted ones; null if it was not among them."""

    def _fit(self, dataset: DataFrame) -> LabelCodesModel:
        codes = label_codes(dataset.where(F.col(f"`{self.getInputCol()}`").isNotNull()), f"`{self.getInputCol()}`", "code")
        return LabelCodesModel().with_table(self, codes.withColumnRenamed("_value", "value"))


class TfIdfModel(FittedTable, HasInputCol, HasOutputCol):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        words = self.table.agg(F.map_from_entries(F.collect_list(F.struct("term", "idf"))).alias("_idf"))  # one row
        tokens = F.filter(_tokens(self.getInputCol()), lambda t: F.map_contains_key("_idf", t))
        rows = dataset.crossJoin(F.broadcast(words)).withColumn("_tokens", tokens)
        weight = lambda t: F.struct(t.alias("term"), (F.size(F.filter("_tokens", lambda x: x == t)) * F.element_at("_idf", t)).alias("w"))
        rows = rows.withColumn("_w", F.transform(F.array_sort(F.array_distinct("_tokens")), weight))
        norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda s, x: s + x["w"] * x["w"]))
        out = F.transform("_w", lambda x: F.struct(x["term"].alias("term"), (x["w"] / norm).alias("weight")))
        return rows.withColumn(self.getOutputCol(), out).drop("_idf", "_tokens", "_w")


def _tokens(col: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{col}`"), F.lit(""))), F.lit(TFIDF_TOKEN_PATTERN), 0)


class TfIdf(_Fit, HasInputCol, HasOutputCol):
    """E5: sparse TF-IDF rows (term, weight) over the fitted vocabulary, the ``maxFeatures`` terms of highest count."""

    maxFeatures = Param(Params._dummy(), "maxFeatures", "size of the vocabulary", typeConverter=TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(maxFeatures=TFIDF_MAX_FEATURES)

    def _fit(self, dataset: DataFrame) -> TfIdfModel:
        rows = dataset.select(_tokens(self.getInputCol()).alias("_t"))
        terms = rows.select("_t", F.explode(F.array_distinct("_t")).alias("term"))
        count = F.size(F.filter("_t", lambda x: x == F.col("term")))
        stats = terms.select("term", count.alias("n")).groupBy("term").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("df"))
        kept = stats.orderBy(F.desc("total"), "term").limit(self.getOrDefault(self.maxFeatures))
        n = rows.agg(F.count(F.lit(1)).alias("_n"))
        idf = F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0
        return TfIdfModel().with_table(self, kept.crossJoin(F.broadcast(n)).select("term", idf.alias("idf")))


class ReductionModel(FittedTable, HasInputCols, HasOutputCol):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        fit = self.table.first()  # one row: numbers by feature and component
        x = [F.col(f"`{c}`").cast("double") - F.lit(m) for c, m in zip(fit["kept"], fit["means"], strict=True)]
        parts = [sum((v * F.lit(w) for v, w in zip(x, c, strict=True)), start=F.lit(0.0)) for c in fit["components"]]
        return dataset.withColumn(self.getOutputCol(), F.array(*parts))


class Reduction(_Fit, HasInputCols, HasOutputCol):
    """Scaling, variance filter and PCA from the fitted covariance, as one linear expression per component."""

    threshold = Param(Params._dummy(), "threshold", "scaled features of this variance or less are dropped", typeConverter=TypeConverters.toFloat)
    kept = Param(Params._dummy(), "kept", "share of the variance that the components keep", typeConverter=TypeConverters.toFloat)

    def _defaults(self) -> None:
        self._setDefault(threshold=VARIANCE_THRESHOLD, kept=VARIANCE_KEPT)

    def _fit(self, dataset: DataFrame) -> ReductionModel:
        red = fit_reduction(dataset, list(self.getInputCols()), self.getOrDefault(self.threshold), self.getOrDefault(self.kept))
        row = (red.kept, red.means, np.asarray(red.coef).T.tolist(), red.ratios)
        table = dataset.sparkSession.createDataFrame([row], "kept array<string>, means array<double>, components array<array<double>>, ratios array<double>")
        return ReductionModel().with_table(self, table)
