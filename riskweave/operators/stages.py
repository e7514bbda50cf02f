"""Feature building and encoding as Spark ML stages, so that one pipeline goes from rows to probabilities.

Both stages keep the other columns, are saved and loaded with the pipeline they stand in, and take their settings as
params, so grids and validators can vary them.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from riskweave.operators import features
from riskweave.operators.preprocess import FittedColumns, fit_columns

BUILDERS = {"credit": features.credit_features, "fraud": features.fraud_features}


class DomainFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the engineered columns of a domain whose features need no fit: credit or fraud."""

    domain = Param(Params._dummy(), "domain", "credit or fraud", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, domain: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        domain = self.getOrDefault(self.domain)
        if domain not in BUILDERS:
            raise ValueError(f"No features of domain {domain!r}; there are those of {', '.join(BUILDERS)}.")
        return BUILDERS[domain](dataset)


class _EncoderParams(HasOutputCol):
    numericCols = Param(Params._dummy(), "numericCols", "columns to impute by the median and to scale", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "columns to impute by the mode and to encode", TypeConverters.toListString)
    imputeMissing = Param(Params._dummy(), "imputeMissing", "whether missing values are imputed", TypeConverters.toBoolean)
    missingCategory = Param(Params._dummy(), "missingCategory", "whether a missing value is a category of its own", TypeConverters.toBoolean)
    mostCategories = Param(Params._dummy(), "mostCategories", "a column with more values is refused", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(numericCols=[], categoricalCols=[], imputeMissing=True, missingCategory=False, mostCategories=10_000, outputCol="features")


class ColumnEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns medians, modes, means, deviations and categories (`preprocess.fit_columns`) from the rows it is fitted on."""

    @keyword_only
    def __init__(self, *, numericCols: list[str] | None = None, categoricalCols: list[str] | None = None, imputeMissing: bool = True,
                 missingCategory: bool = False, mostCategories: int = 10_000, outputCol: str = "features"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ColumnEncoderModel:
        fitted = fit_columns(
            dataset, self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols), self.getOrDefault(self.imputeMissing),
            self.getOrDefault(self.missingCategory), self.getOrDefault(self.mostCategories))
        model = ColumnEncoderModel()
        model._set(learned=json.dumps(asdict(fitted)))
        return self._copyValues(model)


class ColumnEncoderModel(Model, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the vector of encoded features; values unseen in training are zero in all categories."""

    learned = Param(Params._dummy(), "learned", "what the encoder learned, as JSON", TypeConverters.toString)

    @property
    def fitted(self) -> FittedColumns:
        return FittedColumns(**json.loads(self.getOrDefault(self.learned)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, kept = self.getOutputCol(), dataset.columns
        for name in {out, "features"} & set(kept):
            raise ValueError(f"The rows already have a column {name}.")
        return self.fitted.vectors(dataset, kept).withColumnRenamed("features", out)
