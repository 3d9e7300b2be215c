"""The model pipeline as ``pyspark.ml`` stages (M5, P4s, T2, M1, M7).

``demand_pipeline`` chains them: target transform, scaler and assembler, an
estimator, inverse of the target. The stages have Spark ML's parameters, writer
and reader, so a fitted ``PipelineModel`` is saved and loaded as any other and
the ``Pipeline`` runs in ``CrossValidator`` and ``TrainValidationSplit``. What a
fold fits (scaler statistics, lambda, ridge penalty) is fitted on its own rows.
Every stage keeps the columns and rows that it is given.
"""
from __future__ import annotations

import json
from dataclasses import replace

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from .features import forward_expr, inverse_expr
from .models import FEATURES, filled, ridge
from .scale import Scaler, ScalerModel
from .stats import best_lambda

#: prefix of the scaled copies while they are put into a vector
_COPY = "scaled copy of "

#: transforms whose lambda can be fitted (Box-Cox on y + 1)
_FITTED = {"boxcox1": "boxcox", "yeojohnson": "yeojohnson"}


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose parameters are all there is to it."""

    def _param(self, name: str, kind, default=None):
        setattr(self, name, Param(self, name, name, kind))
        if default is not None:
            self._setDefault(**{name: default})

    def _value(self, name: str):
        p = self.getParam(name)
        return self.getOrDefault(p) if self.isDefined(p) else None

    def _handed_on(self, model: "_Saved", **fitted):
        """``model`` with this stage's parameters and what was fitted."""
        for p in self.params:
            if model.hasParam(p.name) and self.isDefined(p):
                model._set(**{p.name: self.getOrDefault(p)})
        return model._set(**fitted)


class _Scaling(Params):
    def _scaling(self):
        self._param("inputCols", TypeConverters.toListString)
        self._param("outputCol", TypeConverters.toString, FEATURES)


class FeatureScaler(Estimator, _Scaling, _Saved):
    """P4s / P5s / P8s: ``inputCols`` with NULL as 0, scaled by ``kind`` (those
    that ``exclude`` does not name) and put into one vector, scaled ones first."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, kind=None, exclude=None, match=None):
        super().__init__()
        self._scaling()
        self._param("kind", TypeConverters.toString, DEFAULT.scaler)
        self._param("exclude", TypeConverters.toListString, list(DEFAULT.scale_exclude))
        self._param("match", TypeConverters.toString, "substring")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FeatureScalerModel":
        cols = self._value("inputCols")
        fitted = Scaler(self._value("kind"), self._value("exclude"), self._value("match")).fit(filled(dataset, cols), cols)
        state = {**fitted.about(), "center": fitted.center, "scale": fitted.scale, "quantiles": fitted.quantiles}
        return self._handed_on(FeatureScalerModel(), statistics=json.dumps(state))


class FeatureScalerModel(Model, _Scaling, _Saved):
    """The fitted scaler; ``statistics`` holds its numbers."""

    def __init__(self):
        super().__init__()
        self._scaling()
        self._param("statistics", TypeConverters.toString)

    def scaler(self) -> ScalerModel:
        s = json.loads(self._value("statistics"))
        return ScalerModel(s["kind"], tuple(s["scale_cols"]), tuple(s["keep_cols"]), s["center"], s["scale"], s["quantiles"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self._value("inputCols")
        missing = [c for c in cols if c not in dataset.columns]
        if missing:
            raise ValueError(f"Missing required columns: {missing}")
        own, copy = self.scaler(), lambda c: _COPY + c
        named = replace(own, scale_cols=tuple(map(copy, own.scale_cols)), keep_cols=tuple(map(copy, own.keep_cols)),
                        **{f: {copy(c): v for c, v in getattr(own, f).items()} for f in ("center", "scale", "quantiles")})
        copies = [copy(c) for c in cols]
        d = filled(dataset.withColumns({copy(c): F.col(f"`{c}`") for c in cols}), copies)
        d = named.transform(d, passthrough=dataset.columns)
        vector = VectorAssembler(inputCols=list(named.scale_cols + named.keep_cols), outputCol=self._value("outputCol"),
                                 handleInvalid="keep")
        return vector.transform(d).drop(*copies)


class _Target(Params):
    def _target(self):
        self._param("inputCol", TypeConverters.toString, "cnt")
        self._param("outputCol", TypeConverters.toString, "label")
        self._param("method", TypeConverters.toString, "none")
        self._param("lam", TypeConverters.toFloat)


class TargetTransform(Estimator, _Target, _Saved):
    """The label from the target by ``method``. Without ``lam`` a power
    transform's lambda is fitted on the rows given."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, method=None, lam=None):
        super().__init__()
        self._target()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TargetTransformModel":
        method, lam = self._value("method"), self._value("lam")
        if lam is None and method == "boxcox":
            raise ValueError("boxcox needs lam; boxcox1 fits its own")
        if lam is None and method in _FITTED:
            lam = best_lambda(dataset, self._value("inputCol"), _FITTED[method])
        return self._handed_on(TargetTransformModel(), **({} if lam is None else {"lam": float(lam)}))


class TargetTransformModel(Model, _Target, _Saved):
    """Adds the label, and in its metadata how to undo it. Rows without the
    target column (serving) pass as they are; rows whose target is NULL or
    outside the transform's domain stay, without label."""

    def __init__(self):
        super().__init__()
        self._target()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        target, method, lam = self._value("inputCol"), self._value("method"), self._value("lam")
        if target not in dataset.columns:
            return dataset
        label = forward_expr(F.col(f"`{target}`").cast("double"), method, lam)
        return dataset.withColumn(self._value("outputCol"), label.alias("label", metadata={"method": method} | ({} if lam is None else {"lam": lam})))


class Ridge(Estimator, _Saved):
    """M1: ridge whose penalty ``alpha`` is that of the closed form, whatever
    the number of rows. Rows without label are left out of the fit."""

    @keyword_only
    def __init__(self, *, alpha=None, labelCol=None, featuresCol=None):
        super().__init__()
        self._param("alpha", TypeConverters.toFloat, float(DEFAULT.ridge_alpha))
        self._param("labelCol", TypeConverters.toString, "label")
        self._param("featuresCol", TypeConverters.toString, FEATURES)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        label = self._value("labelCol")
        rows = dataset.where(F.col(label).isNotNull())
        st = rows.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
        return ridge(self._value("alpha"), st["n"], st["s"], label).setFeaturesCol(self._value("featuresCol")).fit(rows)


class _Inverse(Params):
    def _inverse(self):
        self._param("labelCol", TypeConverters.toString, "label")
        self._param("predictionCol", TypeConverters.toString, "prediction")
        self._param("clip", TypeConverters.toBoolean, True)


class InverseTarget(Estimator, _Inverse, _Saved):
    """M7: predictions back on the target's scale, at least 0 with ``clip``.
    Reads from the label's metadata which transform to undo; no job."""

    @keyword_only
    def __init__(self, *, labelCol=None, predictionCol=None, clip=None):
        super().__init__()
        self._inverse()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "InverseTargetModel":
        about = dataset.schema[self._value("labelCol")].metadata
        lam = about.get("lam")
        return self._handed_on(InverseTargetModel(), method=about.get("method", "none"), **({} if lam is None else {"lam": float(lam)}))


class InverseTargetModel(Model, _Inverse, _Saved):
    """Undoes the transform in place."""

    def __init__(self):
        super().__init__()
        self._inverse()
        self._param("method", TypeConverters.toString, "none")
        self._param("lam", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        c = self._value("predictionCol")
        value = inverse_expr(F.col(c), self._value("method"), self._value("lam"))
        return dataset.withColumn(c, F.greatest(value, F.lit(0.0)) if self._value("clip") else value)


def demand_pipeline(feature_cols, *, target: str = "cnt", transform: str = "none", lam: float | None = None,
                    scaler: str = DEFAULT.scaler, estimator=None) -> Pipeline:
    """M5: target transform -> scaler and vector -> ``estimator`` (ridge by
    default; any that reads ``features`` and ``label``) -> inverse."""
    method = {"inputCol": target, "method": transform} | ({} if lam is None else {"lam": lam})
    return Pipeline(stages=[TargetTransform(**method), FeatureScaler(inputCols=list(feature_cols), kind=scaler),
                            estimator or Ridge(), InverseTarget()])
