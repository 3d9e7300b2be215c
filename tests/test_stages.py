"""The Spark ML stages: equal to fit_pipeline, saved and loaded, cross-validated."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from hourcast.operators import models as MD
from hourcast.operators.stages import Ridge, demand_pipeline

from .test_models import COLS, _frame


def _scores(d):
    return [r.prediction for r in d.orderBy("row_id").select("prediction").collect()]


@pytest.mark.parametrize("scaler,transform", [("robust", "sqrt"), ("standard", "log1p"), ("minmax", "none"), ("quantile", "boxcox"),
                                              ("none", "yeojohnson")])
def test_saved_pipeline_equals_fit_pipeline(spark, tmp_path, scaler, transform):
    d = _frame(spark, 120).withColumn("cnt", F.col("cnt") + 1).withColumn("x", F.when(F.col("row_id") != 3, F.col("x")))
    lam = {"boxcox": 0.4, "yeojohnson": 0.6}.get(transform)
    fitted = demand_pipeline(COLS, transform=transform, lam=lam, scaler=scaler).fit(d)
    fitted.save(str(tmp_path / "m"))
    out = PipelineModel.load(str(tmp_path / "m")).transform(d)
    assert out.columns == [*d.columns, "label", "features", "prediction"]
    got = _scores(out)
    assert got == _scores(fitted.transform(d))
    want = MD.fit_pipeline(d, COLS, model="ridge", scaler=scaler, transform=transform, lam=lam).predict(d, keep=("row_id",))
    np.testing.assert_allclose(got, _scores(want), rtol=1e-9)


def test_serving_without_target_and_clash(spark):
    d = _frame(spark, 60)
    fitted = demand_pipeline(COLS, transform="sqrt").fit(d.withColumn("cnt", F.when(F.col("row_id") > 4, F.col("cnt"))))
    bare = d.drop("cnt").withColumn("scaled copy of y", F.lit(1)).withColumn("lam", F.lit("q"))
    out = fitted.transform(bare)
    assert out.columns == [*bare.columns, "features", "prediction"]
    assert min(_scores(out)) >= 0 and fitted.transform(bare.limit(0)).count() == 0
    with pytest.raises(ValueError, match="Missing required columns"):
        fitted.transform(bare.drop("x"))


def test_lambda_is_fitted_on_the_rows_given(spark):
    d = _frame(spark, 60)
    fitted = demand_pipeline(COLS, transform="boxcox1").fit(d)
    from hourcast.operators.stats import best_lambda
    lam = best_lambda(d, "cnt", "boxcox")
    assert fitted.stages[0].getOrDefault("lam") == fitted.stages[-1].getOrDefault("lam") == pytest.approx(lam)
    with pytest.raises(ValueError, match="boxcox needs lam"):
        demand_pipeline(COLS, transform="boxcox").fit(d)


def test_in_cross_validator(spark):
    d = _frame(spark, 90)
    step = Ridge()
    grid = ParamGridBuilder().addGrid(step.alpha, [0.1, 1e6]).build()
    cv = CrossValidator(estimator=demand_pipeline(COLS, transform="sqrt", scaler="standard", estimator=step), estimatorParamMaps=grid,
                        evaluator=RegressionEvaluator(labelCol="cnt", metricName="rmse"), numFolds=2, seed=1)
    best = cv.fit(d)
    assert best.avgMetrics[0] < best.avgMetrics[1]
    want = MD.fit_pipeline(d, COLS, model="ridge", scaler="standard", transform="sqrt", alpha=0.1).predict(d, keep=("row_id",))
    np.testing.assert_allclose(_scores(best.transform(d)), _scores(want), rtol=1e-9)
