"""Models, pipeline, importance, selection, CV and transform comparison
(M1-M7, M11-M15, D12, X4, X5, X7, X8, X9) on Spark ML.

Model fits are Spark ML jobs (distributed L-BFGS / tree aggregation); loops
over folds or candidates only orchestrate fits -- no row data reaches the
driver, only metrics and model metadata. The assembled training frame is
checkpointed into the cluster's checkpoint dir before iterative use.
"""
from __future__ import annotations

import importlib
import json
import math
from dataclasses import dataclass, field

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..plans import gram
from ..plans.ordering import with_row_index
from ..session import cut_lineage
from .evaluate import evaluate, metric_aggs
from .features import forward_expr, inverse_expr
from .scale import Scaler, ScalerModel, split_scale_columns

FEATURES = "features"


def ridge(alpha: float = DEFAULT.ridge_alpha, n: int | None = None, sigma_y: float | None = None,
          label="label") -> LinearRegression:
    """M1: sklearn-style ridge (unpenalised intercept). Spark's objective is
    (1/2n)||r||^2 + (lambda/2)||w||^2 and the normal-equation solver scales the
    label by its population std, so lambda = alpha / n * std_pop(y); checked
    against the closed form to 1e-15. One aggregation pass (X'X), no iterations."""
    reg = alpha / n * sigma_y if n and sigma_y else alpha
    return LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=reg, elasticNetParam=0.0,
                            standardization=False, solver="normal")


def random_forest(label="label", seed: int = DEFAULT.seed, **kw) -> RandomForestRegressor:
    """M2: forest with the configured defaults (no min-split / OOB in Spark)."""
    p = {**DEFAULT.rf, **kw}
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **p)


def boosted(label="label", seed: int = DEFAULT.seed, validation_col: str | None = None, **kw) -> GBTRegressor:
    """M3: gradient-boosted trees; with ``validation_col`` stopped by Spark's
    validation tolerance (``fit_pipeline`` stops by patience instead, see
    ``stop_early``). No L1/L2 leaf penalties in Spark."""
    p = {**DEFAULT.gbt, **kw}
    g = GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **p)
    if validation_col:
        g = g.setValidationIndicatorCol(validation_col)
        g.set(g.validationTol, 1e-4)
    return g


def best_round(errors, patience: int) -> int:
    """Rounds to keep: up to the lowest error before ``patience`` rounds in a
    row brought none lower (ties: the earlier round)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def stop_early(model: GBTRegressionModel, watched: DataFrame, patience: int) -> GBTRegressionModel:
    """M3: the boosted model cut at its best round on ``watched`` (columns
    features and label). Spark cannot watch an error while it boosts, so all
    rounds are fitted and the staged errors scanned afterwards. Without watched
    rows the whole model stays."""
    if watched.isEmpty():
        return model
    keep = best_round(model.evaluateEachIteration(watched, "squared"), patience)
    jvm = watched.sparkSession._jvm
    gateway = watched.sparkSession.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    weights = gateway.new_array(jvm.double, keep)
    for i, (t, w) in enumerate(zip(model.trees[:keep], model.treeWeights[:keep])):
        trees[i], weights[i] = t._java_obj, float(w)
    cut = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(
        model.uid, trees, weights, model.numFeatures))
    return model._copyValues(cut)


def linear(label="label") -> LinearRegression:
    """M4: plain least squares."""
    return LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=0.0, solver="normal")


def build_estimator(name: str, train: DataFrame, label: str = "label", **kw):
    if name == "ridge":
        st = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
        return ridge(kw.get("alpha", DEFAULT.ridge_alpha), st["n"], st["s"], label)
    if name == "random_forest":
        return random_forest(label, **kw)
    if name == "boosted":
        return boosted(label, **kw)
    if name == "linear":
        return linear(label)
    raise ValueError(f"unknown model {name}")


@dataclass
class DemandModel:
    """M5: fitted pipeline = scaler (exact statistics) + assembler + model."""
    feature_cols: list
    scaler: ScalerModel
    model: object
    label: str = "label"
    transform_method: str = "none"
    lam: float | None = None
    name: str = "model"
    meta: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, *, keep=(), clip_zero: bool = True) -> DataFrame:
        """Scale -> assemble -> predict -> invert the target transform (M7:
        clip at 0). Rows keep ``keep`` columns for joins by key."""
        for c in self.feature_cols:
            if c not in df.columns:
                raise ValueError(f"Missing required columns: {c}")
        d = filled(df, self.feature_cols)
        sc = self.scaler.transform(d, passthrough=[c for c in keep if c in d.columns])
        out = self.model.transform(assembler(self.scaler).transform(sc))
        pred = inverse_expr(F.col("prediction"), self.transform_method, self.lam)
        pred = F.greatest(pred, F.lit(0.0)) if clip_zero else pred
        return out.select(*[c for c in keep if c in out.columns], pred.alias("prediction"))

    def save(self, path: str, spark) -> None:
        """The Spark ML model, the scaler's statistics and one row with all
        else (features, scaler kind and columns, transform, lambda, name)."""
        self.model.write().overwrite().save(f"{path}/model")
        self.scaler.to_df(spark).write.mode("overwrite").parquet(f"{path}/scaler")
        about = {"feature_cols": list(self.feature_cols), "label": self.label, "transform": self.transform_method,
                 "lam": self.lam, "name": self.name, "meta": self.meta, "scaler": self.scaler.about(),
                 "model_class": f"{type(self.model).__module__}.{type(self.model).__name__}"}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str, spark) -> "DemandModel":
        """The model as it was saved."""
        about = json.loads(spark.read.parquet(f"{path}/about").first()[0])
        home, name = about["model_class"].rsplit(".", 1)
        model = getattr(importlib.import_module(home), name).load(f"{path}/model")
        scaler = ScalerModel.from_df(spark.read.parquet(f"{path}/scaler"), about["scaler"])
        return cls(about["feature_cols"], scaler, model, about["label"], about["transform"], about["lam"], about["name"], about["meta"])


def filled(df: DataFrame, cols) -> DataFrame:
    """P8s: NULL features are 0 on the raw scale, before any scaling."""
    return df.fillna(0.0, subset=list(cols))


def assembler(scaler: ScalerModel) -> VectorAssembler:
    return VectorAssembler(inputCols=list(scaler.scale_cols + scaler.keep_cols), outputCol=FEATURES, handleInvalid="keep")


def fit_pipeline(train: DataFrame, feature_cols, *, label="cnt", model: str = "ridge", scaler: str = DEFAULT.scaler,
                 transform: str = "none", lam: float | None = None, exclude=DEFAULT.scale_exclude,
                 match="substring", patience: int | None = DEFAULT.gbt_early_stop, **kw) -> DemandModel:
    """M5: fit scaler on train, assemble, fit the estimator on the (optionally
    transformed) target. With ``validation_col`` the rows it marks only steer
    early stopping (after ``patience`` rounds without a lower error; None:
    Spark's tolerance): scaler and trees are fitted on the others."""
    watch = kw.get("validation_col")
    tr = train.withColumn("label", forward_expr(F.col(label).cast("double"), transform, lam))
    tr = filled(tr, feature_cols)
    sm = Scaler(scaler, exclude, match).fit(tr.where(~F.col(watch)) if watch else tr, feature_cols)
    sc = sm.transform(tr, passthrough=["label"] + ([watch] if watch else [])).where(F.col("label").isNotNull())
    x = assembler(sm).transform(sc)
    if watch and model == "boosted" and patience is not None:
        x = cut_lineage(x)
        full = build_estimator(model, x, "label", **{k: v for k, v in kw.items() if k != "validation_col"}).fit(x.where(~F.col(watch)))
        return DemandModel(list(feature_cols), sm, stop_early(full, x.where(F.col(watch)), patience), "label", transform, lam, model)
    est = build_estimator(model, x, "label", **kw)
    return DemandModel(list(feature_cols), sm, est.fit(x), "label", transform, lam, model)


def importance(dm: DemandModel, spark, top_n: int | None = None) -> DataFrame:
    """M6: tree importances or |coefficients| with feature names, sorted."""
    names = list(dm.scaler.scale_cols + dm.scaler.keep_cols)
    m = dm.model
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    rows = [(names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(top_n) if top_n else df


def evaluate_model(dm: DemandModel, df: DataFrame, label="cnt", keep=("series_id", "row_id"), ddof=1,
                   by=()) -> DataFrame:
    """M8 on a model's predictions; the label passes through ``predict``, so
    nothing is joined back."""
    p = dm.predict(df.withColumn("_y", F.col(label).cast("double")), keep=[*keep, *by, "_y"])
    return evaluate(p, "_y", "prediction", by=by, ddof=ddof)


def train_all(splits: DataFrame, feature_cols, *, label="cnt", models=("ridge", "random_forest", "boosted"),
              split_col="split", model_kw: dict | None = None, transform="none") -> tuple[DataFrame, dict]:
    """Fit each model on train, evaluate on train / val / test; a model
    that fails is skipped. Returns (comparison table, fitted models); the best
    is the lowest validation RMSE (``min_by``)."""
    model_kw = model_kw or {}
    spark = splits.sparkSession
    train = splits.where(F.col(split_col) == "train")
    fitted, rows = {}, None
    for name in models:
        kw = dict(model_kw.get(name, {}))
        tr = train
        if kw.get("validation_col"):
            # early stopping watches the validation split (rows flagged by validation_col)
            tr = splits.where(F.col(split_col).isin("train", "val"))
        try:
            dm = fit_pipeline(tr, feature_cols, label=label, model=name, transform=transform, **kw)
        except Exception as e:  # noqa: BLE001 -- a failing model is skipped, as in the reference
            import logging
            logging.getLogger(__name__).warning("model %s failed and is skipped: %s", name, e)
            continue
        fitted[name] = dm
        ev = evaluate_model(dm, splits, label, by=(split_col,)).withColumn("model", F.lit(name))
        rows = ev if rows is None else rows.unionByName(ev)
    if rows is None:
        return spark.createDataFrame([], "model string"), fitted
    best = rows.where(F.col(split_col) == "val").agg(F.min_by("model", "rmse").alias("_best"))
    # ``best`` is a single-row aggregate: equi-join on a constant key
    rows = rows.withColumn("_k", F.lit(1)).join(best.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return rows.withColumn("is_best", F.col("model") == F.col("_best")).drop("_best"), fitted


def select_model(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Explicit name (if available) -> best marker -> first available
    (by ``rank``). ``registry`` columns: model, available, is_best, rank."""
    avail = registry.where("available")
    pri = (F.when(F.lit(name).isNotNull() & (F.col("model") == F.lit(name)), 0)
           .when(F.col("is_best"), 1).otherwise(2))
    return avail.withColumn("_p", pri).orderBy("_p", "rank").limit(1).drop("_p")


# ---- M11-M13 cross-validation ------------------------------------------------

def _indexed(df: DataFrame, order=("timestamp", "row_id"), series="series_id") -> DataFrame:
    """``_i``: position in the row's series; ``_rows``: rows of that series. Folds
    are cut per series, so every fold holds the same part of each."""
    d = df if series in df.columns else df.withColumn(series, F.lit("all"))
    return cut_lineage(with_row_index(d, series, order, name="_i", count_col="_rows"))


def _parallel(tasks, parallelism: int):
    """Run independent fits concurrently from driver threads (Spark schedules
    the concurrent jobs; same idea as CrossValidator's ``parallelism``)."""
    if parallelism <= 1:
        return [t() for t in tasks]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return list(ex.map(lambda t: t(), tasks))


def cv_blocks(df: DataFrame, k: int = 5) -> DataFrame:
    """``_block`` of TimeSeriesSplit(k) on rows indexed by ``_indexed``: the test
    block (0 to k-1) of fold i holds n // (k + 1) rows of each series; earlier
    rows have -1. Fold i trains on all blocks below i."""
    size = F.floor(F.col("_rows") / F.lit(k + 1))
    first = F.col("_rows") - size * k
    return df.withColumn("_block", F.when((F.col("_i") < first) | (size == 0), F.lit(-1)).otherwise(
        F.least(F.floor((F.col("_i") - first) / size), F.lit(k - 1))).cast("int"))


def cv_sizes(df: DataFrame, *, k: int = 5, order=("timestamp", "row_id")) -> DataFrame:
    """Rows that each fold trains on and tests on, per series (one scan)."""
    d = cv_blocks(_indexed(df, order), k)
    folds = F.explode(F.array(*[F.lit(i) for i in range(k)])).alias("fold")
    return (d.groupBy("series_id", "_block").agg(F.count(F.lit(1)).alias("_cells")).select("*", folds)
            .groupBy("series_id", "fold").agg(
                F.sum(F.when(F.col("_block") < F.col("fold"), F.col("_cells")).otherwise(0)).alias("train_size"),
                F.sum(F.when(F.col("_block") == F.col("fold"), F.col("_cells")).otherwise(0)).alias("test_size")))


def _additive(model: str, kw: dict) -> bool:
    """Whether a fit follows from sums of products: a linear model on the raw
    target, scaled column by column."""
    return (model in ("ridge", "linear") and kw.get("scaler", DEFAULT.scaler) in gram.SCALERS
            and kw.get("transform", "none") == "none" and not kw.get("validation_col"))


def _gram_scores(d: DataFrame, feature_cols, label, model, cells, test, sets, tests, *, train=True, alpha=DEFAULT.ridge_alpha,
                 scaler: str = DEFAULT.scaler, exclude=DEFAULT.scale_exclude, match="substring", transform="none", lam=None) -> DataFrame:
    """Metrics of all sets of cells (``plans.gram``): three scans, however many."""
    cols = list(feature_cols)
    chosen = set(split_scale_columns(cols, exclude, match)[0])
    x = gram.prepare(d, cols, label, cells, test)
    pivot, fits = gram.fit_sets(x, sets, alpha=alpha if model == "ridge" else 0.0, scaler=scaler,
                                scaled=[i for i, c in enumerate(cols) if c in chosen])
    return gram.score_sets(x, sets, tests, pivot, fits, train=train)


def time_series_cv(df: DataFrame, feature_cols, *, k: int = 5, label="cnt", models=("ridge",),
                   order=("timestamp", "row_id"), parallelism: int = 4, model_kw: dict | None = None, **kw) -> DataFrame:
    """Expanding-window CV like TimeSeriesSplit(k) within every series:
    fold i trains on all rows before its test block. Per model and fold metrics,
    plus mean (fold -1) and population-std (fold -2) rows. Linear models take
    all folds from the same sums per block (``plans.gram``); trees are fitted
    fold by fold."""
    d = cut_lineage(cv_blocks(_indexed(df, order), k))
    sizes = {r["_block"]: r["n"] for r in d.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = F.create_map(*[v for i in range(k) for v in (F.lit(i), F.lit(sum(n for b, n in sizes.items() if b < i)).cast("long"))])
    own = {m: {**kw, **(model_kw or {}).get(m, {})} for m in models}
    out = None
    for m in (m for m in models if _additive(m, own[m])):
        # cell b + 1 is block b; fold i trains on the cells up to i
        ev = _gram_scores(d, feature_cols, label, m, [F.col("_block") + 1], F.col("_block"),
                          [list(range(i + 1)) for i in range(k)], list(range(k)), train=False, **own[m]).select(
            F.lit(m).alias("model"), F.col("set").alias("fold"), before[F.col("set")].alias("train_size"), "rmse", "mae", "r2")
        out = ev if out is None else out.unionByName(ev)
    jobs = [(m, i) for m in models if not _additive(m, own[m]) for i in range(k)]
    fitted = _parallel([lambda m=m, i=i: fit_pipeline(d.where(F.col("_block") < i), feature_cols, label=label, model=m, **own[m])
                        for m, i in jobs], parallelism)
    for (m, i), dm in zip(jobs, fitted):
        train = sum(n for b, n in sizes.items() if b < i)
        ev = evaluate_model(dm, d.where(F.col("_block") == i), label, keep=()).select(
            F.lit(m).alias("model"), F.lit(i).alias("fold"), F.lit(train).cast("long").alias("train_size"), "rmse", "mae", "r2")
        out = ev if out is None else out.unionByName(ev)
    out = cut_lineage(out)
    for fold, f in ((-1, F.avg), (-2, F.stddev_pop)):
        out = out.unionByName(out.where("fold >= 0").groupBy("model").agg(
            F.lit(fold).alias("fold"), F.lit(None).cast("long").alias("train_size"), *[f(c).alias(c) for c in ("rmse", "mae", "r2")]))
    return out


def grid_search(df: DataFrame, feature_cols, grid: dict = DEFAULT.rf_grid, *, label="cnt", folds: int = 3,
                model="random_forest", order=("timestamp", "row_id"), parallelism: int = 4) -> tuple[DataFrame, dict]:
    """Every point of ``grid`` x contiguous folds (fold = floor(3 i / n) of
    each series, as KFold without shuffle) through ``CrossValidator``; best by
    MSE. Returns (per-point average MSE, best params)."""
    d = _indexed(df, order)
    d = d.withColumn("fold", F.floor(F.col("_i") * folds / F.col("_rows")).cast("int"))
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=FEATURES, handleInvalid="keep")
    x = va.transform(filled(d.withColumn("label", F.col(label).cast("double")), feature_cols)).select(FEATURES, "label", "fold")
    est = build_estimator(model, x, "label")
    pg = ParamGridBuilder()
    for p, vals in grid.items():
        pg = pg.addGrid(est.getParam(p), list(vals))
    maps = pg.build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=RegressionEvaluator(metricName="mse"),
                        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=DEFAULT.seed)
    m = cv.fit(cut_lineage(x))
    rows = [({p.name: v for p, v in pm.items()}, float(s)) for pm, s in zip(maps, m.avgMetrics)]
    spark = df.sparkSession
    res = spark.createDataFrame([(str(sorted(r[0].items())), r[1]) for r in rows], "params string, mse double")
    best = min(rows, key=lambda r: r[1])[0]
    return res, best


def learning_curve(df: DataFrame, feature_cols, *, label="cnt", model="ridge", folds: int = 3, sizes: int = 10,
                   order=("timestamp", "row_id"), parallelism: int = 4, **kw) -> DataFrame:
    """For each contiguous fold as test set, train on the first
    10 %..100 % of the remaining rows of every series; mean / std of train and
    test RMSE per size, and the final train-test gap. For linear models all
    sizes are running sums of the same cells (``plans.gram``)."""
    d = _indexed(df, order).withColumn("_f", F.floor(F.col("_i") * folds / F.col("_rows")).cast("int"))
    # place among the rows outside fold f: rows after it move up by its length
    fold_rows = lambda f: F.ceil(F.col("_rows") * (f + 1) / folds) - F.ceil(F.col("_rows") * f / folds)
    shares = [0.1 + 0.9 * i / (sizes - 1) if sizes > 1 else 1.0 for i in range(sizes)]
    if _additive(model, kw):
        cells, sets = [], []
        for f in range(folds):
            place = F.when(F.col("_f") < f, F.col("_i")).otherwise(F.col("_i") - fold_rows(f))
            rank = F.lit(None).cast("int")   # the smallest size that takes the row
            for i, share in reversed(list(enumerate(shares))):
                rank = F.when(place < F.floor((F.col("_rows") - fold_rows(f)) * F.lit(share) + F.lit(1e-9)), F.lit(f * sizes + i)).otherwise(rank)
            cells.append(F.when(F.col("_f") != f, rank))
            sets += [list(range(f * sizes, f * sizes + i + 1)) for i in range(sizes)]
        m = _gram_scores(d, feature_cols, label, model, cells, F.col("_f"), sets, [f for f in range(folds) for _ in shares], **kw)
        share = F.get(F.array(*[F.lit(float(x)) for x in shares]), F.col("set") % sizes)
        of = lambda role, c: F.max(F.when(F.col("role") == role, F.col(c)))
        res = m.groupBy("set").agg(of("train", "n").alias("train_size"), of("train", "rmse").alias("train_rmse"), of("test", "rmse").alias("test_rmse")) \
            .withColumn("share", share)
        return _curve(res)
    jobs = []   # (fold, share, train frame, test frame)
    for f in range(folds):
        rest = d.where(F.col("_f") != f)
        place = F.when(F.col("_f") < f, F.col("_i")).otherwise(F.col("_i") - fold_rows(f))
        for share in shares:
            wanted = F.floor((F.col("_rows") - fold_rows(f)) * F.lit(share) + F.lit(1e-9))
            jobs.append((f, share, rest.where(place < wanted), d.where(F.col("_f") == f)))
    models = _parallel([lambda j=j: fit_pipeline(j[2], feature_cols, label=label, model=model, **kw) for j in jobs],
                       parallelism)

    def score(job, dm):
        f, share, tr, te = job
        a = evaluate_model(dm, tr, label, keep=()).first()
        b = evaluate_model(dm, te, label, keep=()).first()
        return (float(share), f, a["n"], a["rmse"], b["rmse"])
    rows = _parallel([lambda j=j, m=m: score(j, m) for j, m in zip(jobs, models)], parallelism)
    return _curve(df.sparkSession.createDataFrame(rows, "share double, fold int, train_size long, train_rmse double, test_rmse double"))


def _curve(res: DataFrame) -> DataFrame:
    """One row per size from the rows per (size, fold)."""
    g = res.groupBy("share").agg(F.min("train_size").alias("train_size"),
                                 F.avg("train_rmse").alias("train_mean"), F.stddev_pop("train_rmse").alias("train_std"),
                                 F.avg("test_rmse").alias("test_mean"), F.stddev_pop("test_rmse").alias("test_std")).drop("share")
    return g.withColumn("gap", F.col("test_mean") - F.col("train_mean"))


# ---- D12 target-transform comparison ---------------------------------------------

def compare_transforms(df: DataFrame, feature_cols, *, label="cnt", lambdas: dict | None = None,
                       train_frac: float = 0.7, order=("timestamp", "row_id")) -> DataFrame:
    """For each target transform fit a linear model on the first 70 % of
    every series (standard-scaled basics), invert predictions, clip at 0, score on the
    original scale; rank by RMSE with improvement over the raw target."""
    lambdas = lambdas or {}
    d = _indexed(df, order)
    early = F.col("_i") < F.floor(F.col("_rows") * F.lit(train_frac))
    tr, te = d.where(early), d.where(~early)
    out = None
    for method in ("none", "log1p", "sqrt", "boxcox", "yeojohnson"):
        lam = lambdas.get(method)
        if method in ("boxcox", "yeojohnson") and lam is None:
            from .stats import best_lambda
            lam = best_lambda(tr, label, method)
        # Box-Cox is fitted on y + 1, as its lambda is
        name = "boxcox1" if method == "boxcox" else method
        dm = fit_pipeline(tr, feature_cols, label=label, model="linear", scaler="standard", transform=name,
                          lam=lam, exclude=())
        ev = evaluate_model(dm, te, label, keep=()).select(
            F.lit(method).alias("transform"), F.lit(lam).cast("double").alias("lambda"), "mae", "rmse", "r2")
        out = ev if out is None else out.unionByName(ev)
    base = out.where(F.col("transform") == "none").select(F.col("rmse").alias("_b"))
    out = out.withColumn("_k", F.lit(1)).join(base.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return out.select("transform", "lambda", "mae", "rmse", "r2",
                      F.rank().over(Window.orderBy("rmse")).alias("rank"),
                      ((F.col("_b") - F.col("rmse")) / F.col("_b") * 100).alias("improvement_pct"))
