"""Default parameters of the demand pipeline.

FIXED VALUES (must equal the reference's configuration for equal results):
split fractions 0.70 / 0.15 / 0.15; target column "cnt"; base year 2011;
lags 1, 24, 48, 72, 168 rows; rolling windows 3, 24, 72 rows; cyclical columns
hr, mnth, weekday; interactions (hr, workingday), (temp, hum), (temp, windspeed);
scaler "robust"; scaling exclusions holiday, workingday, season_, weathersit_,
weather_quadrant_, is_peak_hour, is_commute_window; ridge alpha 10; forest 200
trees, depth 15, leaf 5, 0.3 features, 0.8 sample; boosted 300 rounds, depth 4,
step 0.03, subsample 0.7, column sample 0.7, min split gain 0.5, min child
weight 5 (= 5 instances under squared loss), early stop 50; target metrics mae 100, rmse 140,
r2 0.65, mape 35; drift p-value threshold 0.05, PSI threshold 0.25; seed 42.
"""
from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    train_split: float = 0.70
    val_split: float = 0.15
    test_split: float = 0.15
    target_col: str = "cnt"
    exclude_cols: tuple = ("timestamp", "dteday", "cnt", "cnt_transformed",
                           "casual", "registered", "instant")
    base_year: int = 2011
    lags: tuple = (1, 24, 48, 72, 168)
    rolling_windows: tuple = (3, 24, 72)
    cyclical: tuple = ("hr", "mnth", "weekday")
    interactions: tuple = (("hr", "workingday"), ("temp", "hum"), ("temp", "windspeed"))
    volatility: bool = True
    momentum: bool = True
    weather_interactions: bool = True
    scaler: str = "robust"
    scale_exclude: tuple = ("holiday", "workingday", "season_", "weathersit_",
                            "weather_quadrant_", "is_peak_hour", "is_commute_window")
    ridge_alpha: float = 10.0
    rf: dict = field(default_factory=lambda: dict(
        numTrees=200, maxDepth=15, minInstancesPerNode=5,
        featureSubsetStrategy="0.3", subsamplingRate=0.8, bootstrap=True))
    gbt: dict = field(default_factory=lambda: dict(
        maxIter=300, maxDepth=4, stepSize=0.03, subsamplingRate=0.7,
        featureSubsetStrategy="0.7", minInfoGain=0.5, minInstancesPerNode=5))
    gbt_early_stop: int = 50
    rf_grid: dict = field(default_factory=lambda: dict(
        numTrees=[100, 150, 200], maxDepth=[10, 15, 20],
        minInstancesPerNode=[5, 10], featureSubsetStrategy=["0.3", "0.4", "sqrt"]))
    target_metrics: dict = field(default_factory=lambda: dict(
        mae=100.0, rmse=140.0, r2=0.65, mape=35.0))
    drift_threshold: float = 0.05
    psi_threshold: float = 0.25
    seed: int = 42


DEFAULT = Config()

# FIXED VALUES: expected ranges used by range repair / range filter.
# continuous columns are normalised to [0, 1]; discrete columns are clipped.
CONTINUOUS_RANGES = {"temp": (0.0, 1.0), "atemp": (0.0, 1.0),
                     "hum": (0.0, 1.0), "windspeed": (0.0, 1.0)}
DISCRETE_RANGES = {"hr": (0, 23), "weekday": (0, 6), "season": (1, 4),
                   "mnth": (1, 12), "weathersit": (1, 4), "holiday": (0, 1),
                   "workingday": (0, 1)}
# notebook range filter: the above plus yr and the three counts
FILTER_RANGES = {**CONTINUOUS_RANGES, **DISCRETE_RANGES, "yr": (0, 1),
                 "cnt": (0, 10000), "casual": (0, 3000), "registered": (0, 8000)}
# null tokens of the permissive CSV read
NULL_TOKENS = ("", " ", "NA", "N/A", "null", "NULL", "None", "NAN", "NaN", "nan")
NUMERIC_COLS = ("season", "yr", "mnth", "hr", "weekday", "holiday", "workingday",
                "weathersit", "temp", "atemp", "hum", "windspeed", "casual",
                "registered", "cnt")
WEATHER_COLS = ("temp", "atemp", "hum", "windspeed", "weathersit")
