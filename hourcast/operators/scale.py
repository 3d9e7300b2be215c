"""Scaling and matrix preparation (P3s-P9s)."""
from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT
from ..plans.quantiles import quantile_map

KINDS = ("standard", "robust", "minmax", "quantile", "none")


def feature_columns(df: DataFrame, cfg=DEFAULT, context=("dteday",)) -> list:
    """P3s: all columns minus the excluded ones (plus context columns)."""
    drop = set(cfg.exclude_cols) | {"series_id", "row_id", "row_idx", "split"}
    cols = [c for c in df.columns if c not in drop]
    return cols + [c for c in context if c in df.columns and c not in cols]


def split_scale_columns(cols, exclude=DEFAULT.scale_exclude, match="substring") -> tuple[list, list]:
    """P5s / F10: columns excluded from scaling by substring (library) or prefix
    (notebook); returns (scaled, not_scaled) keeping input order."""
    def hit(c):
        return any((p in c) if match == "substring" else c.startswith(p) for p in exclude)
    return [c for c in cols if not hit(c)], [c for c in cols if hit(c)]


@dataclass(frozen=True)
class ScalerModel:
    kind: str
    scale_cols: tuple
    keep_cols: tuple
    center: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    quantiles: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, *, passthrough=()) -> DataFrame:
        """Scaled columns first, then the unscaled ones (P5s order)."""
        missing = [c for c in self.scale_cols + self.keep_cols if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns {missing}")
        if self.kind == "none":
            scaled = [F.col(f"`{c}`") for c in self.scale_cols]
        elif self.kind == "quantile":
            df = _uniform(df, self.quantiles)
            scaled = [F.col(f"`{c}`") for c in self.scale_cols]
        else:
            scaled = [((F.col(f"`{c}`").cast("double") - F.lit(self.center[c])) / F.lit(self.scale[c])).alias(c)
                      for c in self.scale_cols]
        return df.select(*[F.col(f"`{c}`") for c in passthrough], *scaled,
                         *[F.col(f"`{c}`") for c in self.keep_cols])

    def to_df(self, spark) -> DataFrame:
        """One row of statistics per scaled column."""
        rows = [(c, float(self.center.get(c, 0.0)), float(self.scale.get(c, 1.0)),
                 [float(q) for q in self.quantiles[c]] if c in self.quantiles else None) for c in self.scale_cols]
        return spark.createDataFrame(rows, "feature string, center double, scale double, quantiles array<double>")

    def about(self) -> dict:
        """What the statistics table does not hold: kind and column order."""
        return {"kind": self.kind, "scale_cols": list(self.scale_cols), "keep_cols": list(self.keep_cols)}

    @classmethod
    def from_df(cls, df: DataFrame, about: dict) -> "ScalerModel":
        rows = df.collect()
        fitted = about["kind"] in ("standard", "robust", "minmax") and rows
        return cls(about["kind"], tuple(about["scale_cols"]), tuple(about["keep_cols"]),
                   {r["feature"]: r["center"] for r in rows} if fitted else {},
                   {r["feature"]: r["scale"] for r in rows} if fitted else {},
                   {r["feature"]: list(r["quantiles"]) for r in rows if r["quantiles"] is not None})


class Scaler:
    """P4s: fit on train (one statistics job), transform anywhere (pure plan).

    standard: (x - mean) / population std; robust: (x - median) / IQR with
    exact linear quantiles; minmax: (x - min) / (max - min); zero spread -> 1;
    quantile (X8): piecewise-linear map of ``n_quantiles`` train quantiles onto
    [0, 1] (uniform output; tied quantiles take the lower level).
    ``exact=False`` uses approximate quantiles for robust.
    """

    def __init__(self, kind: str = DEFAULT.scaler, exclude=DEFAULT.scale_exclude, match="substring",
                 exact: bool = True, n_quantiles: int = 1000):
        if kind not in KINDS:
            raise ValueError(f"Unknown scaler_type: {kind}")
        self.kind, self.exclude, self.match, self.exact = kind, tuple(exclude), match, exact
        self.n_quantiles = n_quantiles

    def fit(self, train: DataFrame, cols) -> ScalerModel:
        sc, keep = split_scale_columns(list(cols), self.exclude, self.match)
        if self.kind == "none" or not sc:
            return ScalerModel(self.kind, tuple(sc), tuple(keep))
        x = {c: F.col(f"`{c}`").cast("double") for c in sc}
        if self.kind == "standard":
            row = train.agg(*[F.avg(x[c]).alias(f"m_{c}") for c in sc],
                            *[F.stddev_pop(x[c]).alias(f"s_{c}") for c in sc]).first()
            center = {c: row[f"m_{c}"] for c in sc}
            scale = {c: row[f"s_{c}"] for c in sc}
        elif self.kind == "minmax":
            row = train.agg(*[F.min(x[c]).alias(f"m_{c}") for c in sc],
                            *[F.max(x[c]).alias(f"s_{c}") for c in sc]).first()
            center = {c: row[f"m_{c}"] for c in sc}
            scale = {c: (row[f"s_{c}"] - row[f"m_{c}"]) if row[f"m_{c}"] is not None else None for c in sc}
        elif self.kind == "quantile":
            probs = [i / (self.n_quantiles - 1) for i in range(self.n_quantiles)]
            q = quantile_map(train, sc, probs, approx=not self.exact)
            qs = {c: [q[(c, float(p))] for p in probs] for c in sc}
            return ScalerModel(self.kind, tuple(sc), tuple(keep), quantiles=qs)
        else:
            q = quantile_map(train, sc, [0.25, 0.5, 0.75], approx=not self.exact)
            center = {c: q[(c, 0.5)] for c in sc}
            scale = {c: (q[(c, 0.75)] - q[(c, 0.25)]) if q[(c, 0.25)] is not None else None for c in sc}
        center = {c: (0.0 if v is None else float(v)) for c, v in center.items()}
        scale = {c: (1.0 if (v is None or abs(v) < 1e-300) else float(v)) for c, v in scale.items()}
        return ScalerModel(self.kind, tuple(sc), tuple(keep), center, scale)


def align_columns(df: DataFrame, required, *, extra="drop") -> DataFrame:
    """P6s: required columns must exist (error otherwise), extras dropped, order fixed."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in required])


def fill_zero(df: DataFrame, cols=None) -> DataFrame:
    """P8s: serving fill -- NULL features become 0."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(0.0, subset=list(cols)) if cols else df


def sample_rows(df: DataFrame, k: int, seed: int = DEFAULT.seed, key_cols=("series_id", "row_id")) -> DataFrame:
    """P9s: seeded sample of k rows without replacement: the k smallest
    ``xxhash64(key, seed)`` (TakeOrdered: bounded per-partition top-k)."""
    h = F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed))
    return df.withColumn("_h", h).orderBy("_h", *key_cols).limit(k).drop("_h")


def sample_fraction(df: DataFrame, fraction: float, seed: int = DEFAULT.seed,
                    key_cols=("series_id", "row_id"), with_replacement: bool = False) -> DataFrame:
    """P9s: fractional sample by a hash of the key, so partitioning plays no
    part. With replacement a row is repeated by the Poisson law (mean
    ``fraction``), its quantile read at the hash."""
    u = F.pmod(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    if not with_replacement:
        return df.where(u < fraction)
    steps, p, total, k = [], math.exp(-fraction), 0.0, 0
    while total + p < 1 - 2.0 ** -31 and k < 1000:  # cumulative law up to the finest hash value
        total += p
        steps.append(total)
        k += 1
        p *= fraction / k
    times = F.size(F.filter(F.array(*[F.lit(x) for x in steps]), lambda x: x <= u))
    return df.withColumn("_times", times).where("_times > 0").withColumn(
        "_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def _uniform(df: DataFrame, quantiles: dict) -> DataFrame:
    """Each column of ``quantiles`` mapped through its knots (knots[i], i / (m-1))
    piecewise linearly, clipped to [0, 1]; at tied knots the last one counts.
    The knot below a value is found by binary search (Bucketizer)."""
    out = df
    for c, knots in quantiles.items():
        values = sorted(set(knots))
        last = {v: i for i, v in enumerate(knots)}
        x, top = F.col(f"`{c}`").cast("double"), float(len(knots) - 1)
        if len(values) < 3:  # too few for buckets: at most one stretch
            rise = (x - F.lit(values[0])) / F.lit(values[-1] - values[0] or 1.0)
            inner = (F.lit(float(last[values[0]])) + rise) / F.lit(top or 1.0)
        else:
            find = Bucketizer(splits=[-math.inf, *values, math.inf], inputCol="_x", outputCol="_b", handleInvalid="keep")
            out = find.transform(out.withColumn("_x", F.coalesce(x, F.lit(values[0]))))
            at = F.col("_b").cast("int")  # knots at or below the value, never 0 where it matters
            pick = lambda own, i: F.get(F.array(*[F.lit(float(v)) for v in own]), i)
            low, high = pick(values, at - 1), pick(values, at)
            inner = (pick([last[v] for v in values], at - 1) + (x - low) / (high - low)) / F.lit(top)
        level = (F.when(x.isNull(), F.lit(None).cast("double")).when(x <= F.lit(values[0]), F.lit(0.0))
                 .when(x >= F.lit(values[-1]), F.lit(1.0)).otherwise(inner))
        out = out.withColumn(c, level).drop("_x", "_b")
    return out
