"""Many ridge / least-squares fits of one table from additive Gram blocks.

Rows are put into a few *cells*; every training set is a union of cells (a
prefix for expanding windows and learning curves, a complement for folds). One
scan gives per cell the row count, column sums and products of columns, taken
about a common pivot so that large values do not cancel. These add up, so all
sets are solved from the same table of sums, and a second scan scores every
row under every set it belongs to. No row is read once per fit.

Bounds: a task holds cells x (columns + 1)^2 doubles, and the driver the same
once, as the normal-equation solver of Spark ML does for a single fit.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import unpivot, value_cumulative

SCALERS = ("none", "standard", "minmax", "robust")


@dataclass(frozen=True)
class SetFit:
    """A fitted set: prediction = (x - pivot) @ coef + base, in raw units."""
    n: int
    coef: np.ndarray
    base: float
    scale: np.ndarray


def prepare(df: DataFrame, cols, label: str, cells: list[Column], test: Column) -> DataFrame:
    """Columns x0.. (double, NULL and NaN 0), y, c0.. (cell, -1 none), t (test
    set, -1 none). Rows without a label count nowhere."""
    d = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
                  F.col(f"`{label}`").cast("double").alias("y"),
                  *[F.coalesce(c.cast("int"), F.lit(-1)).alias(f"c{i}") for i, c in enumerate(cells)],
                  F.coalesce(test.cast("int"), F.lit(-1)).alias("t")).where(F.col("y").isNotNull())
    return d.fillna(0.0, subset=[f"x{i}" for i in range(len(cols))])


def _width(d: DataFrame, letter: str) -> int:
    return sum(c[0] == letter and c[1:].isdigit() for c in d.columns)


def _matrix(batch, names) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def cell_sums(d: DataFrame) -> tuple[np.ndarray, dict]:
    """(pivot, {cell: (n, sums, products, lowest, highest)}) of the x columns and
    y of ``prepare``'s table, one scan after that for the pivot."""
    names = [f"x{i}" for i in range(_width(d, "x"))] + ["y"]
    where = [f"c{i}" for i in range(_width(d, "c"))]
    row = d.agg(*[F.avg(c) for c in names]).first()
    pivot = np.array([v or 0.0 for v in row], dtype=float)
    size = len(names)
    upper = np.triu_indices(size)

    def sums(batches):
        held = {}
        for b in batches:
            z = _matrix(b, names) - pivot
            for c in where:
                of = b.column(c).to_numpy(zero_copy_only=False)
                for cell in np.unique(of[of >= 0]):
                    part = z[of == cell]
                    new = (len(part), part.sum(0), (part.T @ part)[upper], part.min(0), part.max(0))
                    old = held.get(int(cell))
                    held[int(cell)] = new if old is None else (
                        old[0] + new[0], old[1] + new[1], old[2] + new[2], np.minimum(old[3], new[3]), np.maximum(old[4], new[4]))
        if held:
            order = sorted(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int32()), pa.array([held[c][0] for c in order], pa.int64()),
                 pa.array([np.concatenate(held[c][1:3]).tolist() for c in order], pa.list_(pa.float64())),
                 pa.array([held[c][3].tolist() for c in order], pa.list_(pa.float64())),
                 pa.array([held[c][4].tolist() for c in order], pa.list_(pa.float64()))],
                names=["cell", "n", "added", "low", "high"])

    parts = d.select(*names, *where).mapInArrow(
        sums, "cell int, n long, added array<double>, low array<double>, high array<double>")
    # element by element, so that the merge is a partial aggregate on any number of partitions
    at = F.posexplode(F.transform("added", lambda v, i: F.struct(
        v.alias("a"), F.get("low", i).alias("l"), F.get("high", i).alias("h"),
        F.when(i == 0, F.col("n")).alias("n"))))
    merged = (parts.select("cell", at.alias("i", "e")).groupBy("cell", "i")
              .agg(F.sum("e.a").alias("a"), F.min("e.l").alias("l"), F.max("e.h").alias("h"), F.sum("e.n").alias("n")))
    out = {}
    for r in merged.collect():  # cells x columns^2 / 2 numbers
        cell = out.setdefault(r["cell"], [0, np.zeros(size), np.zeros((size, size)), np.zeros(size), np.zeros(size)])
        i = r["i"]
        if i < size:
            cell[1][i], cell[3][i], cell[4][i] = r["a"], r["l"], r["h"]
            cell[0] += r["n"] or 0
        else:
            j, k = upper[0][i - size], upper[1][i - size]
            cell[2][j, k] = cell[2][k, j] = r["a"]
    return pivot, {c: tuple(v) for c, v in out.items()}


def member(cells: list[Column], wanted) -> Column:
    """Whether a row with these cells belongs to a set of cells."""
    hit = F.lit(False)
    for c in cells:
        hit = hit | c.isin([int(w) for w in wanted])
    return hit


def set_spreads(d: DataFrame, sets, scaled: list[int]) -> dict:
    """{(set, column): exact interquartile range}: one table of value counts
    with a running count per set serves all of them."""
    cells = [F.col(f"c{i}") for i in range(_width(d, "c"))]
    kept = d.select(*[f"x{i}" for i in scaled], *[F.when(member(cells, s), 1).otherwise(0).alias(f"m{k}") for k, s in enumerate(sets)])
    long = unpivot(kept, [f"m{k}" for k in range(len(sets))], [f"x{i}" for i in scaled])
    cum = value_cumulative(long, ["feature"], {f"m{k}": F.sum(f"m{k}") for k in range(len(sets))})

    def quantile(k, p):
        h = (F.col(f"tot_m{k}") - 1) * F.lit(p)
        low = F.min(F.when(F.col(f"cum_m{k}") > F.floor(h), F.col("value")))
        high = F.min(F.when(F.col(f"cum_m{k}") > F.least(F.floor(h) + 1, F.col(f"tot_m{k}") - 1), F.col("value")))
        part = F.max(h - F.floor(h))
        return low + part * (high - low)

    spread = cum.groupBy("feature").agg(*[(quantile(k, 0.75) - quantile(k, 0.25)).alias(f"q{k}") for k in range(len(sets))])
    return {(k, int(r["feature"][1:])): r[f"q{k}"] for r in spread.collect() for k in range(len(sets))}


def fit_sets(d: DataFrame, sets, *, alpha: float = 0.0, scaler: str = "none", scaled: list[int] = ()) -> tuple[np.ndarray, list]:
    """(pivot, a ``SetFit`` per set of cells): ridge with penalty ``alpha`` and
    an unpenalised intercept on columns scaled by statistics of that set alone
    (``scaled``: positions of the scaled columns); 0 is least squares, of the
    smallest norm where columns depend on each other. A set without rows is None."""
    if scaler not in SCALERS:
        raise ValueError(f"Unknown scaler_type: {scaler}")
    pivot, sums = cell_sums(d)
    width = len(pivot) - 1
    spreads = set_spreads(d, sets, list(scaled)) if scaler == "robust" and scaled else {}
    out = []
    for k, cells in enumerate(sets):
        parts = [sums[c] for c in cells if c in sums]
        n = sum(p[0] for p in parts)
        if not n:
            out.append(None)
            continue
        mean = sum(p[1] for p in parts) / n
        centred = sum(p[2] for p in parts) - n * np.outer(mean, mean)
        var = np.maximum(np.diag(centred)[:width], 0.0) / n
        low, high = np.min([p[3] for p in parts], 0)[:width], np.max([p[4] for p in parts], 0)[:width]
        flat = low == high   # a constant column: what is left in the products is rounding
        centred[:width][flat] = 0.0
        centred[:, :width][:, flat] = 0.0
        scale = np.ones(width)
        for i in scaled:
            s = {"standard": 0.0 if flat[i] else np.sqrt(var[i]), "minmax": high[i] - low[i], "robust": spreads.get((k, i)), "none": 1.0}[scaler]
            scale[i] = 1.0 if s is None or abs(s) < 1e-300 else s
        a = centred[:width, :width] / np.outer(scale, scale)
        b = centred[:width, width] / scale
        if alpha:
            w = np.linalg.solve(a + alpha * np.eye(width), b)
        else:
            unit = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
            w = np.linalg.lstsq(a / np.outer(unit, unit), b / unit, rcond=1e-12)[0] / unit
        coef = w / scale
        out.append(SetFit(n, coef, float(mean[width] + pivot[width] - coef @ mean[:width]), scale))
    return pivot, out


def score_sets(d: DataFrame, sets, tests, pivot: np.ndarray, fits, *, train: bool = True, clip_zero: bool = True) -> DataFrame:
    """(set, role, n, mae, rmse, r2): every fitted set on its test rows (t =
    ``tests[set]``) and, with ``train``, on its own rows; predictions are clipped
    at 0. One scan for all sets; r2 is 1 / 0 for a constant target, as M8."""
    names = [f"x{i}" for i in range(len(pivot) - 1)]
    where = [f"c{i}" for i in range(_width(d, "c"))]
    live = [k for k, f in enumerate(fits) if f is not None]
    coef = np.array([fits[k].coef for k in live]).reshape(len(live), len(names))
    base = np.array([fits[k].base for k in live])
    top = max((c for s in sets for c in s), default=0)
    belongs = np.zeros((top + 2, len(live)), dtype=bool)  # the last row: no cell
    for j, k in enumerate(live):
        belongs[list(sets[k]), j] = True
    wanted = np.array([tests[k] for k in live])
    centre = float(pivot[-1])

    def score(batches):
        held = {}
        for b in batches:
            y = b.column("y").to_numpy(zero_copy_only=False)
            p = (_matrix(b, names) - pivot[:-1]) @ coef.T + base
            p = np.maximum(p, 0.0) if clip_zero else p
            t = b.column("t").to_numpy(zero_copy_only=False)
            roles = {"test": t[:, None] == wanted[None, :]}
            if train:
                inside = np.zeros((len(y), len(live)), dtype=bool)
                for c in where:
                    of = b.column(c).to_numpy(zero_copy_only=False)
                    inside |= belongs[np.where((of < 0) | (of > top), top + 1, of)]
                roles["train"] = inside
            for role, hit in roles.items():
                for j in range(len(live)):
                    own = hit[:, j]
                    if not own.any():
                        continue
                    e, v = y[own] - p[own, j], y[own] - centre
                    new = np.array([len(e), np.abs(e).sum(), (e * e).sum(), v.sum(), (v * v).sum(), v.min(), v.max()])
                    old = held.get((live[j], role))
                    if old is not None:
                        new[:5] += old[:5]
                        new[5], new[6] = min(new[5], old[5]), max(new[6], old[6])
                    held[(live[j], role)] = new
        if held:
            keys = sorted(held)
            table = np.array([held[k] for k in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array(table[:, 0].astype("int64"), pa.int64())] + [pa.array(table[:, i], pa.float64()) for i in range(1, 7)],
                names=["set", "role", "n", "ae", "se", "v", "vv", "low", "high"])

    parts = d.select(*names, "y", *where, "t").mapInArrow(
        score, "set int, role string, n long, ae double, se double, v double, vv double, low double, high double")
    s = parts.groupBy("set", "role").agg(*[F.sum(c).alias(c) for c in ("n", "ae", "se", "v", "vv")],
                                         F.min("low").alias("low"), F.max("high").alias("high"))
    spread = F.col("vv") - F.col("v") * F.col("v") / F.col("n")
    r2 = (F.when(F.col("low") < F.col("high"), F.lit(1.0) - F.col("se") / spread)
          .when(F.col("se") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return s.select("set", "role", "n", (F.col("ae") / F.col("n")).alias("mae"),
                    F.sqrt(F.col("se") / F.col("n")).alias("rmse"), r2.alias("r2"))
