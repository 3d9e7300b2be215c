"""Small SQL text generators for the DuckDB oracle side."""
from __future__ import annotations

NUMERIC = ("season", "yr", "mnth", "hr", "weekday", "holiday", "workingday", "weathersit",
           "temp", "atemp", "hum", "windspeed", "casual", "registered", "cnt")
INTS = ("season", "yr", "mnth", "hr", "weekday", "holiday", "workingday", "weathersit")
CONT = {"temp": (0.0, 1.0), "atemp": (0.0, 1.0), "hum": (0.0, 1.0), "windspeed": (0.0, 1.0)}
DISC = {"hr": (0, 23), "weekday": (0, 6), "season": (1, 4), "mnth": (1, 12), "weathersit": (1, 4),
        "holiday": (0, 1), "workingday": (0, 1)}
FILT = {**CONT, **DISC, "yr": (0, 1), "cnt": (0, 10000), "casual": (0, 3000), "registered": (0, 8000)}


def nn(expr: str) -> str:
    """NaN -> NULL."""
    return f"(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END)"


def coerced_select(src: str = "dirty") -> str:
    """C1-C3 on the dirty view: trimmed, typed (double/date), NaN -> NULL."""
    parts = ["TRY_CAST(trim(instant) AS BIGINT) AS ord", "TRY_CAST(trim(dteday) AS DATE) AS dteday"]
    parts += [f"{nn(f'TRY_CAST(trim({c}) AS DOUBLE)')} AS {c}" for c in NUMERIC]
    return f"SELECT {', '.join(parts)} FROM {src}"


def filled_select(src: str, cols, order: str = "ord") -> str:
    """C4: forward fill then back fill in ``order``."""
    parts = [order]
    for c in cols:
        parts.append(
            f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")
    return f"SELECT {', '.join(parts)} FROM {src}"


def enforce_sum_cols(a="casual", b="registered", n="cnt") -> str:
    """F2 closed form for non-negative inputs -> casual, registered, cnt."""
    return (f"CAST(CASE WHEN {a} + {b} <= {n} THEN {a} WHEN {n} >= {b} THEN {n} - {b} ELSE {a} END AS BIGINT) AS {a}, "
            f"CAST(CASE WHEN {a} + {b} <= {n} THEN {b} WHEN {n} >= {b} THEN {b} WHEN {n} >= {a} THEN {n} - {a} "
            f"ELSE {b} END AS BIGINT) AS {b}, "
            f"CAST(CASE WHEN {a} + {b} <= {n} THEN {a} + {b} WHEN {n} >= {b} THEN {n} WHEN {n} >= {a} THEN {n} "
            f"ELSE {a} + {b} END AS BIGINT) AS {n}")


def stack_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def kolmogorov_sql(z: str) -> str:
    return (f"(CASE WHEN ({z}) <= 0 THEN 1.0 ELSE least(greatest(2 * list_sum(list_transform(range(1, 101), "
            f"lambda k: pow(-1.0, k - 1) * exp(-2.0 * k * k * ({z}) * ({z})))), 0.0), 1.0) END)")


def erfc_sql(z: str) -> str:
    """erfc by DLMF 7.6.2 (closed terms) below 3 and the continued fraction above."""
    a = f"abs({z})"
    series = (f"(2 / sqrt(pi()) * exp(-{a} * {a}) * list_sum(list_transform(range(0, 81), lambda n: "
              f"exp(n * ln(2 * {a} * {a}) + ln({a}) - (lgamma(2.0 * n + 2) - n * ln(2.0) - lgamma(n + 1.0))))))")
    fraction = (f"list_reduce(list_concat([{a}], list_transform(range(60, 0, -1), lambda k: k / 2.0)), "
                f"lambda acc, h: {a} + h / acc)")
    tail = (f"(CASE WHEN {a} < 1e-150 THEN 1.0 WHEN {a} < 3 THEN 1 - {series} "
            f"ELSE exp(-{a} * {a}) / (sqrt(pi()) * {fraction}) END)")
    return f"(CASE WHEN ({z}) >= 0 THEN {tail} ELSE 2.0 - {tail} END)"


def chi2_sf_sql(x: str, k: str) -> str:
    h = f"(({x}) / 2.0)"
    lh = f"ln(greatest({h}, 1e-300))"
    even = (f"(exp(-{h}) * list_sum(list_transform(range(0, greatest(({k}) // 2 - 1, 0) + 1), "
            f"lambda i: exp(i * {lh} - lgamma(i + 1.0)))))")
    odd_terms = (f"list_sum(list_transform(range(1, greatest((({k}) - 1) // 2, 1) + 1), "
                 f"lambda i: exp((i - 0.5) * {lh} - lgamma(i + 0.5))))")
    odd = f"({erfc_sql(f'sqrt({h})')} + CASE WHEN ({k}) >= 3 THEN exp(-{h}) * {odd_terms} ELSE 0.0 END)"
    res = f"(CASE WHEN ({x}) <= 0 THEN 1.0 WHEN ({k}) % 2 = 0 THEN {even} ELSE {odd} END)"
    return f"least(greatest({res}, 0.0), 1.0)"


def hist_bin_sql(v: str, lo: str, hi: str, bins: int) -> str:
    step = f"(({hi}) - ({lo})) / {bins}"

    def edge(i):
        return f"(CASE WHEN ({i}) >= {bins} THEN ({hi}) ELSE ({i}) * {step} + ({lo}) END)"
    guess = f"least(CAST(floor(({v} - ({lo})) * ({float(bins)} / (({hi}) - ({lo})))) AS INTEGER), {bins - 1})"
    g1 = f"(CASE WHEN {v} < {edge(guess)} THEN {guess} - 1 ELSE {guess} END)"
    g2 = f"(CASE WHEN {v} >= {edge(f'{g1} + 1')} AND {g1} <> {bins - 1} THEN {g1} + 1 ELSE {g1} END)"
    return f"(CASE WHEN {v} >= ({lo}) AND {v} <= ({hi}) THEN {g2} END)"
