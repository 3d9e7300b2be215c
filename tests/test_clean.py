"""Cleaning: the reference's structural assertions + closed forms F1 / F2."""
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import clean as C
from hourcast.sources import adapters as A


def _reference_rule(c, r, n):
    """The minimal-change rule as stated: candidates sorted by (change, largest component)."""
    cands = [(abs(c + r - n), max(c, r, c + r), c, r, c + r)]
    if n - r >= 0:
        cands.append((abs(n - r - c), max(n - r, r, n), n - r, r, n))
    if n - c >= 0:
        cands.append((abs(n - c - r), max(c, n - c, n), c, n - c, n))
    _, _, a, b, t = sorted(cands, key=lambda x: (x[0], x[1]))[0]
    return max(0, a), max(0, b), max(0, t)


def test_sum_repair_matches_rule(spark):
    triples = list(itertools.product(range(-3, 13), repeat=3))
    df = spark.createDataFrame(triples, "casual long, registered long, cnt long")
    got = {tuple(r[:3]): tuple(r[3:]) for r in C.enforce_sum(df.withColumns(
        {"c0": F.col("casual"), "r0": F.col("registered"), "n0": F.col("cnt")})).select(
        "c0", "r0", "n0", "casual", "registered", "cnt").collect()}
    for t in triples:
        assert got[t] == _reference_rule(*t), t


def test_range_repair_is_clip(spark):
    xs = [-2.0, -0.1, -0.05, 0.0, 0.5, 1.0, 1.05, 1.1, 3.0]
    df = spark.createDataFrame([(x, x, x, x) for x in xs], "temp double, atemp double, hum double, windspeed double")
    out = C.repair_ranges(df).toPandas()
    np.testing.assert_allclose(out["temp"], np.clip(xs, 0, 1))
    audit = {r["feature"]: r for r in C.range_audit(df).collect()}
    assert audit["temp"]["n_invalid"] == 6 and audit["temp"]["renormalised"] == 4
    assert audit["temp"]["clipped_min"] == 1 and audit["temp"]["clipped_max"] == 1


def test_clean_chain_on_dirty(spark):
    raw = A.dirty(spark, "/root/testdata/sf0.01")
    out = C.clean(raw)
    assert "instant" not in out.columns and "mixed_type_col" not in out.columns
    assert dict(out.dtypes)["hr"] == "int" and dict(out.dtypes)["temp"] == "double"
    s = C.validation_summary(out).first()
    assert s["null_cells"] == 0 and s["sum_mismatches"] == 0
    assert out.agg(F.max("hr"), F.max("weathersit"), F.max("temp")).first() == (23, 4, 1.0)


def test_validate_errors(spark, hourly_fixture):
    df, _ = hourly_fixture
    with pytest.raises(ValueError, match="null"):
        C.validate_clean(df.withColumn("temp", F.when(F.col("row_id") < 10, None).otherwise(F.col("temp"))))
    with pytest.raises(ValueError, match="Target"):
        C.validate_clean(df.drop("cnt"))
    with pytest.raises(ValueError, match="Too few"):
        C.validate_clean(C.enforce_sum(df.limit(50)))


def test_fill_then_no_nulls(spark, hourly_fixture):
    df, _ = hourly_fixture
    d = df.withColumns({"temp": F.when(F.col("row_id") <= 10, None).otherwise(F.col("temp")),
                        "hum": F.when(F.col("row_id").between(5, 15), None).otherwise(F.col("hum"))})
    f = C.fill_nulls(d, ["temp", "hum"], order=("row_id",))
    assert f.where(F.col("temp").isNull() | F.col("hum").isNull()).count() == 0
    first_temp = df.where("row_id = 11").first()["temp"]
    assert f.where("row_id = 0").first()["temp"] == first_temp   # back fill of the leading gap


def test_null_report_and_value_counts(spark, hourly_fixture):
    df, pdf = hourly_fixture
    vc = {r["weathersit"]: r["share"] for r in C.value_counts(df, "weathersit", normalize=True).collect()}
    exp = pdf["weathersit"].value_counts(normalize=True).to_dict()
    for k, v in exp.items():
        assert vc[k] == pytest.approx(v)
    nr = {r["feature"]: r["null_count"] for r in C.null_report(df).collect()}
    assert nr["temp"] == 0 and nr["__rows_with_any_null__"] == 0


def test_no_row_is_lost_without_a_valid_instant(spark):
    raw = A.dirty(spark, "/root/testdata/sf0.001")
    raw = raw.withColumn("o", F.expr("try_cast(instant as long)")).coalesce(1).sortWithinPartitions("o").drop("o")
    want = C.clean(raw).drop("row_id")
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(C.clean(raw.drop("instant")).drop("row_id")) == rows(want)
    broken = raw.withColumn("instant", F.when(F.col("instant").cast("long") % 10 == 0, F.lit(None)).otherwise(F.col("instant")))
    out = C.clean(broken)
    assert rows(out.drop("row_id")) == rows(want)
    assert sorted(r.row_id for r in out.select("row_id").collect()) == list(range(1, out.count() + 1))


def test_sum_that_cannot_be_enforced_is_an_error(spark):
    df = spark.createDataFrame([(1, 2, 3), (None, None, 4)], "casual long, registered long, cnt long")
    with pytest.raises(ValueError, match="cannot be enforced on 1 rows"):
        C.require_sum(C.impute_sum_parts(df))
    assert C.validation_summary(df).first()["sum_mismatches"] == 1
