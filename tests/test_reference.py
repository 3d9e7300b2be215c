"""A stored drift reference: checks against it equal checks against its rows."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from hourcast.operators import reference as R
from hourcast.operators.drift import REPORT_COLS, detect_drift
from hourcast.streaming import streams as ST


def _rows(rng, n, low, high):
    x = rng.integers(low, high, n).astype(float)
    return [(float(v) if i % 11 else None, float(rng.normal(low, 3)) if i % 13 else float("nan"),
             [None, "a", "b", "c"][int(rng.integers(0, 4))], i % 4) for i, v in enumerate(x)]


SCHEMA = "x double, z double, kind_of string, day int"


def _same(a, b):
    a, b = ({r["feature"]: r for r in d.collect()} for d in (a, b))
    assert set(a) == set(b)
    for f in a:
        for c in REPORT_COLS:
            u, v = a[f][c], b[f][c]
            if isinstance(v, float):
                np.testing.assert_allclose(u, v, rtol=1e-9, atol=1e-12, err_msg=f"{f} {c}")
            else:
                assert u == v, (f, c)


@pytest.mark.parametrize("low,high", [(-30, 90), (200, 220), (-90, -80)])
def test_stored_reference_equals_its_rows(spark, tmp_path, low, high):
    """Values around, above and below the reference; ranges of a few values."""
    rng = np.random.default_rng(11)
    ref = spark.createDataFrame(_rows(rng, 300, 0, 60), SCHEMA)
    cur = spark.createDataFrame(_rows(rng, 200, low, high), SCHEMA)
    stored = R.write_reference(R.summarise(ref, ["x", "z"], ["kind_of"]), str(tmp_path), rows_per_block=7)
    assert stored.ranges.where("feature = 'x'").count() > 3
    _same(R.check_drift(stored, cur, ["x", "z"], ["kind_of"]), detect_drift(ref, cur, ["x", "z"], ["kind_of"]))


def test_days_add_up(spark, tmp_path):
    rng = np.random.default_rng(12)
    ref = spark.createDataFrame(_rows(rng, 200, 0, 30), SCHEMA)
    days = R.summarise(ref, ["x"], ["kind_of"], by=["day"])
    parts = [days.where(F.col("day") == d) for d in range(4)]
    key = ["feature", "kind", "value", "category", "n"]
    whole = R.summarise(ref, ["x"], ["kind_of"])
    assert sorted(map(str, R.merge(*parts).select(key).collect())) == sorted(map(str, whole.select(key).collect()))
    # without its first day: the same as a reference built from the other days
    cur = spark.createDataFrame(_rows(rng, 100, 5, 35), SCHEMA)
    late = R.write_reference(R.merge(*parts[1:]), str(tmp_path))
    _same(R.check_drift(late, cur, ["x"], ["kind_of"]), detect_drift(ref.where("day > 0"), cur, ["x"], ["kind_of"]))


def test_empty_sides_give_no_rows(spark, tmp_path):
    rng = np.random.default_rng(13)
    some, none = spark.createDataFrame(_rows(rng, 50, 0, 9), SCHEMA), spark.createDataFrame([], SCHEMA)
    for i, (a, b) in enumerate(((some, none), (none, some))):
        stored = R.write_reference(R.summarise(a, ["x"]), str(tmp_path / str(i)))
        assert R.check_drift(stored, b, ["x"]).count() == detect_drift(a, b, ["x"]).count() == 0
    assert R.check_drift(stored, some, ["absent"]).count() == 0


def test_monitor_does_not_scan_the_reference(spark, tmp_path):
    """Micro-batches check against the summary: the reference's rows may be gone by then."""
    rng = np.random.default_rng(14)
    ref = spark.createDataFrame(_rows(rng, 120, 0, 20), SCHEMA)
    stored = R.write_reference(R.summarise(ref, ["x"], ["kind_of"]), str(tmp_path / "ref"))
    batches = [spark.createDataFrame(_rows(rng, 80, lo, lo + 20), SCHEMA) for lo in (0, 50)]
    for b in batches:
        b.coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    log = ST.stream_monitor(stream, stored, ["x"], ["kind_of"], path=str(tmp_path / "log"))
    assert log.count() == 4
    for i, b in enumerate(batches):
        _same(log.where(F.col("batch_id") == i).select(*REPORT_COLS), detect_drift(ref, b, ["x"], ["kind_of"]))
    assert log.where("feature = 'x' AND batch_id = 1").first()["has_drift"] is True
    read = R.check_drift(stored, batches[0], ["x"], ["kind_of"]).inputFiles()
    assert any("/ref/values/" in f for f in read) and not any("/ref/summary/" in f for f in read)
