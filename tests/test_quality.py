import pytest

from airmart.operators import quality
from tests.helpers import at, table


def rows(spark, *hs):
    return table(spark, "weather", [{"h": h} for h in hs])


def test_duplicate_keys_ignore_nulls(spark):
    got = quality.duplicate_keys(rows(spark, 1, 1, 2, None, None), ["OBSERVATION_TIME"]).collect()
    assert [(r.OBSERVATION_TIME, r.n_rows) for r in got] == [(at(1), 2)]


def test_null_rows(spark):
    assert quality.null_rows(rows(spark, 1, None), "OBSERVATION_TIME").count() == 1


def test_check_keys(spark):
    got = {r.check: r.failures for r in quality.check_keys("m", rows(spark, 1, 1, 2, None)).collect()}
    assert got == {"unique": 1, "not_null": 1}
    got = {r.check: r.failures for r in quality.check_keys("m", rows(spark)).collect()}
    assert got == {"unique": 0, "not_null": 0}


def test_gate(spark):
    quality.gate({"a": rows(spark, 1, 2), "b": rows(spark, 3)})
    with pytest.raises(quality.QualityError, match="b: unique failed on 1"):
        quality.gate({"a": rows(spark, 1, 2), "b": rows(spark, 3, 3)})
