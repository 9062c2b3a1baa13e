"""Evidence of offending rows."""

import pytest

from accordium.operators.quarantine import evidence


@pytest.mark.parametrize("name", ["owner", "run_ts", "row_fingerprint"])
def test_source_columns_named_like_evidence(spark, name):
    rows = spark.createDataFrame([(1, "x", "rule")], f"id int, {name} string, expectation string")
    with pytest.raises(ValueError, match=name):
        evidence(rows, {"dataset": "d"})
