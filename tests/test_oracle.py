"""Every registered query against its DuckDB oracle on the smallest driver data (the driver uses sf0.01)."""

import os

import pytest

from tests.oracle_check import compare

SF = os.environ.get("GLOSSA_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_queries_match_oracle(spark):
    from glossa.plans.queries import QUERIES

    res = compare(spark, SF, names=list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not v.get("hash_match") or not v["cols_match"] or "type_diff" in v}
    assert not bad, bad  # a query without an oracle fails too


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["unit_id", "content_raw", "content_type", "cefr_level", "is_idiom", "difficulty",
                          "variant_confidence", "iso_code", "variant_name", "is_pivot", "tone_name", "theme"]
