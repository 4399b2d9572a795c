import os

import pytest

import corpus_pipeline as P
from glossa.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_on_odd_rows(spark, odd, empty, tmp_dir):
    spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, "some other words that no document here holds at all in this order ever")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for docs in (odd, empty):
        for name, step in P.STAGES[:-1]:
            out = P.stage(step(spark, docs, tmp_dir), name)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            docs = out
        assert P.STAGES[-1][1](spark, docs, tmp_dir).count() == docs.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_registered_queries(spark):
    import __spark_entry__ as E

    names = {int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op")}
    assert names == set(range(1, 14)) and "pipeline" in E.queries()
    assert P.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    from tests.oracle_check import compare
    for name, r in compare(spark, SF, names=list(queries.ORACLE_SQL), verbose=False).items():
        assert r["hash_match"] and r["cols_match"] and "type_diff" not in r, (name, r)
