"""A binding always sees the folder as it is."""

import os
import shutil

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_new_and_missing_languages_lose_no_unit(spark, tmp_dir):
    import __spark_entry__ as E

    root = f"{tmp_dir}/sf"
    shutil.copytree(SF, root)
    os.chmod(root, 0o755)
    count = lambda: sum(r.total_units for r in E.queries()["d1_count_by_level"](spark, root).collect())
    before = count()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    more = docs.limit(10).selectExpr("doc_id + 100000 AS doc_id", "text", "CASE WHEN doc_id % 2 = 0 THEN 'xx' END AS lang", "source", "n_chars")
    os.remove(f"{root}/documents.parquet")
    docs.unionByName(more).write.parquet(f"{root}/documents.parquet")
    assert count() == before + 10
