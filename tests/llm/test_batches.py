"""What Python is handed at once is bounded in rows and bytes, whatever the batches of the session."""

import pyarrow as pa
import pytest

from glossa.llm import minhash_dedup, substring_dedup
from glossa.llm.common import BATCH_ROWS, gathered, stage


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})


def test_stage_bounds_the_rows_of_a_batch_and_leaves_the_session_as_it_was(spark):
    usual = spark.conf.get(BATCH_ROWS)
    rows = spark.range(0, 5000, 1, 1)
    got = [r.n for r in stage(rows.mapInArrow(sizes, "n long"), "sizes", 100).collect()]
    assert sum(got) == 5000 and max(got) == 100
    assert spark.conf.get(BATCH_ROWS) == usual
    with pytest.raises(Exception):
        stage(rows.selectExpr("raise_error('no') AS x"), "broken", 100)
    assert spark.conf.get(BATCH_ROWS) == usual
    try:  # a smaller bound of the session holds
        spark.conf.set(BATCH_ROWS, "7")
        assert max(r.n for r in stage(rows.mapInArrow(sizes, "n long"), "sizes", 100).collect()) == 7
    finally:
        spark.conf.set(BATCH_ROWS, usual)


def test_small_batches_are_put_together():
    texts = [None, "", "abc", "x" * 50, *["word"] * 30]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": pa.array([t], pa.string())}) for i, t in enumerate(texts)]
    got = list(gathered(iter(batches), "text", 20))
    assert [r for b in got for r in b.column("text").to_pylist()] == texts
    assert len(got) < 12 and all(b.num_rows == 1 or sum(len(t or "") for t in b.column("text").to_pylist()) <= 20 for b in got)
    assert list(gathered(iter([]), "text", 20)) == []


@pytest.mark.parametrize("module, run, python_jobs", [(substring_dedup, "dedup_substrings", {"answers", "runs", "kept"}),
                                                      (minhash_dedup, "near_duplicates", {"signatures", "links", "closer", "rest"})])
def test_jobs_with_wide_rows_bound_their_batches(spark, monkeypatch, module, run, python_jobs):
    bounds = {}

    def recorded(df, tag, batch_rows=None):
        bounds.setdefault(tag, set()).add(batch_rows)
        return stage(df, tag, batch_rows)

    monkeypatch.setattr(module, "stage", recorded)
    docs = spark.createDataFrame([(i, " ".join(f"w{j % 23}" for j in range(i, i + 30))) for i in range(40)], "doc_id long, text string")
    assert getattr(module, run)(docs).count() == 40
    assert python_jobs <= set(bounds)
    assert all(0 < (b or 0) <= 2048 for tag in python_jobs for b in bounds[tag])
