import numpy as np
import pytest

from glossa.operators import retrieval
from glossa.operators.vector_store import read_store, similar_in_store, write_store

SCHEMA = "vector_id long, unit_id long, model_id int, embedding array<float>"


def clustered(n=1200, dim=8, seed=1):
    """Whole-numbered vectors around few centres (scores are exact, so ties are ties), every tenth repeated."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-40, 40, (12, dim))
    rows = []
    for i in range(n):
        v = centres[i % 12] + rng.integers(-3, 4, dim) if i % 10 or not rows else rows[-1][3]
        rows.append((i, i + 5000, i % 3 + 1 if i % 97 else None, [float(x) for x in v]))
    return rows


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors") / "store")
    rows = clustered()
    odd = [(9001, 1, 1, None), (9002, 2, 1, [1.0, 2.0]), (9003, 3, 1, [float("nan")] * 8), (9004, 4, 1, [None] + [1.0] * 7)]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    write_store(frame, path, clusters=24)
    return path, frame, rows


def brute(rows, queries, k, model):
    out = set()
    for q, e in queries:
        hits = sorted(((-sum(a * b for a, b in zip(v, e)), i) for i, _, m, v in rows if m == model))[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(hits, 1)}
    return out


@pytest.mark.parametrize("k,block", [(1, None), (5, 4), (37, None), (1000, None)])
def test_equal_to_brute_force_with_ties(spark, store, k, block):
    path, frame, rows = store
    queries = [(i, rows[i * 53][3]) for i in range(9)] + [(50, [0.0] * 8)]  # every vector ties for the last
    hits, report = similar_in_store(spark.createDataFrame(queries, "query_id long, embedding array<double>"), path,
                                    frame.schema, k, 2, block)
    assert {(r.query_id, r.rank, r.vector_id, r.score) for r in hits.collect()} == brute(rows, queries, k, 2)
    assert report["pairs"] == len(queries) * sum(r[2] == 2 for r in rows) and report["scored"] <= report["pairs"]


def test_clusters_are_skipped(spark, store):
    path, frame, rows = store
    queries = spark.createDataFrame([(i, rows[i * 53][3]) for i in range(9)], "query_id long, embedding array<double>")
    _, report = similar_in_store(queries, path, frame.schema, 5, 1)
    assert report["scored"] < 0.5 * report["pairs"]


def test_only_the_models_files_are_read(spark, store):
    path, frame, rows = store
    scope = retrieval.model_scope(read_store(spark, path, frame.schema), 3)
    plan = scope._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_id" in plan and "PushedFilters: []" in plan
    assert {r.vector_id for r in scope.collect()} == {r[0] for r in rows if r[2] == 3}


def test_every_vector_is_stored(spark, store):
    path, frame, rows = store
    back = read_store(spark, path, frame.schema)
    assert back.count() == len(rows) + 4
    assert {r.vector_id for r in back.where("cluster = -1").collect()} == {9001, 9002, 9003, 9004}


def test_odd_searches(spark, store, tmp_path):
    path, frame, _ = store
    none = spark.createDataFrame([(1, None)], "query_id long, embedding array<double>")
    assert similar_in_store(none, path, frame.schema, 5, 1)[0].count() == 0
    one = spark.createDataFrame([(1, [1.0] * 8)], "query_id long, embedding array<double>")
    assert similar_in_store(one, path, frame.schema, 5, 77)[0].count() == 0
    with pytest.raises(ValueError, match="dimensions"):
        similar_in_store(spark.createDataFrame([(1, [1.0])], one.schema), path, frame.schema, 5, 1)
    write_store(frame.where("false"), str(tmp_path / "empty"))
    assert similar_in_store(one, str(tmp_path / "empty"), frame.schema, 5, 1)[0].count() == 0
