from pyspark.sql import functions as F

from glossa.operators import aggregates as agg
from glossa.operators import context, joins
from glossa.operators.keys import assign_ids


def test_not_in_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    plain = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert joins.not_in(left, with_null, "k").count() == 0
    assert sorted(r.k for r in joins.not_in(left, plain, "k").collect()) == [2]
    assert sorted((r.k for r in joins.not_in(left, empty, "k").collect()), key=lambda x: (x is None, x)) == [1, 2, None]


def test_orphans_dangling_vs_null(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert [r.id for r in joins.orphans(child, "fk", parent, "pk").collect()] == [3]


def test_view_fan_out_and_scoping(spark):
    t = {
        "content_unit": spark.createDataFrame(
            [(1, "x", "phrase", "A1", False, None, 0.9, 1), (2, "y", "phrase", "A2", False, None, None, None)],
            "unit_id long, content_raw string, content_type string, cefr_level string, is_idiom boolean, "
            "difficulty string, variant_confidence double, variant_id int"),
        "language_variant": spark.createDataFrame([(1, "it-IT", "Standard Italian", False)],
                                                  "variant_id int, iso_code string, variant_name string, is_pivot boolean"),
        "rel_content_tone": spark.createDataFrame([(1, 1), (1, 2)], "unit_id long, tone_id int"),
        "tone_marker": spark.createDataFrame([(1, "a"), (2, "b")], "tone_id int, tone_name string"),
        "rel_content_context": spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "unit_id long, context_id int"),
        "cultural_context_tag": spark.createDataFrame([(1, "t1"), (2, "t2"), (3, "t3")],
                                                      "context_id int, context_name string"),
    }
    full = context.full_context(t)
    assert full.count() == 6  # 2 tones x 3 themes; unit without variant dropped
    student = context.scoped_context(t, "authenticated", "student").collect()
    assert len(student) == 1 and student[0].tone_name is None and student[0].theme is None
    assert context.scoped_context(t, "anon").count() == 6
    assert context.scoped_context(t, "authenticated", "admin").count() == 6
    assert context.scoped_context(t, "authenticated", None).count() == 0  # missing claim: no rows
    assert context.scoped_context(t, "service").count() == 0


def test_policy_matrix(spark):
    m = {r["table"]: r for r in context.policy_matrix(spark).collect()}
    assert m["content_unit"]["authenticated:student"] is True
    assert m["tone_marker"]["authenticated:student"] is False
    assert m["ai_model_registry"]["anon"] is False
    assert m["ai_model_registry"]["authenticated:admin"] is True
    assert all(r["service"] is False for r in m.values())


def test_variant_roots_chain_cycle_and_dangling(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 6), (8, 7), (9, 8),  # chain of depth 8
            (20, 21), (21, 20), (22, 20),                                           # cycle + node under it
            (30, 999)]                                                              # dangling parent
    tree = spark.createDataFrame(rows, "variant_id int, parent_variant_id int")
    got = {r.variant_id: (r.root_id, r.depth, r.in_cycle) for r in joins.variant_roots(tree).collect()}
    assert got[9] == (1, 8, False) and got[1] == (1, 0, False) and got[5] == (1, 4, False)
    assert got[20] == (None, None, True) and got[22] == (None, None, True)
    assert got[30] == (30, 0, False)


def test_shared_roots_counts_dangling_variants_like_the_subquery(spark):
    lemmas = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("b", 7), ("c", 1), ("C", 2)],
                                   "text_root string, variant_id int")
    variants = spark.createDataFrame([(1, "IT"), (2, "FI")], "variant_id int, variant_name string")
    got = {r.text_root: r.shared_by for r in agg.shared_roots(lemmas, variants).collect()}
    # 'a': IT twice (no DISTINCT), sorted; 'b': two ids (7 dangling) but only IT is named; case-sensitive roots
    assert got == {"a": "FI | IT | IT", "b": "IT"}


def test_assign_ids_is_a_dense_total_order_at_any_partitioning(spark):
    import random
    keys = [(p, v) for p in range(300) for v in (1, 2, 3) if (p * 7 + v) % 5]
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame(keys, "doc_pos long, variant_id int")
    expected = {k: i + 1 for i, k in enumerate(sorted(keys))}
    for parts in (1, 3, 7):
        got = {(r.doc_pos, r.variant_id): r.id
               for r in assign_ids(df.repartition(5), ["doc_pos", "variant_id"], "id", 1, parts).collect()}
        assert got == expected
    shifted = assign_ids(df, ["doc_pos", "variant_id"], "id", 101).agg(F.min("id"), F.max("id")).first()
    assert tuple(shifted) == (101, 100 + len(keys))


def test_pivot_pairs_keep_missing_legs(spark):
    units = spark.createDataFrame([(1, "a", 1, "ciao"), (2, "a", 3, "hi"), (3, "b", 1, "sì")],
                                  "unit_id long, doc_id string, variant_id int, content_raw string")
    got = sorted(tuple(r) for r in joins.pivot_pairs(units, 1, 3, 2).collect())
    assert got == [("a", 1, "ciao", 2, "hi", None, None), ("b", 3, "sì", None, None, None, None)]


def test_ordered_string_agg(spark):
    df = spark.createDataFrame([("t", "b", 2), ("t", "a", 1), ("t", None, 3), ("u", "z", 1)],
                               "k string, col string, pos int")
    got = {r.k: r.s for r in df.groupBy("k").agg(agg.ordered_string_agg("col", "pos", ", ").alias("s")).collect()}
    assert got == {"t": "a, b", "u": "z"}


def test_with_defaults(spark):
    from glossa.operators.maintain import with_defaults
    log = spark.createDataFrame([(1, None)], "log_id long, training_cycle int")
    r = with_defaults(log, "correction_feedback_log").first()
    assert r.feedback_source == "database_out" and r.training_cycle is None and r.model_id is None


def test_similar_top_k_is_exact_with_ties(spark):
    from glossa.operators.retrieval import similar
    vecs = spark.createDataFrame([(i, 100 + i, 1, [1.0, 0.0] if i % 2 == 0 else [0.5, 0.0]) for i in range(20)],
                                 "vector_id long, unit_id long, model_id int, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(7, [1.0, 0.0])], "query_id long, embedding array<double>")
    got = [(r["rank"], r.vector_id) for r in similar(queries, vecs, 3, model_id=1).orderBy("rank").collect()]
    assert got == [(1, 0), (2, 2), (3, 4)]  # ten vectors tie at the top score: smallest ids win


def test_similar_handles_any_number_of_queries_in_blocks(spark):
    from glossa.operators.retrieval import similar
    vecs = spark.createDataFrame([(i, i, 1, [float(i % 7), 1.0]) for i in range(30)],
                                 "vector_id long, unit_id long, model_id int, embedding array<float>")
    queries = spark.createDataFrame([(q, [1.0, float(q)]) for q in range(5)], "query_id long, embedding array<double>")
    one = {(r.query_id, r["rank"], r.vector_id) for r in similar(queries, vecs, 2).collect()}
    chunked = {(r.query_id, r["rank"], r.vector_id) for r in similar(queries, vecs, 2, block_queries=2).collect()}
    assert one == chunked and len(one) == 10
