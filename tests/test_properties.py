"""Order independence, and what must hold of the units of any corpus."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from glossa.plans.ingest import build_content
from glossa.sources.bindings import docs_from

PHRASE = "doc_pos long, doc_id string, text_it string, text_fi string, text_en string"

texts = st.one_of(st.none(), st.sampled_from(["", " ", "casa", "Casa", "talo", "house", "x y", " a"]))


def expected(docs):
    """Units by their definition: each different (text, variant) once, at its earliest place, numbered by place."""
    places = {(text, v): [(i, v) for i, langs in enumerate(docs) if langs[v - 1] == text]
              for langs in docs for v, text in enumerate(langs, 1) if text}
    ranked = sorted(places, key=lambda unit: min(places[unit]))
    return [(ranked.index(unit) + 1, *unit, f"d{min(places[unit])[0]}") for unit in ranked]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(texts, texts, texts), min_size=1, max_size=12), st.integers(1, 5))
def test_units_are_the_first_occurrences(spark, docs, parts):
    rows = [(i, f"d{i}", a, b, c) for i, (a, b, c) in enumerate(docs)]
    df = spark.createDataFrame(rows, PHRASE).repartition(parts)
    got = sorted((u.unit_id, u.content_raw, u.variant_id, u.doc_id) for u in build_content(df).units.collect())
    assert got == expected(docs)


def test_ingestion_is_order_independent(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    a = build_content(docs_from(part.repartition(7))).units
    b = build_content(docs_from(part.orderBy("p_name").repartition(2))).units
    key = ["unit_id", "content_hash", "doc_id", "variant_id"]
    assert sorted(map(tuple, a.select(key).collect())) == sorted(map(tuple, b.select(key).collect()))


def test_hot_key_first_wins(spark):
    from pyspark.sql import functions as F

    from glossa.operators.dedup import first_wins

    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (n - F.col("id")).alias("pos"), F.col("id").alias("payload"))
    win = {r.k: r.payload for r in first_wins(rows.repartition(6), ["k"], "pos").collect()}
    assert len(win) == 1 + (n - n // 3) and win["hot"] == 2997  # smallest pos among the hot rows


def test_view_keeps_every_unit_and_a_hot_one(spark):
    """A unit with a third of all links, units with one kind of link, and units with none."""
    from glossa.operators.context import full_context

    n = 900
    ids = range(6)
    units = spark.createDataFrame([(u, f"t{u}", "phrase", None, False, None, None, 1 if u != 5 else None) for u in ids],
                                  "unit_id long, content_raw string, content_type string, cefr_level string, is_idiom boolean, "
                                  "difficulty string, variant_confidence double, variant_id int")
    tone_rows = [(1, k) for k in range(n // 3)] + [(2, 0), (3, 1)]
    theme_rows = [(1, 0), (1, 1), (2, 0), (4, 2)]
    t = {"content_unit": units,
         "language_variant": spark.createDataFrame([(1, "en", "EN", True)], "variant_id int, iso_code string, variant_name string, is_pivot boolean"),
         "rel_content_tone": spark.createDataFrame(tone_rows, "unit_id long, tone_id int"),
         "tone_marker": spark.createDataFrame([(k, f"tone{k}") for k in range(n // 3)], "tone_id int, tone_name string"),
         "rel_content_context": spark.createDataFrame(theme_rows, "unit_id long, context_id int"),
         "cultural_context_tag": spark.createDataFrame([(k, f"theme{k}") for k in range(3)], "context_id int, context_name string")}
    got = sorted(((r.unit_id, r.tone_name, r.theme) for r in full_context(t).collect()), key=str)
    want = [(1, f"tone{k}", f"theme{j}") for k in range(n // 3) for j in (0, 1)]
    want += [(0, None, None), (2, "tone0", "theme0"), (3, "tone1", None), (4, None, "theme2")]  # 5 has no variant
    assert got == sorted(want, key=str)
