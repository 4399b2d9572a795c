"""The analytical operators on a small corpus made by hand, with the rows they must give."""

import pytest

from glossa.operators import aggregates, joins


@pytest.fixture(scope="module")
def corpus(spark):
    def table(rows, schema):
        return spark.createDataFrame(rows, schema)

    return {
        "variants": table([(1, "IT"), (2, "FI"), (3, "EN")], "variant_id int, variant_name string"),
        "units": table([(10, "ciao", "A1", 1), (11, "hei", "A1", 2), (12, "hello", None, 3), (13, "addio", "B2", 1), (14, "?", "B2", None)],
                       "unit_id long, content_raw string, cefr_level string, variant_id int"),
        "themes": table([(1, "food"), (2, "home"), (3, "unused")], "context_id int, context_name string"),
        "theme_links": table([(10, 1), (11, 1), (13, 2), (99, 2)], "unit_id long, context_id int"),
        "vectors": table([(10,), (12,), (12,)], "unit_id long"),
        "lemmas": table([(1, "bar", 1), (2, "bar", 2), (3, "casa", 1), (4, "bar", 3), (5, "bar", 1), (6, "solo", None)],
                        "lemma_id long, text_root string, variant_id int"),
        "forms": table([(100, 1), (101, 1), (None, 2), (102, 6)], "form_id long, lemma_id long"),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_units_by_level(corpus):
    assert rows(aggregates.count_by_level(corpus["units"])) == sorted([("A1", 2), ("B2", 2), (None, 1)], key=str)


def test_audit_needs_variant_and_level(corpus):
    audit = lambda name, level: rows(joins.audit_language_level(corpus["units"], corpus["variants"], name, level))
    assert audit("IT", "B2") == [("addio", "IT", "B2")]
    assert audit("FI", "B2") == [] and audit("XX", "A1") == []


def test_theme_coverage_counts_links_of_used_themes(corpus):
    assert rows(aggregates.theme_coverage(corpus["themes"], corpus["theme_links"])) == [("food", 2), ("home", 2)]


def test_units_without_vector(corpus):
    got = joins.units_without_vector(corpus["units"], corpus["vectors"])
    assert rows(got) == [(11, "hei"), (13, "addio"), (14, "?")]


def test_density_counts_forms_and_rows(corpus):
    # the FI lemma's only form has no id: it is a row, but no form
    assert rows(aggregates.morpho_density(corpus["variants"], corpus["lemmas"], corpus["forms"])) == [("FI", 0, 1), ("IT", 2, 2)]


def test_shared_roots_repeat_a_variant_for_each_lemma(corpus):
    assert rows(aggregates.shared_roots(corpus["lemmas"], corpus["variants"])) == [("bar", "EN | FI | IT | IT")]


def test_collations_order_accents_and_case(spark):
    """Binary order by default; under a collation accents and case come after letters, and equal texts stay apart."""
    from glossa.functions.scalars import in_order
    from glossa.operators.keys import enumerate_values

    words = ["zz", "Éa", "ea", "Eb", "éa", "Zz", "eb", "", None, "ea"]
    df = spark.createDataFrame([(w,) for w in words], "w string")

    def numbered(**options):
        return [r.w for r in enumerate_values(df, "w", **options)[0].orderBy("id").collect()]

    assert numbered() == ["Eb", "Zz", "ea", "eb", "zz", "Éa", "éa"]
    assert numbered(collation="UNICODE") == ["ea", "éa", "Éa", "eb", "Eb", "zz", "Zz"]
    assert numbered(collation="UNICODE_CI_AI") == ["ea", "Éa", "éa", "Eb", "eb", "Zz", "zz"]  # equal ones in binary order
    assert numbered(collation="UNICODE", drop_blank=False)[:2] == [None, ""]
    plain = df.where("w is not null").select("w", in_order("w", "UNICODE_CI").alias("k"))
    assert plain.groupBy("k").count().where("count > 1").count() == 4 and plain.groupBy("w").count().count() == 8

    lemmas = spark.createDataFrame([(r, v) for r in ("Éa", "ea", "zz") for v in (1, 2, 3)] + [("ea", 2)], "text_root string, variant_id int")
    names = spark.createDataFrame([(1, "zeta"), (2, "Éa"), (3, "Eb")], "variant_id int, variant_name string")
    assert [tuple(r) for r in aggregates.shared_roots(lemmas, names).collect()] == [
        ("ea", "Eb | zeta | Éa | Éa"), ("zz", "Eb | zeta | Éa"), ("Éa", "Eb | zeta | Éa")]
    assert [tuple(r) for r in aggregates.shared_roots(lemmas, names, collation="UNICODE").collect()] == [
        ("ea", "Éa | Éa | Eb | zeta"), ("Éa", "Éa | Eb | zeta"), ("zz", "Éa | Eb | zeta")]
