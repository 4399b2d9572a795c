import os

import pytest

from glossa.operators import contracts, nested


def test_dependencies_edge_cases(spark):
    docs = spark.createDataFrame([
        (1, None), (2, "{}"), (3, '{"other": 1}'),
        (4, '{"dependencies": [{"word": "fox", "rel": "nsubj"}, {"id": 2, "word": "jumps", "rel": "root", "head": 0}]}'),
    ], "unit_id long, syntax_ud_json string")
    rows = {tuple(r) for r in nested.explode_dependencies(docs).collect()}
    assert rows == {(4, 2, "jumps", "ROOT", 0), (4, None, "fox", "NSUBJ", None)}


def test_transfer_errors_and_feats(spark):
    lem = spark.createDataFrame([(1, '{"L1_transfer_errors": ["false_friends", "tense_mismatch"], "severity": "high"}'),
                                 (2, None)], "lemma_id long, interference_json string")
    assert sorted(tuple(r) for r in nested.explode_transfer_errors(lem).collect()) == \
        [(1, "false_friends", "high"), (1, "tense_mismatch", "high")]
    forms = spark.createDataFrame([(1, 5, '{"upos": "NOUN", "feats": {"Number": "Sing", "Gender": "Fem"}}')],
                                  "form_id long, lemma_id long, grammar_json string")
    assert sorted(tuple(r) for r in nested.explode_feats(forms).collect()) == \
        [(1, 5, "NOUN", "Gender", "Fem"), (1, 5, "NOUN", "Number", "Sing")]


def test_missing_table_gives_fail_row(spark):
    lv = spark.createDataFrame([(1, "it-IT", "Standard Italian", False, None)],
                               "variant_id int, iso_code string, variant_name string, is_pivot boolean, "
                               "parent_variant_id int")
    t = {"language_variant": lv}
    present = {r.subject: r.status for r in contracts.check_tables_present(t).collect()}
    assert present["language_variant"] == "PASS" and present["content_unit"] == "FAIL"
    vp = contracts.check_vector_pair(t).collect()
    assert len(vp) == 1 and vp[0].status == "FAIL"
    und = contracts.check_fallback_variant(t).first()
    assert (und.observed, und.status) == ("0", "FAIL")
    g = contracts.gate(contracts.run_contracts(t)).first()
    assert g.failures > 0 and g.publish is False


SF01 = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF01), reason="driver test data not present")
def test_gate_on_bound_corpus_matches_hand_count(spark):
    """74 checks; failing: media_asset absent (J1, J2 x2, J8, J13), columns the binding does not carry
    (J7 feedback_source, J10 content_hash) and the raw code 'en' (J18)."""
    from pyspark.sql import functions as F

    from glossa.sources.bindings import Corpus
    res = contracts.run_contracts(Corpus(spark, SF01).tables())
    assert tuple(contracts.gate(res).first()) == (74, 8, 0, False)
    failing = sorted((r.check, r.subject) for r in res.where(F.col("status") == "FAIL").collect())
    assert [c for c, _ in failing] == ["J1", "J10", "J13", "J18", "J2", "J2", "J7", "J8"]
