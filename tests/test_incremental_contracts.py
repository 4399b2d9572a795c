"""Contracts on a load's own rows equal the contracts on everything, and read no stored text."""

import json

from pyspark.sql import functions as F

from glossa.operators import contracts, incremental
from glossa.plans.load import DIMENSIONS, load_export
from glossa.schemas import TABLE_NAMES, TABLES
from glossa.sources import sinks


def results(df):
    return sorted(tuple(r) for r in df.select("check", "subject", "observed", "status").collect())


def table(spark, name, rows):
    """Rows of the given columns; required columns that are left out get a value."""
    schema = TABLES[name]
    fill = {"string": "x", "bigint": 1, "int": 1, "boolean": False}
    full = [tuple(r.get(f.name, None if f.nullable else fill[f.dataType.simpleString()]) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def corpus(spark, units, tones, vectors, feedback):
    variants = [{"variant_id": 1, "iso_code": "it-IT", "is_pivot": True}, {"variant_id": 2, "iso_code": "und", "parent_variant_id": 1}]
    rows = {"language_variant": variants, "ai_model_registry": [{"model_id": 1, "training_status": "ready"}, {"model_id": 2, "training_status": "ready"}],
            "tone_marker": [{"tone_id": 1}], "cultural_context_tag": [{"context_id": 1}],
            "content_unit": [{"unit_id": u, "content_raw": t, "content_hash": h or "", "variant_id": v, "content_type": "phrase"} for u, t, h, v in units],
            "rel_content_tone": [{"unit_id": u, "tone_id": t} for u, t in tones],
            "vector_index": [{"vector_id": i, "unit_id": u, "model_id": m, "vector_status": "indexed"} for i, u, m in vectors],
            "correction_feedback_log": [{"log_id": i, "unit_id": u, "model_id": m, "feedback_source": "automated"} for i, u, m in feedback]}
    out = {t: table(spark, t, rows.get(t, [])) for t in TABLE_NAMES}
    rehashed = F.when(F.col("content_hash") == "", contracts.content_hash("content_raw", "variant_id")).otherwise(F.col("content_hash"))
    out["content_unit"] = out["content_unit"].withColumn("content_hash", rehashed)
    return out


def test_three_loads_equal_one_run(spark):
    loads = [
        # an orphan link that the second load gives its unit, a wrong hash, feedback on a unit that never comes
        corpus(spark, [(1, "a", "", 1), (2, "b", "wrong", 1)], [(1, 1), (5, 1)], [(1, 1, 1)], [(1, 99, 1)]),
        # a repeat of a stored hash, a link of a stored unit, a repeated pair inside the load, an unknown variant
        corpus(spark, [(5, "a", "", 1), (6, "c", "", 7)], [(2, 1), (6, 1), (6, 1)], [(2, 5, 2), (3, 1, 1)], []),
        # the third row of a hash that repeats already, a third vector of a pair, and nothing else
        corpus(spark, [(8, "a", "", 1)], [], [(4, 1, 1), (5, 8, 1)], [(2, 8, 2)]),
    ]
    stored, ledger, held = {}, None, {}
    for new in loads:
        got, ledger = incremental.run_contracts(new, stored, ledger, DIMENSIONS)
        held = {t: new[t] if t in DIMENSIONS or t not in held else held[t].unionByName(new[t]) for t in TABLE_NAMES}
        # what is stored is handed on without its texts: no later load may need them
        stored = {t: df.drop("content_raw", "source_metadata_json", "error_type") for t, df in held.items() if t not in DIMENSIONS}
    assert results(got) == results(contracts.run_contracts(held))
    assert ledger.references.where("orphan").select("ref").distinct().count() == 2  # unit 99 and variant 7


def export(path, ids, text="frase"):
    lines = [{"doc_id": f"d{k}", "doc_pos": k, "text": {"it": f"{text} {k}", "en": f"phrase {k}"}, "register": "formal", "themeId": "t"} for k in ids]
    with open(path, "w") as out:
        out.write("\n".join(map(json.dumps, lines)))
    return path


def test_loads_publish_with_a_ledger_and_an_old_root_gets_one(spark, tmp_dir):
    root = f"{tmp_dir}/corpus"
    _, first = load_export(spark, export(f"{tmp_dir}/a.jsonl", (1, 2)), root, "jsonl", "2026-01-01", "v1")
    _, second = load_export(spark, export(f"{tmp_dir}/b.jsonl", (2, 3, 4)), root, "jsonl", "2026-01-02", "v2")
    tables = sinks.load_tables(spark, root)
    assert {t: df.schema.simpleString() for t, df in tables.items()} == {t: s.simpleString() for t, s in TABLES.items()}
    assert tables["content_unit"].count() == 8
    assert results(second) == results(contracts.run_contracts(tables))
    # a version without a ledger: the next load measures everything once
    fs, path = sinks._fs(spark, f"{root}/v2/_ledger")
    assert fs.rename(path, sinks._fs(spark, f"{root}/v2/_no_ledger")[1])
    _, third = load_export(spark, export(f"{tmp_dir}/c.jsonl", (9,)), root, "jsonl", "2026-01-03", "v3")
    assert results(third) == results(contracts.run_contracts(sinks.load_tables(spark, root)))
    assert incremental.Ledger.read(spark, f"{root}/v3/_ledger").counts.count() > 40


def test_checks_of_constraints_can_fail(spark):
    tables = corpus(spark, [(1, "a", "", 1)], [], [(1, 1, 1)], [(1, 1, 1)])
    faulty = contracts.registry_frame(spark).where("child != 'vector_index'").withColumn(
        "on_update", F.when(F.col("child") == "correction_feedback_log", F.lit("NO ACTION")).otherwise(F.col("on_update")))
    sound = {(c, s): x for c, s, _, x in results(contracts.run_contracts(tables)) if c in ("J12", "J20")}
    assert set(sound.values()) == {"PASS"}
    got = {(c, s): (o, x) for c, s, o, x in results(contracts.run_contracts({**tables, contracts.CONSTRAINTS: faulty})) if c in ("J12", "J20")}
    assert got["J20", "model delete has no rule"] == ("1", "FAIL")
    assert sorted(v for (c, s), v in got.items() if s.endswith("action")) == [("CASCADE, ON UPDATE NO ACTION", "FAIL"), ("RESTRICT, ON UPDATE NO ACTION", "FAIL")]
    without = contracts.registry_frame(spark).where("child != 'correction_feedback_log'")
    gone = results(contracts.assemble(tables, contracts.feedback_chain_parts({**tables, contracts.CONSTRAINTS: without})))
    assert [(o, x) for _, s, o, x in gone if s.endswith("action")] == [("missing", "FAIL")] * 2
