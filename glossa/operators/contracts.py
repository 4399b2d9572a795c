"""Data contracts (J1-J21) on the tables' schema and data.

Every check returns rows ``(check, subject, observed, status)`` with status
PASS / FAIL / WARNING.  Checks start from the list of what is expected, so
a missing table or column gives a FAIL row rather than no row.

A check is made of three kinds of parts: fixed rows decided from the schema
on the driver, *measures* (one aggregate expression over one table), and
frames for checks that need joins.  ``run_contracts`` merges the measures
of all checks per table into a single aggregate, so the whole suite scans
each table once for its single-table checks (plus one pass per join check)
instead of once per check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.scalars import content_hash, normalize_iso, valid_confidence
from glossa.operators.context import full_context, scoped_context
from glossa.schemas import (ALLOWED_VALUES, CONSTRAINT_SCHEMA, CONSTRAINTS, FALLBACK_ISO, FOREIGN_KEYS, JSON_COLUMNS, TABLE_NAMES,
                            TABLES, ForeignKey)

RESULT_SCHEMA = "check string, subject string, observed string, status string"
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Measure:
    """One aggregate over one table, turned into one result row."""
    check: str
    subject: str
    table: str
    value: Column                                   # aggregate expression
    ok: Callable[[Column], Column]
    fail: str = "FAIL"
    observed: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Unique:
    """No value of the key columns occurs twice; observed: how many do."""
    check: str
    subject: str
    table: str
    key: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    """Every non-NULL value of a foreign key is a key of the parent; observed: the rows whose value is not."""
    check: str
    fk: ForeignKey

    @property
    def subject(self) -> str:
        return f"{self.fk.name} ON DELETE {self.fk.on_delete}"


@dataclass
class Parts:
    rows: list[tuple] = field(default_factory=list)
    measures: list[Measure] = field(default_factory=list)
    uniques: list[Unique] = field(default_factory=list)
    references: list[Reference] = field(default_factory=list)
    frames: list[DataFrame] = field(default_factory=list)

    def __add__(self, other: "Parts") -> "Parts":
        return Parts(self.rows + other.rows, self.measures + other.measures, self.uniques + other.uniques,
                     self.references + other.references, self.frames + other.frames)


def _spark(tables: Tables) -> SparkSession:
    for df in tables.values():
        return df.sparkSession
    return SparkSession.getActiveSession()


def _verdict(check: str, subject: str, observed: Column, ok: Column, fail: str = "FAIL") -> list[Column]:
    return [F.lit(check).alias("check"), F.lit(subject).alias("subject"), observed.cast("string").alias("observed"),
            F.when(ok, F.lit("PASS")).otherwise(F.lit(fail)).alias("status")]


def measured(df: DataFrame, measures: list[Measure]) -> DataFrame:
    """All measures of one table in one aggregate: one row with a column ``_m<i>`` for each."""
    return df.agg(*[m.value.alias(f"_m{i}") for i, m in enumerate(measures)])


def judged(one: DataFrame, measures: list[Measure]) -> DataFrame:
    """One result row per measure, from the one row of their values."""
    rows = []
    for i, m in enumerate(measures):
        v = F.col(f"_m{i}")
        obs = m.observed(v) if m.observed else v.cast("string")
        rows.append(F.struct(F.lit(m.check).alias("check"), F.lit(m.subject).alias("subject"),
                             obs.alias("observed"),
                             F.when(m.ok(v), F.lit("PASS")).otherwise(F.lit(m.fail)).alias("status")))
    return one.select(F.inline(F.array(*rows)))


def assemble(tables: Tables, parts: Parts) -> DataFrame:
    spark = _spark(tables)
    frames = [spark.createDataFrame(parts.rows, RESULT_SCHEMA)] if parts.rows else []
    by_table: dict[str, list[Measure]] = {}
    for m in parts.measures:
        by_table.setdefault(m.table, []).append(m)
    frames += [judged(measured(tables[t], ms), ms) for t, ms in by_table.items()]
    frames += [_pair_dups(tables[u.table], u.key).select(*_verdict(u.check, u.subject, F.col("n"), F.col("n") == 0))
               for u in parts.uniques]
    for check in dict.fromkeys(r.check for r in parts.references):
        frames += _orphan_frames(tables, check, [r for r in parts.references if r.check == check])
    frames += parts.frames
    if not frames:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _missing(check: str, subject: str, what: str = "table missing") -> Parts:
    return Parts(rows=[(check, subject, what, "FAIL")])


def _count_if(cond: Column) -> Column:
    return F.count_if(cond)


# --- J1-J20 as parts ------------------------------------------------------------

def tables_present_parts(tables: Tables) -> Parts:
    """All twelve tables are loaded."""
    return Parts(rows=[("J1", t, "present" if t in tables else "missing", "PASS" if t in tables else "FAIL")
                       for t in TABLE_NAMES])


def _fk_parts(tables: Tables, check: str, fks) -> Parts:
    """Orphan counts for several foreign keys; a missing table is a FAIL row."""
    parts = Parts()
    for fk in fks:
        if fk.child not in tables or fk.parent not in tables:
            parts += _missing(check, Reference(check, fk).subject)
        else:
            parts.references.append(Reference(check, fk))
    return parts


def reference_counts(df: DataFrame, reference: Reference, key_type) -> DataFrame:
    """(subject, _ref) of every non-NULL reference of one foreign key."""
    return (df.where(F.col(reference.fk.column).isNotNull())
            .select(F.lit(reference.subject).alias("subject"), F.col(reference.fk.column).cast(key_type).alias("_ref")))


def _orphan_frames(tables: Tables, check: str, references: list[Reference]) -> list[DataFrame]:
    """One anti-join per parent table.

    The references of all keys that point at the same parent are unioned and
    counted per distinct (key, value) first (partial aggregation collapses a
    hot value map-side); only the distinct references meet the parent's
    distinct keys, so each parent key set is shuffled once for all its
    children instead of once per foreign key.  NULL references are valid.
    """
    frames = []
    groups: dict[tuple[str, str], list[Reference]] = {}
    for r in references:
        groups.setdefault((r.fk.parent, r.fk.parent_key), []).append(r)
    for (parent, pk), members in groups.items():
        key_type = tables[parent].schema[pk].dataType
        refs = None
        for r in members:
            one = reference_counts(tables[r.fk.child], r, key_type)
            refs = one if refs is None else refs.unionByName(one)
        counted = refs.groupBy("subject", "_ref").agg(F.count(F.lit(1)).alias("_n"))
        keys = tables[parent].select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull()).distinct()
        missing = counted.join(keys, F.col("_ref") == F.col("_pk"), "left_anti")
        # one conditional sum per key: every key gets a row, zero included, without a join
        one = missing.agg(*[F.coalesce(F.sum(F.when(F.col("subject") == r.subject, F.col("_n"))), F.lit(0))
                            .cast("long").alias(f"_k{i}") for i, r in enumerate(members)])
        rows = [F.struct(F.lit(check).alias("check"), F.lit(r.subject).alias("subject"),
                         F.col(f"_k{i}").cast("string").alias("observed"),
                         F.when(F.col(f"_k{i}") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))
                for i, r in enumerate(members)]
        frames.append(one.select(F.inline(F.array(*rows))))
    return frames


def constraints_in_force(tables: Tables) -> DataFrame:
    """child, column, parent, parent_key, on_delete, on_update of the foreign keys: what the corpus says under
    ``CONSTRAINTS``, or the registry."""
    if CONSTRAINTS in tables:
        return tables[CONSTRAINTS].select(*[F.col(c) for c in CONSTRAINT_SCHEMA.names])
    return registry_frame(_spark(tables))


def registry_frame(spark: SparkSession) -> DataFrame:
    """The foreign-key registry as a relation."""
    return spark.createDataFrame([(k.child, k.column, k.parent, k.parent_key, k.on_delete, k.on_update) for k in FOREIGN_KEYS], CONSTRAINT_SCHEMA)


def foreign_keys_parts(tables: Tables) -> Parts:
    """J2 (+C14): one row per foreign key: orphan count (NULL keys are valid) and its delete action."""
    return _fk_parts(tables, "J2", FOREIGN_KEYS)


def _columns_parts(tables: Tables, check: str, table: str, columns: tuple[str, ...]) -> Parts:
    """The columns exist (schema), then the documented allowed values (data, as warnings)."""
    if table not in tables:
        return _missing(check, table)
    df = tables[table]
    parts = Parts(rows=[(check, f"{table}.{c}", "present" if c in df.columns else "missing",
                         "PASS" if c in df.columns else "FAIL") for c in columns])
    for (t, c), vals in ALLOWED_VALUES.items():
        if t == table and c in df.columns:
            parts.measures.append(Measure(check, f"{table}.{c} allowed values", table,
                                          _count_if(F.col(c).isNotNull() & ~F.col(c).isin(*vals)),
                                          lambda v: v == 0, "WARNING"))
    return parts


def roots_parts(tables: Tables) -> Parts:
    """The parent column exists and roots (NULL parent) exist."""
    lv = tables.get("language_variant")
    if lv is None or "parent_variant_id" not in lv.columns:
        return _missing("J3", "language_variant.parent_variant_id", "missing")
    return Parts(measures=[Measure("J3", "language_variant roots", "language_variant",
                                   _count_if(F.col("parent_variant_id").isNull()), lambda v: v > 0)])


def pivot_parts(tables: Tables) -> Parts:
    """The pivot flag exists and exactly one variant is the pivot."""
    lv = tables.get("language_variant")
    if lv is None or "is_pivot" not in lv.columns:
        return _missing("J4", "language_variant.is_pivot", "missing")
    return Parts(measures=[Measure("J4", "language_variant pivot rows", "language_variant",
                                   _count_if(F.col("is_pivot")), lambda v: v == 1)])


def unit_columns_parts(tables: Tables) -> Parts:
    """J5 (+ the lemma part of speech, whose documented values the loader does not enforce)."""
    parts = _columns_parts(tables, "J5", "content_unit", ("cefr_level", "is_idiom", "difficulty"))
    if "lemma" in tables and "grammatical_category" in tables["lemma"].columns:
        parts += _columns_parts(tables, "J5", "lemma", ("grammatical_category",))
    return parts


def model_columns_parts(tables: Tables) -> Parts:
    return _columns_parts(tables, "J6", "ai_model_registry", ("model_name", "model_version", "training_status"))


def feedback_columns_parts(tables: Tables) -> Parts:
    return _columns_parts(tables, "J7", "correction_feedback_log",
                          ("training_cycle", "feedback_source", "error_severity"))


def media_columns_parts(tables: Tables) -> Parts:
    return _columns_parts(tables, "J8", "media_asset", ("asset_type", "file_format", "file_name", "storage_location"))


def vector_columns_parts(tables: Tables) -> Parts:
    return _columns_parts(tables, "J9", "vector_index", ("vector_status", "model_id", "unit_id"))


def _pair_dups(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """Number of key values that occur more than once (partial aggregation per key, then one count)."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
              .agg(F.count(F.lit(1)).alias("n")))


def hash_unique_parts(tables: Tables) -> Parts:
    """No repeated content hash, and every stored hash equals SHA-256(text || variant_id)."""
    cu = tables.get("content_unit")
    if cu is None or "content_hash" not in cu.columns:
        return _missing("J10", "content_unit.content_hash", "missing")
    return Parts(
        uniques=[Unique("J10", "content_unit duplicate hashes", "content_unit", ("content_hash",))],
        measures=[Measure("J10", "content_unit hash mismatches", "content_unit",
                          _count_if(~F.col("content_hash").eqNullSafe(content_hash("content_raw", "variant_id"))),
                          lambda v: v == 0)])


def bridge_keys_parts(tables: Tables) -> Parts:
    """(unit, tag) pairs of both bridges are unique; the subject lists the key columns in order."""
    parts = Parts()
    for table, key in (("rel_content_context", ("unit_id", "context_id")), ("rel_content_tone", ("unit_id", "tone_id"))):
        subject = f"{table} ({', '.join(key)})"
        if table not in tables:
            parts += _missing("J11", subject)
            continue
        parts.uniques.append(Unique("J11", subject, table, key))
    return parts


def feedback_chain_parts(tables: Tables) -> Parts:
    """What the registry asks of the feedback log's foreign keys, joined to the constraints in force: feedback -> model
    RESTRICT, feedback -> unit CASCADE, both updated by CASCADE; plus their orphan counts."""
    fks = [fk for fk in FOREIGN_KEYS if fk.child == "correction_feedback_log"]
    asked = registry_frame(_spark(tables)).where(F.col("child") == "correction_feedback_log").select(
        "child", "column", "parent", "parent_key", F.col("on_delete").alias("_delete"), F.col("on_update").alias("_update"))
    found = constraints_in_force(tables)
    met = asked.join(found, ["child", "column", "parent", "parent_key"], "left")
    name = F.concat("child", F.lit("."), "column", F.lit("->"), "parent", F.lit("."), "parent_key")
    followed = F.coalesce(F.col("on_update") == F.col("_update"), F.lit(False))
    observed = (F.when(F.col("on_delete").isNull(), F.lit("missing")).when(followed, F.col("on_delete"))
                .otherwise(F.concat_ws(", ON UPDATE ", "on_delete", F.coalesce("on_update", F.lit("NO ACTION")))))
    status = (F.when(~followed, "FAIL").when(F.col("on_delete") == F.col("_delete"), "PASS")
              .when(F.col("on_delete") == "SET NULL", "WARNING").otherwise("FAIL"))
    chain = met.select(F.lit("J12").alias("check"), F.concat(name, F.lit(" action")).alias("subject"), observed.alias("observed"), status.alias("status"))
    return Parts(frames=[chain]) + _fk_parts(tables, "J12", fks)


def profile_parts(tables: Tables) -> Parts:
    """Per table: rows, columns, JSON columns, NOT NULL columns, and NULLs found in NOT NULL columns."""
    parts = Parts()
    for t in TABLE_NAMES:
        if t not in tables:
            parts += _missing("J13", t)
            continue
        df = tables[t]
        not_null = [f.name for f in TABLES[t].fields if not f.nullable and f.name in df.columns]
        json_cols = [c for c in JSON_COLUMNS.get(t, ()) if c in df.columns]
        viol = [F.count_if(F.col(c).isNull()) for c in not_null]
        total_viol = sum(viol[1:], viol[0]) if viol else F.lit(0).cast("long")
        value = F.struct(F.count(F.lit(1)).alias("rows"), total_viol.alias("viol"))
        ncols, njson, nnn = len(df.columns), len(json_cols), len(not_null)
        parts.measures.append(Measure(
            "J13", t, t, value, lambda v: v["viol"] == 0,
            observed=lambda v, a=ncols, b=njson, c=nnn: F.format_string(
                "rows=%d columns=%d json=%d not_null=%d null_in_not_null=%d", v["rows"], F.lit(a), F.lit(b), F.lit(c),
                v["viol"])))
    return parts


def confidence_parts(tables: Tables) -> Parts:
    """The confidence column exists and holds NULL or values in [0, 1]."""
    cu = tables.get("content_unit")
    if cu is None or "variant_confidence" not in cu.columns:
        return _missing("J14", "content_unit.variant_confidence", "missing")
    return Parts(measures=[Measure("J14", "content_unit.variant_confidence out of range", "content_unit",
                                   _count_if(~valid_confidence("variant_confidence")), lambda v: v == 0)])


VIEW_TABLES = ("content_unit", "language_variant", "rel_content_tone", "tone_marker", "rel_content_context",
               "cultural_context_tag")
def view_scope_parts(tables: Tables) -> Parts:
    """The view is caller-scoped: no row of a student's view shows a tone or theme, and anon's view is the full one
    (as many rows, and the same sum of row hashes)."""
    if any(t not in tables for t in VIEW_TABLES):
        return _missing("J15", "v_content_full_context")
    one = scope_measures(tables)
    hidden = F.col("n_all") - F.col("n_anon")
    rows = [F.struct(*_verdict("J15", "student view rows with tone or theme", F.col("linked"), F.col("linked") == 0)),
            F.struct(*_verdict("J15", "view rows hidden from anon", hidden, (hidden == 0) & (F.col("h_all") == F.col("h_anon"))))]
    return Parts(frames=[one.select(F.inline(F.array(*rows)))])


def scope_measures(tables: Tables) -> DataFrame:
    """One row: the student view's rows with a tone or theme, rows and sum of row hashes of the full view and of anon's."""
    linked = scoped_context(tables, "authenticated", "student").agg(
        _count_if(F.col("tone_name").isNotNull() | F.col("theme").isNotNull()).alias("linked"))

    def digest(view: DataFrame, name: str) -> DataFrame:
        return view.agg(F.count(F.lit(1)).alias(f"n_{name}"),
                        F.coalesce(F.sum(F.xxhash64(*view.columns).cast("decimal(38,0)")), F.lit(0)).alias(f"h_{name}"))

    return linked.crossJoin(digest(full_context(tables), "all")).crossJoin(digest(scoped_context(tables, "anon"), "anon"))  # one row each


def scope_rows(linked: int, hidden: int, same: bool) -> list[tuple]:
    """The J15 rows for measures that are known already."""
    return [("J15", "student view rows with tone or theme", str(linked), "PASS" if linked == 0 else "FAIL"),
            ("J15", "view rows hidden from anon", str(hidden), "PASS" if hidden == 0 and same else "FAIL")]


def vector_owner_parts(tables: Tables) -> Parts:
    """Every vector has a model."""
    v = tables.get("vector_index")
    if v is None or "model_id" not in v.columns:
        return _missing("J16", "vector_index.model_id", "missing")
    return Parts(measures=[Measure("J16", "vector_index.model_id NULL rows", "vector_index",
                                   _count_if(F.col("model_id").isNull()), lambda v: v == 0)])


def vector_pair_parts(tables: Tables) -> Parts:
    """One vector per (unit, model)."""
    v = tables.get("vector_index")
    if v is None:
        return _missing("J17", "vector_index")
    return Parts(uniques=[Unique("J17", "vector_index (unit_id, model_id) repeats", "vector_index", ("unit_id", "model_id"))])


def iso_normal_parts(tables: Tables) -> Parts:
    """Every stored code equals its own normalisation."""
    if "language_variant" not in tables:
        return _missing("J18", "language_variant")
    return Parts(measures=[Measure("J18", "language_variant.iso_code not normalised", "language_variant",
                                   _count_if(~F.col("iso_code").eqNullSafe(normalize_iso("iso_code"))),
                                   lambda v: v == 0)])


def fallback_variant_parts(tables: Tables) -> Parts:
    """Exactly one 'und' variant."""
    if "language_variant" not in tables:
        return _missing("J19", "language_variant")
    return Parts(measures=[Measure("J19", "language_variant und rows", "language_variant",
                                   _count_if(F.col("iso_code") == FALLBACK_ISO), lambda v: v == 1)])


def restrict_verdict(tables: Tables, blocked: DataFrame) -> DataFrame:
    """The J20 row: ``blocked`` is one row with the number ``n`` of models that have vectors; the action in force decides."""
    asked = registry_frame(_spark(tables)).where((F.col("child") == "vector_index") & (F.col("column") == "model_id")).select("child", "column")
    action = F.col("on_delete")
    label = (F.when(action == "RESTRICT", "blocked").when(action == "CASCADE", "cascades").when(action == "SET NULL", "sets null")
             .otherwise(F.coalesce(action, F.lit("has no rule"))))
    rule = asked.join(constraints_in_force(tables), ["child", "column"], "left").select("on_delete")
    return rule.crossJoin(blocked).select(  # one row each
        F.lit("J20").alias("check"), F.concat(F.lit("model delete "), label).alias("subject"), F.col("n").cast("string").alias("observed"),
        F.when(action == "RESTRICT", F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"))


def model_restrict_parts(tables: Tables) -> Parts:
    """Deleting a model that has vectors is refused (RESTRICT in force); observed = models blocked."""
    if "vector_index" not in tables or "ai_model_registry" not in tables:
        return _missing("J20", "vector_index -> ai_model_registry")
    models = tables["ai_model_registry"].select("model_id")
    blocked = models.join(tables["vector_index"].select("model_id").distinct(), "model_id", "left_semi")
    return Parts(frames=[restrict_verdict(tables, blocked.agg(F.count(F.lit(1)).alias("n")))])


PARTS = (tables_present_parts, foreign_keys_parts, roots_parts, pivot_parts, unit_columns_parts,
         model_columns_parts, feedback_columns_parts, media_columns_parts, vector_columns_parts,
         hash_unique_parts, bridge_keys_parts, feedback_chain_parts, profile_parts, confidence_parts,
         view_scope_parts, vector_owner_parts, vector_pair_parts, iso_normal_parts, fallback_variant_parts,
         model_restrict_parts)


def _standalone(parts_fn) -> Callable[[Tables], DataFrame]:
    def check(tables: Tables) -> DataFrame:
        return assemble(tables, parts_fn(tables))
    check.__name__ = parts_fn.__name__.replace("_parts", "")
    check.__doc__ = parts_fn.__doc__
    return check


check_tables_present = _standalone(tables_present_parts)
check_foreign_keys = _standalone(foreign_keys_parts)
check_roots = _standalone(roots_parts)
check_pivot = _standalone(pivot_parts)
check_unit_columns = _standalone(unit_columns_parts)
check_model_columns = _standalone(model_columns_parts)
check_feedback_columns = _standalone(feedback_columns_parts)
check_media_columns = _standalone(media_columns_parts)
check_vector_columns = _standalone(vector_columns_parts)
check_hash_unique = _standalone(hash_unique_parts)
check_bridge_keys = _standalone(bridge_keys_parts)
check_feedback_chain = _standalone(feedback_chain_parts)
profile_tables = _standalone(profile_parts)
check_confidence = _standalone(confidence_parts)
check_view_scope = _standalone(view_scope_parts)
check_vector_owner = _standalone(vector_owner_parts)
check_vector_pair = _standalone(vector_pair_parts)
check_iso_normal = _standalone(iso_normal_parts)
check_fallback_variant = _standalone(fallback_variant_parts)
check_model_restrict = _standalone(model_restrict_parts)


def run_contracts(tables: Tables) -> DataFrame:
    """J1-J20 as one frame; single-table measures share one aggregate per table."""
    parts = Parts()
    for fn in PARTS:
        parts += fn(tables)
    return assemble(tables, parts)


def gate(results: DataFrame) -> DataFrame:
    """One row: number of checks, failures, warnings, and whether publication may go ahead."""
    return results.agg(F.count(F.lit(1)).alias("checks"),
                       F.count_if(F.col("status").startswith("FAIL")).alias("failures"),
                       F.count_if(F.col("status") == "WARNING").alias("warnings")
                       ).withColumn("publish", F.col("failures") == 0)
