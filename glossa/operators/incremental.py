"""J1-J21 on a load's own rows: contracts from measures that merge.

A version leaves a ledger beside its tables: the value of every count so far,
how many keys repeat, and the distinct references that later loads must look
at again.  The next load measures its new rows alone and adds: counts are
summed; new keys meet the stored key columns in one semi-join; new references
meet the stored parents' keys, and references that had no parent yet meet the
new parents only.  Stored texts are never read, and the results are those of a
full run over all versions.

Dimensions are rewritten by every load and are small, so they are checked
whole, against the distinct references of all loads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.operators import contracts as C
from glossa.operators.dimensions import materialize

COUNTS = "check string, subject string, part string, value decimal(38,0)"
REFERENCES = "subject string, ref string, n long, orphan boolean"


@dataclass
class Ledger:
    """counts: (check, subject, part, value), a row for each number of a check; references: distinct values of the
    foreign keys into dimensions, and of all others those without a parent (orphan), with the rows that hold them."""

    counts: DataFrame
    references: DataFrame

    def write(self, path: str) -> None:
        self.counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")  # a row for each number of a check
        self.references.write.mode("overwrite").parquet(f"{path}/references")

    @staticmethod
    def read(spark: SparkSession, path: str) -> Ledger:
        return Ledger(spark.read.schema(COUNTS).parquet(f"{path}/counts"), spark.read.schema(REFERENCES).parquet(f"{path}/references"))


def _repeated(new: DataFrame, stored: DataFrame | None, key: tuple[str, ...]) -> int:
    """How many key values the new rows make occur more than once that did not before."""
    own = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_new"))
    if stored is None:
        return own.agg(F.count_if(F.col("_new") > 1)).first()[0]
    asked = own.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_new")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(key)]
    # only stored rows of the new keys are counted
    held = stored.select(*key).join(asked.drop("_new"), same, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("_old"))
    both = asked.join(held, same, "left")
    return both.agg(F.count_if((F.coalesce("_old", F.lit(0)) <= 1) & (F.coalesce("_old", F.lit(0)) + F.col("_new") > 1))).first()[0]


def _keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("_pk")).where(F.col("_pk").isNotNull()).distinct()


def _references(parts: C.Parts, new: C.Tables, stored: C.Tables, old: DataFrame | None, dimensions: Sequence[str]) -> DataFrame:
    """The ledger's references after this load."""
    spark = C._spark(new)
    out = spark.createDataFrame([], REFERENCES)
    groups: dict[tuple[str, str], dict[str, C.Reference]] = {}
    for r in parts.references:
        groups.setdefault((r.fk.parent, r.fk.parent_key), {})[r.subject] = r
    for (parent, pk), members in groups.items():
        own = spark.createDataFrame([], "subject string, _ref string")
        for r in members.values():
            if r.fk.child not in new:
                continue
            one = C.reference_counts(new[r.fk.child], r, "string")
            own = own.unionByName(one)
        own = own.groupBy("subject", F.col("_ref").alias("ref")).agg(F.count(F.lit(1)).alias("n"))
        # a child that is a dimension is counted anew, so what the ledger says of it is dropped
        kept = [r.subject for r in members.values() if r.fk.child not in dimensions]
        before = None if old is None else old.where(F.col("subject").isin(kept))
        if parent in dimensions:
            every = own if before is None else own.unionByName(before.select("subject", "ref", "n"))
            merged = every.groupBy("subject", "ref").agg(F.sum("n").alias("n"))
            known = _keys(new[parent], pk)
            found = merged.join(known, F.col("ref") == F.col("_pk"), "left").withColumn("orphan", F.col("_pk").isNull()).drop("_pk")
        else:
            fresh = _keys(new[parent] if parent in new else stored[parent].limit(0), pk)
            lost = own.join(fresh, F.col("ref") == F.col("_pk"), "left_anti")
            if parent in stored:
                lost = lost.join(_keys(stored[parent], pk), F.col("ref") == F.col("_pk"), "left_anti")
            if before is not None:  # what had no parent may have one now
                lost = lost.unionByName(before.select("subject", "ref", "n").join(fresh, F.col("ref") == F.col("_pk"), "left_anti"))
            found = lost.groupBy("subject", "ref").agg(F.sum("n").alias("n")).withColumn("orphan", F.lit(True))
        out = out.unionByName(found.select("subject", "ref", "n", "orphan"))
    return materialize(out)


def _scope(tables: C.Tables) -> tuple[int, int, int]:
    """(student rows that show a tone or theme, rows hidden from anon, whether the views differ) of some units."""
    row = C.scope_measures(tables).first()
    return row["linked"], row["n_all"] - row["n_anon"], int(row["h_all"] != row["h_anon"])


def _scope_of_load(new: C.Tables, stored: C.Tables) -> tuple[int, int, int]:
    """What the load changes in the view's measures: all rows of the units that are new or get new links, less the rows
    that those already stored had before.  No text is read: the measures need none."""
    bridges = ("rel_content_tone", "rel_content_context")
    narrow = lambda df: df.withColumn("content_raw", F.lit(None).cast("string"))
    if "content_unit" not in stored:
        return _scope({**new, "content_unit": narrow(new["content_unit"])})
    touched = new[bridges[0]].select("unit_id").union(new[bridges[1]].select("unit_id")).distinct()
    old_units = narrow(stored["content_unit"].drop("content_raw")).join(touched, "unit_id", "left_semi")
    units = narrow(new["content_unit"]).unionByName(old_units, allowMissingColumns=True)
    ids = units.select("unit_id").distinct()
    links = {b: stored[b].join(ids, "unit_id", "left_semi") for b in bridges}
    after = {**new, "content_unit": units, **{b: new[b].unionByName(links[b], allowMissingColumns=True) for b in bridges}}
    before = {**new, "content_unit": old_units, **links}
    (a, b, c), (x, y, z) = _scope(after), _scope(before)
    return a - x, b - y, max(c - z, 0)


def run_contracts(new: C.Tables, stored: C.Tables | None, ledger: Ledger | None, dimensions: Sequence[str]) -> tuple[DataFrame, Ledger]:
    """J1-J20 over everything a reader will see once ``new`` is published, and the ledger for the next load.

    ``new`` holds the load's rows (``dimensions``: the whole tables), ``stored`` the earlier rows of the other tables,
    which must have the columns that keys and links need, and ``ledger`` what the loads before left.  Without a ledger
    ``new`` must be everything.  A fact table that only earlier loads had counts as present.
    """
    spark = C._spark(new)
    stored = dict(stored or {}) if ledger is not None else {}
    tables = {**stored, **new}
    parts = C.Parts()
    for fn in C.PARTS:
        if fn not in (C.view_scope_parts, C.model_restrict_parts):
            parts += fn(tables)
    old = {(r["check"], r["subject"], r["part"]): int(r["value"]) for r in ledger.counts.collect()} if ledger else {}  # a row a number
    numbers: list[tuple[str, str, str, int]] = []

    def total(check: str, subject: str, part: str, value: int, table: str = "") -> int:
        now = value + (0 if table in dimensions else old.get((check, subject, part), 0))
        numbers.append((check, subject, part, now))
        return now

    frames = [spark.createDataFrame(parts.rows, C.RESULT_SCHEMA)] if parts.rows else []
    by_table: dict[str, list[C.Measure]] = {}
    for m in parts.measures:
        by_table.setdefault(m.table, []).append(m)
    for t, ms in by_table.items():
        one = C.measured(new[t] if t in new else tables[t].limit(0), ms)
        values = []
        for m, v in zip(ms, one.first()):
            if hasattr(v, "asDict"):
                values.append(tuple(total(m.check, m.subject, k, x or 0, t) for k, x in v.asDict().items()))
            else:
                values.append(total(m.check, m.subject, "", v or 0, t))
        frames.append(C.judged(spark.createDataFrame([tuple(values)], one.schema), ms))
    rows = []
    for u in parts.uniques:
        n = total(u.check, u.subject, "", _repeated(new[u.table], stored.get(u.table), u.key) if u.table in new else 0, u.table)
        rows.append((u.check, u.subject, str(n), "PASS" if n == 0 else "FAIL"))
    references = _references(parts, new, stored, ledger.references if ledger else None, dimensions)
    lost = {r["subject"]: r["n"] for r in references.where("orphan").groupBy("subject").agg(F.sum("n").alias("n")).collect()}  # a row a key
    rows += [(r.check, r.subject, str(n := lost.get(r.subject, 0)), "PASS" if n == 0 else "FAIL") for r in parts.references]
    if all(t in tables for t in C.VIEW_TABLES):
        measures = _scope_of_load({t: new.get(t, tables[t].limit(0)) for t in C.VIEW_TABLES}, stored)
        linked, hidden, differ = (total("J15", "view", k, v) for k, v in zip(("linked", "hidden", "differ"), measures))
        rows += C.scope_rows(linked, hidden, differ == 0)
    else:
        frames += C.view_scope_parts(tables).frames
        rows += C.view_scope_parts(tables).rows
    if "vector_index" in tables and "ai_model_registry" in tables:
        held = references.where((F.col("subject").startswith("vector_index.model_id->")) & ~F.col("orphan")).select(F.col("ref").alias("_ref"))
        models = new["ai_model_registry"].select(F.col("model_id").cast("string").alias("_model"))
        n = models.join(held, F.col("_model") == F.col("_ref"), "left_semi").agg(F.count(F.lit(1)).alias("n"))
        frames.append(C.restrict_verdict(tables, n))
    else:
        rows += C.model_restrict_parts(tables).rows
    out = spark.createDataFrame(rows, C.RESULT_SCHEMA)
    for f in [*frames, *parts.frames]:
        out = out.unionByName(f)
    return out, Ledger(spark.createDataFrame([(*k, Decimal(v)) for *k, v in numbers], COUNTS), references)

