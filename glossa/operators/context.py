"""The unified context view and reader scoping (H1-H4).

Policies apply to each base table *under* the joins (the view runs with the
caller's rights).  A table a reader may not see becomes ``filter(false)``;
Catalyst prunes it to an empty relation and the outer joins above it fold
into NULL columns, so only the readable scans remain in the plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.scalars import not_admin
from glossa.schemas import LINGUISTIC_TABLES, STUDENT_TABLES, TABLE_NAMES

VIEW_COLUMNS = ("unit_id", "content_raw", "content_type", "cefr_level", "is_idiom", "difficulty",
                "variant_confidence", "iso_code", "variant_name", "is_pivot", "tone_name", "theme")


def full_context(t: Mapping[str, DataFrame]) -> DataFrame:
    """H1 (C4): units with variant, tones and themes.

    Units without a variant drop (inner join); a unit with m tones and n
    themes gives m*n rows; unlinked units keep NULLs.  Each bridge meets its
    (broadcast) dimension first.  The tone x theme combinations are formed on
    narrow rows: both kinds by an inner join, one kind and none by anti-joins
    on distinct ids.  The wide units (with their text) then meet them in one
    inner join.  Every join is an inner or anti join, so AQE can split a unit
    that holds a large share of the links, and the text is read and shuffled
    once.
    """
    cu = t["content_unit"].select("unit_id", "content_raw", "content_type", "cefr_level", "is_idiom",
                                  "difficulty", "variant_confidence", "variant_id")
    lv = t["language_variant"].select("variant_id", "iso_code", "variant_name", "is_pivot")
    tones = (t["rel_content_tone"].select("unit_id", "tone_id")
             .join(t["tone_marker"].select("tone_id", "tone_name"), "tone_id", "left")
             .select("unit_id", "tone_name"))
    themes = (t["rel_content_context"].select("unit_id", "context_id")
              .join(t["cultural_context_tag"].select("context_id", F.col("context_name").alias("theme")),
                    "context_id", "left")
              .select("unit_id", "theme"))
    none = F.lit(None).cast("string")
    tone_keys, theme_keys = tones.select("unit_id").distinct(), themes.select("unit_id").distinct()
    ids = t["content_unit"].select("unit_id").distinct()
    unlinked = ids.join(tone_keys.union(theme_keys).distinct(), "unit_id", "left_anti")
    combos = (tones.join(themes, "unit_id")
              .unionByName(tones.join(theme_keys, "unit_id", "left_anti").withColumn("theme", none))
              .unionByName(themes.join(tone_keys, "unit_id", "left_anti").withColumn("tone_name", none))
              .unionByName(unlinked.withColumn("tone_name", none).withColumn("theme", none)))
    return cu.join(lv, "variant_id").join(combos, "unit_id").select(*VIEW_COLUMNS)


# Policy registry: (policy, table, database role, predicate on the JWT role claim).
def _true(claim: Column) -> Column:
    return F.lit(True)


def _is_admin(claim: Column) -> Column:
    return claim == F.lit("admin")


POLICIES = (
    [("admin_full_access", t, "authenticated", _is_admin) for t in TABLE_NAMES]
    + [(f"anon_read_{t}", t, "anon", _true) for t in LINGUISTIC_TABLES]
    + [(f"student_read_{t}", t, "authenticated", not_admin) for t in STUDENT_TABLES]
)


def policy_predicate(table: str, db_role: str, claim: str | None) -> Column:
    """H2: OR of the policies that grant ``db_role`` on ``table``; no policy means no rows."""
    claim_col = F.lit(claim).cast("string")
    preds = [p(claim_col) for _, tbl, role, p in POLICIES if tbl == table and role == db_role]
    if not preds:
        return F.lit(False)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return F.coalesce(out, F.lit(False))


def scoped(t: Mapping[str, DataFrame], db_role: str, claim: str | None = None) -> dict[str, DataFrame]:
    """H2: every table filtered by the reader's policies (deny by default)."""
    return {name: df.where(policy_predicate(name, db_role, claim)) for name, df in t.items()}


def scoped_context(t: Mapping[str, DataFrame], db_role: str, claim: str | None = None) -> DataFrame:
    """H3: the view over the reader's scoped tables (never filtered after the join)."""
    return full_context(scoped(t, db_role, claim))


READERS = (("anon", None), ("authenticated", "admin"), ("authenticated", "student"), ("authenticated", None),
           ("service", None))


def policy_matrix(spark: SparkSession) -> DataFrame:
    """H4: table x reader -> readable, one column per reader."""
    rows = []
    for table in TABLE_NAMES:
        for role, claim in READERS:
            reader = role if claim is None else f"{role}:{claim}"
            rows.append((table, reader, role, claim))
    base = spark.createDataFrame(rows, "table string, reader string, db_role string, claim string")
    readable = None
    for table in TABLE_NAMES:
        for role, claim in READERS:
            cond = (F.col("table") == table) & (F.col("db_role") == role) & F.col("claim").eqNullSafe(F.lit(claim))
            val = policy_predicate(table, role, claim)
            readable = F.when(cond, val) if readable is None else readable.when(cond, val)
    return (base.withColumn("readable", readable)
                .groupBy("table").pivot("reader", [r if c is None else f"{r}:{c}" for r, c in READERS])
                .agg(F.first("readable")))
