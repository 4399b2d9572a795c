"""Table maintenance as batch rewrites.

Key-propagating deletes and updates are database constraints in the
reference; here each is a join against the key frame, following the
foreign-key registry.  Key frames may be large: they are de-duplicated and
joined (shuffle or, when the caller knows they are small, broadcast); no key
list is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.scalars import normalize_iso
from glossa.operators.dedup import first_wins
from glossa.operators.dimensions import checked_dimension, maybe_broadcast
from glossa.schemas import DEFAULTS, FALLBACK_ISO, FOREIGN_KEYS, PRIMARY_KEYS, TABLES

Tables = Mapping[str, DataFrame]


def _keys(keys: DataFrame, col: str) -> DataFrame:
    return keys.select(F.col(col).alias("_key")).where(F.col("_key").isNotNull()).distinct()


def restrict_violations(t: Tables, table: str, keys: DataFrame) -> DataFrame:
    """(child, fk, referencing rows) for every RESTRICT child that still points at the keys.

    An empty result means the delete is allowed.
    """
    pk = PRIMARY_KEYS[table][0]
    k = _keys(keys, pk)
    frames = []
    for fk in FOREIGN_KEYS:
        if fk.parent == table and fk.on_delete == "RESTRICT" and fk.child in t:
            child = t[fk.child]
            if fk.child == table:  # self reference: rows being deleted do not block themselves
                child = child.join(k, F.col(pk) == F.col("_key"), "left_anti")
            hits = child.join(k, F.col(fk.column) == F.col("_key"), "left_semi")
            frames.append(hits.agg(F.count(F.lit(1)).alias("referencing_rows"))
                              .select(F.lit(fk.child).alias("child"), F.lit(fk.column).alias("fk"), "referencing_rows"))
    if not frames:
        spark = keys.sparkSession
        return spark.createDataFrame([], "child string, fk string, referencing_rows long")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.where(F.col("referencing_rows") > 0)


def delete_set_null(child: DataFrame, fk: str, keys: DataFrame, key_col: str) -> DataFrame:
    """Child rows pointing at deleted keys keep the row with a NULL foreign key."""
    k = _keys(keys, key_col).withColumn("_hit", F.lit(True))
    cols = [F.when(F.col("_hit"), F.lit(None).cast(child.schema[fk].dataType)).otherwise(F.col(fk)).alias(fk)
            if c == fk else F.col(c) for c in child.columns]
    return child.join(k, F.col(fk) == F.col("_key"), "left").select(*cols)


def delete_cascade(t: Tables, table: str, keys: DataFrame, check_restrict: bool = True) -> dict[str, DataFrame]:
    """Remove the keyed rows of ``table`` and, following CASCADE keys, every dependent row.

    RESTRICT children that still reference the keys make the delete fail
    (one aggregate job); SET NULL children keep their rows with NULL keys.
    Returns the rewritten tables (unchanged ones are passed through).
    """
    if check_restrict:
        blocked = restrict_violations(t, table, keys).limit(1).collect()
        if blocked:
            b = blocked[0]
            raise ValueError(f"delete from {table} restricted by {b['child']}.{b['fk']} ({b['referencing_rows']} rows)")
    out = dict(t)
    pending = [(table, keys.select(F.col(PRIMARY_KEYS[table][0])))]
    while pending:
        parent, parent_keys = pending.pop()
        pk = PRIMARY_KEYS[parent][0]
        k = _keys(parent_keys, pk)
        out[parent] = out[parent].join(k, F.col(pk) == F.col("_key"), "left_anti")
        for fk in FOREIGN_KEYS:
            if fk.parent != parent or fk.child not in out or fk.child == parent:
                continue
            if fk.on_delete == "CASCADE":
                child_pk = PRIMARY_KEYS[fk.child]
                doomed = out[fk.child].join(k, F.col(fk.column) == F.col("_key"), "left_semi")
                if len(child_pk) == 1 and any(f2.parent == fk.child for f2 in FOREIGN_KEYS):
                    pending.append((fk.child, doomed.select(child_pk[0])))
                else:
                    out[fk.child] = out[fk.child].join(k, F.col(fk.column) == F.col("_key"), "left_anti")
            elif fk.on_delete == "SET NULL":
                out[fk.child] = delete_set_null(out[fk.child], fk.column, parent_keys, pk)
    return out


def rekey(t: Tables, table: str, mapping: DataFrame) -> dict[str, DataFrame]:
    """I4: ON UPDATE CASCADE: ``mapping(old_key, new_key)`` rewrites the key and every child key.

    The mapping is written once and counted; it is broadcast when small (the
    usual dimension re-key), otherwise every rewrite is a shuffle join.
    """
    pk = PRIMARY_KEYS[table][0]
    m, n = checked_dimension(mapping.select(F.col("old_key").alias("_old"), F.col("new_key").alias("_new")))
    m = maybe_broadcast(m, n)
    out = dict(t)

    def apply(df: DataFrame, col: str) -> DataFrame:
        cols = [F.coalesce(F.col("_new").cast(df.schema[col].dataType), F.col(col)).alias(col) if c == col
                else F.col(c) for c in df.columns]
        return df.join(m, F.col(col) == F.col("_old"), "left").select(*cols)

    out[table] = apply(out[table], pk)
    for fk in FOREIGN_KEYS:
        if fk.parent == table and fk.on_update == "CASCADE" and fk.child in out:
            out[fk.child] = apply(out[fk.child], fk.column)
    return out


def with_defaults(df: DataFrame, table: str) -> DataFrame:
    """Write-time column defaults: an absent column takes its declared default (or NULL).

    A column that is present keeps its values, NULLs included (an explicit
    NULL is not replaced by the default).  Output follows the declared order.
    """
    cols = []
    for f in TABLES[table].fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(DEFAULTS.get((table, f.name))).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def backfill(df: DataFrame, col: str, value) -> DataFrame:
    """NULLs of ``col`` take ``value``."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(df.schema[col].dataType)))


def add_column(df: DataFrame, name: str, dtype: T.DataType | str, default=None) -> DataFrame:
    """Add the column only when absent (a present column, and its data, is left as it is)."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(dtype))


def prepare_variants(variants: DataFrame, order_col: str = "variant_id") -> DataFrame:
    """Normalise codes before writing, then keep the first row per normalised code."""
    normed = variants.withColumn("iso_code", normalize_iso("iso_code"))
    return first_wins(normed, ["iso_code"], order_col).select(*variants.columns)


def enforce_vector_key(vectors: DataFrame, order_col: str = "vector_id") -> DataFrame:
    """I8: one vector per (unit, model), the first by ``order_col``."""
    return first_wins(vectors, ["unit_id", "model_id"], order_col).select(*vectors.columns)


def fallback_id(variants: DataFrame) -> int | None:
    """The fallback variant's id: one single-row aggregate (a bounded scalar)."""
    row = variants.where(F.col("iso_code") == FALLBACK_ISO).agg(F.min("variant_id").alias("v")).first()
    return row["v"]


def assign_variant(df: DataFrame, variants: DataFrame, code_col: str = "iso_code") -> DataFrame:
    """Look the normalised code up; unknown codes are stored under the fallback variant, never NULL.

    ``variants`` is a dimension (broadcast by the caller when size-checked).
    """
    lv = variants.select(F.col("iso_code").alias("_code"), F.col("variant_id").alias("_vid"))
    und = fallback_id(variants)
    return (df.join(lv, normalize_iso(code_col) == F.col("_code"), "left")
              .withColumn("variant_id", F.coalesce(F.col("_vid"), F.lit(und)).cast("int"))
              .drop("_code", "_vid"))


def reclassify(units: DataFrame, results: DataFrame, variants: DataFrame) -> DataFrame:
    """``results(unit_id, variant_id, variant_confidence)`` re-classify units currently under 'und'."""
    und = fallback_id(variants)
    r = results.select("unit_id", F.col("variant_id").alias("_new_vid"),
                       F.col("variant_confidence").alias("_new_conf"))
    joined = units.join(r, "unit_id", "left").withColumn(
        "_change", (F.col("variant_id") == F.lit(und)) & F.col("_new_vid").isNotNull())
    change = F.coalesce(F.col("_change"), F.lit(False))
    return (joined.withColumn("variant_id", F.when(change, F.col("_new_vid")).otherwise(F.col("variant_id")))
                  .withColumn("variant_confidence",
                              F.when(change, F.col("_new_conf")).otherwise(F.col("variant_confidence")))
                  .select(*units.columns))


def migrate_vector_owner(vectors: DataFrame, default_model: int = 1) -> DataFrame:
    """Add the owner column when missing, else back-fill its NULLs; a complete table is unchanged.

    The branch is on the schema (driver-side), no data is collected.
    """
    if "model_id" not in vectors.columns:
        return add_column(vectors, "model_id", "int", default_model)
    return backfill(vectors, "model_id", default_model)
