"""Loading and publishing.

Tables are Parquet folders.  A publish writes every table into a fresh
version folder, runs the contracts on what was written, and only then
creates the version's ``_PUBLISHED`` marker (a single atomic file
creation).  Readers take the newest version that has the marker, so they
see all tables of a version or none.  Jobs are re-runnable: a failed
attempt leaves an unmarked folder that no reader picks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.operators.dedup import both_large, first_wins
from glossa.schemas import EXPORT_MIN_CONFIDENCE, TABLES
from glossa.operators import incremental
from glossa.functions.scalars import eligible

MARKER = "_PUBLISHED"
LOAD_REPORT = "target string, kind string, rows long"


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """A4: the batch rows to append: first per key inside the batch, and only keys the target lacks.

    (``INSERT ... ON CONFLICT (key) DO NOTHING``: the stored row is untouched.)
    One row per key goes in, also where rows tie in ``order`` or none is given
    (the row with the least hash of all its columns).
    """
    b = first_wins(batch, list(keys), order if order else F.lit(0)).select(*batch.columns)
    return b.join(both_large(target.select(*keys).distinct()), list(keys), "left_anti")


def append(target_path: str, batch: DataFrame) -> dict[str, int]:
    """A5: plain append (tables whose only key is generated repeat rows on re-run); rows written, counted by the write."""
    seen = Observation("append")
    batch.observe(seen, F.count(F.lit(1)).alias("written")).write.mode("append").parquet(target_path)
    return {"written": seen.get["written"], "skipped": 0}


def append_if_absent(target_path: str, batch: DataFrame, keys: Sequence[str], order: str | None = None) -> dict[str, int]:
    """A4 with A7: append what ``insert_if_absent`` would; {"written", "skipped"} rows, counted by the write job itself.

    Nothing is scanned again for the counts.  Each key's rows are counted where the first one is picked, and the rows that
    are stored already are marked instead of dropped, so both counts are taken in the job's last stage: Spark adds up
    the metrics of a last stage's task once, however often tasks of earlier stages are repeated.  NULL keys never
    conflict with stored rows and are one key inside the batch.  ``target_path`` need not exist.
    """
    spark = batch.sparkSession
    fs, p = _fs(spark, target_path)
    target = spark.read.schema(batch.schema).parquet(target_path) if fs.exists(p) else spark.createDataFrame([], batch.schema)
    first = first_wins(batch, list(keys), order if order else F.lit(0)).select(*batch.columns)
    rows = batch.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_rows"))
    stored = target.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(keys)]).distinct().withColumn("_stored", F.lit(True))
    counted = first.join(both_large(rows), [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)])
    marked = counted.join(both_large(stored), [F.col(c) == F.col(f"_s{i}") for i, c in enumerate(keys)], "left")
    seen, fresh = Observation("append_if_absent"), F.col("_stored").isNull()
    out = marked.observe(seen, F.count_if(fresh).alias("written"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"))
    out.where(fresh).select(*batch.columns).write.mode("append").parquet(target_path)
    return {"written": seen.get["written"], "skipped": seen.get["rows"] - seen.get["written"]}


def load_report(frames: Mapping[str, DataFrame], skipped: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows written per target (and skipped), as one union of counts."""
    spark = next(iter(frames.values())).sparkSession
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("target"), F.lit("written").alias("kind"), "rows")
             for name, df in frames.items()]
    for name, df in (skipped or {}).items():
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("target"), F.lit("skipped").alias("kind"), "rows"))
    out = parts[0] if parts else spark.createDataFrame([], "target string, kind string, rows long")
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _published_versions(spark: SparkSession, root: str) -> list[str]:
    """Version folders under ``root`` that carry the publish marker, oldest first (driver-side listing)."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    jvm = spark.sparkContext._jvm
    names = sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())
    return [v for v in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{v}/{MARKER}"))]


def current_version(spark: SparkSession, root: str) -> str | None:
    """Newest published version under ``root``."""
    versions = _published_versions(spark, root)
    return versions[-1] if versions else None


def _appended_tables(spark: SparkSession, root: str, version: str) -> list[str]:
    """The manifest in the version's marker (read with the filesystem API: Spark's readers skip '_' files)."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/{version}/{MARKER}")
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return json.loads(line).get("appended", []) if line else []


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """A10: the twelve tables as of the newest published version, each with its declared schema; a table that no
    version holds is empty."""
    out = {}
    for t in TABLES:
        try:
            out[t] = read_current(spark, root, t)
        except FileNotFoundError:
            out[t] = spark.createDataFrame([], TABLES[t])
    return out


def _typed(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """A10: the files with the table's declared schema; nothing is inferred for the twelve tables."""
    reader = spark.read.schema(TABLES[table]) if table in TABLES else spark.read
    return reader.parquet(*paths)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of the newest published version, with its declared schema (columns that its files lack are NULL).

    Append-only tables are the union of every published version's folder (each
    holds only that load's new rows); other tables are read from the newest
    version alone.
    """
    versions = _published_versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"nothing published under {root}")
    base = root.rstrip("/")
    if table in _appended_tables(spark, root, versions[-1]):
        fs, _ = _fs(spark, base)
        jvm = spark.sparkContext._jvm
        paths = [f"{base}/{v}/{table}" for v in versions if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{base}/{v}/{table}"))]
        return _typed(spark, table, paths)
    fs, path = _fs(spark, f"{base}/{versions[-1]}/{table}")
    if not fs.exists(path):
        raise FileNotFoundError(f"{versions[-1]} under {root} has no {table}")
    return _typed(spark, table, [f"{base}/{versions[-1]}/{table}"])


def read_load_report(spark: SparkSession, root: str, version: str) -> DataFrame:
    """The rows that each table's write job of a version counted."""
    return spark.read.schema(LOAD_REPORT).parquet(f"{root.rstrip('/')}/{version}/_load_report")


def publish(frames: Mapping[str, DataFrame], root: str, contracts=None, version: str | None = None,
            partition_by: Mapping[str, Sequence[str]] | None = None,
            appended: Sequence[str] = (), by_load: bool = False) -> tuple[str, DataFrame | None]:
    """Write all tables to a new version folder, gate on the contracts, then mark it published.

    Tables named in ``appended`` are append-only: ``frames`` holds only their
    new rows, which are written to this version's folder; readers see the
    union over all published versions, so a re-load never copies what is
    already stored.  ``contracts(tables) -> results`` runs on what readers
    would see; any FAIL leaves the version unmarked (invisible) and raises.
    ``by_load`` runs the twenty contracts on this load's rows and the ledger
    beside the newest version instead (``glossa.operators.incremental``), so a
    small load reads no stored text; the results are the same.
    Published versions are never rewritten.  Versions are ordered by name: the
    default names (``vYYYYMMDDTHHMMSS``) sort in publication order, and custom
    names must too.  The rows written per table are counted by the writes (``read_load_report``).
    """
    spark = next(iter(frames.values())).sparkSession
    version = version or f"v{time.strftime('%Y%m%dT%H%M%S')}"
    base = f"{root.rstrip('/')}/{version}"
    fs, marker_path = _fs(spark, f"{base}/{MARKER}")
    newest = max(_published_versions(spark, root), default="")
    if version < newest:  # readers take the version that sorts last
        raise ValueError(f"{version} sorts before the published {newest}")
    if fs.exists(marker_path):  # published versions are immutable: readers may be using them
        raise FileExistsError(f"{version} is already published under {root}")
    written = []
    for name, df in frames.items():
        seen = Observation(name)
        w = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        cols = (partition_by or {}).get(name)
        if cols:
            w = w.partitionBy(*cols)
        w.parquet(f"{base}/{name}")
        written.append((name, "written", seen.get["rows"]))
    spark.createDataFrame(written, LOAD_REPORT).write.mode("overwrite").parquet(f"{base}/_load_report")
    results = None
    if contracts is not None or by_load:
        earlier = _published_versions(spark, root)
        jvm = spark.sparkContext._jvm

        def paths(name: str, versions: Sequence[str]) -> list[str]:
            return [p for v in versions if fs.exists(jvm.org.apache.hadoop.fs.Path(p := f"{root.rstrip('/')}/{v}/{name}"))]

        def read(name: str, found: list[str]) -> DataFrame:
            return spark.read.schema(frames[name].schema).parquet(*found)

        if by_load:
            ledger_at = f"{root.rstrip('/')}/{earlier[-1]}/_ledger" if earlier else ""
            known = bool(earlier) and fs.exists(jvm.org.apache.hadoop.fs.Path(ledger_at))
            # without a ledger (versions published before there was one) everything counts as this load's
            own = [version] if known or not earlier else [*earlier, version]
            now = {name: read(name, paths(name, own if name in appended else [version])) for name in frames}
            stored = {name: read(name, found) for name in frames if name in appended and known and (found := paths(name, earlier))}
            results, ledger = incremental.run_contracts(now, stored, incremental.Ledger.read(spark, ledger_at) if known else None,
                                                        [name for name in frames if name not in appended])
            ledger.write(f"{base}/_ledger")
        else:
            results = contracts({name: read(name, paths(name, [*(earlier if name in appended else ()), version])) for name in frames})
        # every result is kept beside the version; the error names the folder and the number of failures
        results.write.mode("overwrite").parquet(f"{base}/_contracts")
        results = spark.read.schema(results.schema).parquet(f"{base}/_contracts")
        failures = results.where(F.col("status").startswith("FAIL")).groupBy("check").count().orderBy("check").collect()
        if failures:
            raise RuntimeError(f"contracts failed, {version} not published: {[tuple(r) for r in failures]}; all results in {base}/_contracts")
    out = fs.create(marker_path, False)
    out.write(bytearray(json.dumps({"appended": sorted(appended)}).encode("utf-8")))
    out.close()
    return version, results


def export_training(units: DataFrame, variants: DataFrame, path: str,
                    min_conf: float = EXPORT_MIN_CONFIDENCE) -> DataFrame:
    """A9 (+B7): eligible units (classified, confidence >= min_conf) written as Parquet by language.

    Returns the exported frame as read back (partition pruning by ``iso_code`` for readers).
    """
    rows = (units.where(eligible("variant_id", "variant_confidence", min_conf))
                 .join(variants.select("variant_id", "iso_code"), "variant_id"))
    rows.write.mode("overwrite").partitionBy("iso_code").parquet(path)
    # read back with the known schema: an export with no eligible row has no file to infer one from
    ordered = [f for f in rows.schema.fields if f.name != "iso_code"] + [rows.schema["iso_code"]]
    return units.sparkSession.read.schema(T.StructType(ordered)).parquet(path)
