"""Command line: ``python -m glossa <command> ...``

  load EXPORT ROOT [--format export|jsonl] [--import-date YYYY-MM-DD]
      read an export, build the twelve tables, gate on the contracts, publish a new version under ROOT
  contracts ROOT
      run every contract on the published version under ROOT and print the results and the gate
  export ROOT OUT [--min-confidence 0.7]
      write the eligible units of the published version to OUT, partitioned by language

The session comes from the environment (spark-submit / PYSPARK_SUBMIT_ARGS); the checkpoint
folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="glossa")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_load = sub.add_parser("load")
    p_load.add_argument("export")
    p_load.add_argument("root")
    p_load.add_argument("--format", default="export", choices=["export", "jsonl"])
    p_load.add_argument("--import-date")
    p_con = sub.add_parser("contracts")
    p_con.add_argument("root")
    p_exp = sub.add_parser("export")
    p_exp.add_argument("root")
    p_exp.add_argument("out")
    p_exp.add_argument("--min-confidence", type=float, default=0.7)
    args = ap.parse_args(argv)

    from glossa.schemas import TABLE_NAMES
    from glossa.session import ensure_checkpoint_dir
    from glossa.sources.sinks import current_version, read_current

    spark = SparkSession.builder.appName(f"glossa-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "load":
        from glossa.plans.load import load_export
        version, results = load_export(spark, args.export, args.root, args.format, args.import_date)
        print(f"published {version}")
        for row in results.orderBy("check", "subject").toLocalIterator():
            print(*row, sep=" | ")
        return 0
    if current_version(spark, args.root) is None:
        print(f"nothing published under {args.root}", file=sys.stderr)
        return 1
    tables = {t: read_current(spark, args.root, t) for t in TABLE_NAMES}
    if args.cmd == "contracts":
        from glossa.operators.contracts import gate, run_contracts
        results = run_contracts(tables)
        for row in results.orderBy("check", "subject").toLocalIterator():
            print(*row, sep=" | ")
        verdict = gate(results).first()
        print(f"checks={verdict.checks} failures={verdict.failures} warnings={verdict.warnings}")
        return 0 if verdict.publish else 2
    from glossa.sources.sinks import export_training
    out = export_training(tables["content_unit"], tables["language_variant"], args.out, args.min_confidence)
    print(f"exported {out.count()} rows to {args.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
