"""Load, check and report from the command line, for ``spark-submit`` or ``python -m``.

    tierline load INPUT_DIR ROOT [--exact] [--strict] [--escape CHAR|both] [--multi-line]
                  [--enforce] [--by-month] [--collation NAME] [--catalog PREFIX]
    tierline append INPUT_DIR ROOT LOAD_ID [--escape CHAR|both] [--multi-line]
    tierline check ROOT {bronze,silver,gold} [--public-volumes] [--exact]
    tierline account ROOT
    tierline report ROOT NAME
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tierline.plans import clean_suite, pipeline, raw_suite, run_checks, star_suite
from tierline.plans.reports import FOOTER_REPORTS, REPORTS
from tierline.plans.suites import PUBLIC_DATA_ROWS
from tierline.session import sized


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tierline")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="CSV files to raw, clean and star tables")
    load.add_argument("input_dir")
    load.add_argument("root")
    load.add_argument("--exact", action="store_true", help="also quarantine duplicates")
    load.add_argument("--strict", action="store_true", help="also quarantine malformed records")
    load.add_argument("--enforce", action="store_true", help="publish only if constraints hold")
    load.add_argument("--by-month", action="store_true", help="store the fact in monthly folders")
    load.add_argument("--collation", help="compare keys by it, such as UNICODE_CI_AI")
    load.add_argument("--catalog", metavar="PREFIX", help="name the tables in the catalog")
    append = commands.add_parser("append", help="add CSV files to growing raw tables, once per id")
    append.add_argument("input_dir")
    append.add_argument("root")
    append.add_argument("load_id")
    for command in (load, append):
        command.add_argument("--escape", default="\\", help="escape inside quotes, or 'both'")
        command.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    account = commands.add_parser("account", help="what became of each file's line items")
    account.add_argument("root")
    check = commands.add_parser("check", help="data-quality checks of one layer")
    check.add_argument("root")
    check.add_argument("layer", choices=["bronze", "silver", "gold"])
    check.add_argument("--public-volumes", action="store_true", help="expect the public row counts")
    check.add_argument("--exact", action="store_true", help="every raw row must be accounted for")
    report = commands.add_parser("report", help="one report over the star layer")
    report.add_argument("root")
    report.add_argument("name", choices=sorted(REPORTS))
    return parser


def check_layer(
    spark: SparkSession, root: str, layer: str, *, public_volumes: bool = False, exact: bool = False
) -> DataFrame:
    volumes = PUBLIC_DATA_ROWS if public_volumes else None
    if layer == "bronze":
        return run_checks(layer, pipeline.read_raw(spark, root), raw_suite(volumes, malformed=True))
    clean = pipeline.read_clean(spark, root)
    if layer == "silver":
        tables = {**clean, "raw_order_items": pipeline.read_raw(spark, root)["order_items"]}
        if not exact:
            tables["accepted_order_items"] = pipeline.read_accepted(spark, root)
        return run_checks(layer, tables, clean_suite(volumes, exact=exact))
    tables = {**pipeline.read_star(spark, root), "order_items": clean["order_items"]}
    return run_checks(layer, tables, star_suite())


def main(arguments: list[str] | None = None) -> int:
    """Exit status 1 if a check failed."""
    options = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName("tierline").getOrCreate()
    if options.command == "load":
        pipeline.run(
            spark,
            options.input_dir,
            options.root,
            exact=options.exact,
            escape=options.escape,
            multi_line=options.multi_line,
            strict=options.strict,
            enforce=options.enforce,
            fact_by_month=options.by_month,
            collation=options.collation,
            catalog=options.catalog,
        )
        return 0
    if options.command == "append":
        with sized(spark, options.input_dir):
            pipeline.append_raw(
                spark,
                options.input_dir,
                options.root,
                options.load_id,
                escape=options.escape,
                multi_line=options.multi_line,
            )
        return 0
    with sized(spark, options.root):
        return _answer(spark, options)


def _print(report: DataFrame) -> None:
    print("\t".join(report.columns))
    for row in report.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _answer(spark: SparkSession, options: argparse.Namespace) -> int:
    if options.command == "report":
        quick = options.name in FOOTER_REPORTS
        report = (FOOTER_REPORTS if quick else REPORTS)[options.name]
        _print(report(pipeline.read_star(spark, options.root, footers=quick)))
        return 0
    if options.command == "account":
        found = pipeline.accounting_by_file(spark, options.root).orderBy("source_file")
        _print(found)
        return int(not found.where("unaccounted_rows <> 0").isEmpty())
    results = check_layer(
        spark,
        options.root,
        options.layer,
        public_volumes=options.public_volumes,
        exact=options.exact,
    ).collect()
    for r in results:
        mark = {True: "ok", False: "FAILED", None: "-"}[r.passed]
        print(f"{mark:7}{r.table_name}: {r.check_name}: {r.observed} (expected {r.expected})")
    return int(any(r.passed is False for r in results))


if __name__ == "__main__":
    sys.exit(main())
