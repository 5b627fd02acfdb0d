"""Command line: build the layers, run the project's tests.

    spark-submit -m starloom build --input DIR --output DIR [--select a,b] [--full-refresh]
    spark-submit -m starloom build --sources DIR --seeds DIR --output DIR
    spark-submit -m starloom test  --input DIR [--layers DIR] [--store-failures DIR]
    spark-submit -m starloom test  --sources DIR --seeds DIR [--layers DIR] [--config FILE]

``--sources`` holds the six source tables (NAME.parquet), ``--seeds`` the three
seed files (NAME.csv); ``--input`` derives both from the test tables instead.
``build`` writes the staging table, the intermediate and dimension tables
and loads the facts incrementally (full on the first run or with
``--full-refresh``). ``--select`` names models, layers (``staging``,
``intermediate``, ``dimensions``, ``facts``, ``marts``) or tags (``tag:bronze``).

``test`` runs the project's schema tests and prints one summary row per test;
failing rows go to ``--store-failures`` when given. Severity is ``warn`` unless
``--severity`` or ``--config`` says ``error``; the conditions on the number of
failures are ``--warn-if`` and ``--error-if`` (``!= 0``). ``--config`` is a JSON
file {test name or pattern with *: {"severity", "warn_if", "error_if"}}, which goes
before the options; of several patterns the last that fits a test holds. The exit
code is 1 if a test ends in ``error``.
"""

from __future__ import annotations

import argparse
import json
from fnmatch import fnmatchcase

from .session import get_session


def _sides(ap: argparse.ArgumentParser) -> None:
    ap.add_argument("--input", default="")
    ap.add_argument("--sources", default="")
    ap.add_argument("--seeds", default="")


def declare(checks: list, rules: dict[str, dict], severity: str = "warn") -> None:
    """Set severity and conditions of ``checks`` by patterns of their names."""
    for ch in checks:
        ch.severity = severity
        for pattern, rule in rules.items():
            if unknown := set(rule) - {"severity", "warn_if", "error_if"}:
                raise ValueError(f"{pattern}: unknown settings {sorted(unknown)}")
            if fnmatchcase(ch.name, pattern):
                for k, v in rule.items():
                    setattr(ch, k, v)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="starloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build")
    _sides(b)
    b.add_argument("--output", required=True)
    b.add_argument("--select", default="")
    b.add_argument("--full-refresh", action="store_true")
    t = sub.add_parser("test")
    _sides(t)
    t.add_argument("--layers", default="")
    t.add_argument("--store-failures", default="")
    t.add_argument("--severity", choices=["warn", "error"], default="warn")
    t.add_argument("--warn-if", default="!= 0")
    t.add_argument("--error-if", default="!= 0")
    t.add_argument("--config", default="")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    if bool(args.input) == bool(args.sources and args.seeds):
        ap.error(f"{args.cmd} needs --input, or --sources with --seeds")
    spark = get_session(args.master)
    from .plans.layers import Warehouse, build_warehouse, read_sources, select_models, stored_warehouse
    if args.cmd == "build":
        models = [m for m in args.select.replace(",", " ").split() if m] or None
        try:
            select_models(models or [])
        except ValueError as e:
            ap.error(str(e))
        print(json.dumps(build_warehouse(spark, args.input, args.output, models, sources_dir=args.sources,
                                         seeds_dir=args.seeds, full_refresh=args.full_refresh)))
        return 0
    from .plans.project_tests import project_checks
    from .operators.quality import run_suite
    from .sources.sinks import store_failures
    sources = read_sources(spark, args.sources, args.seeds) if args.sources else None
    w = stored_warehouse(spark, args.input, args.layers, sources) if args.layers else Warehouse(spark, args.input, sources=sources)
    checks = project_checks(w)
    rules = {}
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            rules = json.load(f)
    declare(checks, rules, args.severity)
    if args.store_failures:
        checks = store_failures(checks, args.store_failures)
    rows = run_suite(checks, args.warn_if, args.error_if).orderBy("check_index").collect()
    for row in rows:
        print(json.dumps(row.asDict()))
    return int(any(row.status == "error" for row in rows))


if __name__ == "__main__":
    raise SystemExit(main())
