"""Command line: ``python -m carryover migrate|verify|validate|stage-tables|stage-export``.

``migrate -c config.yaml [-t a,b] [--parallelism n] [-q checks.sql]`` runs
the batch, prints the report and optionally runs a check file in the same
session; exit code 1 if any table failed or mismatched, or a check failed.
``verify -c config.yaml -q checks.sql`` runs a check file; exit code 1 if
any check failed, also when the file is missing.
Both start a session from the config and stop it at the end.
``validate -c config.yaml`` checks a config without Spark.  ``stage-tables``
and ``stage-export`` load sample tables into a catalog, or export them as
``ds=`` trees, from ``name=path`` arguments.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from .config import load_config
from .plans.batch import run_migration, select_tables
from .plans.checks import load_checks, run_check_file, run_checks
from .plans.profiles import build_session


def _session(cfg):
    return build_session(cfg.settings, master=cfg.master, app_name=cfg.app_name)


def cmd_migrate(args: argparse.Namespace) -> int:
    cfg = load_config(args.config)
    tables = select_tables(cfg.tables, args.tables)
    if not tables:
        logging.warning("no tables to migrate")
        return 0
    parsed = None
    if args.checks:  # read the check file first: a wrong path must not cost a migration
        try:
            parsed = load_checks(args.checks)
        except (OSError, UnicodeDecodeError) as exc:  # missing, a folder, unreadable, not text
            print(f"cannot read check file {args.checks}: {exc}")
            return 1
    spark = _session(cfg)
    run = None
    try:
        rows = run_migration(
            spark, cfg.source, tables, cfg.options,
            targets=cfg.targets, parallelism=args.parallelism, scheduler_pool=cfg.pool,
            timeout=cfg.timeout, retries=cfg.retries, longest_first=cfg.longest_first,
        ).collect()
        if parsed is not None:
            run = run_checks(spark, parsed, parallelism=args.parallelism, scheduler_pool=cfg.pool, fuse=args.fuse)
            checks = run.report.collect()
    finally:
        spark.stop()
    ok = sum(1 for r in rows if r["status"] == "success")
    if args.json:
        for r in rows:
            print(json.dumps({"kind": "table", **r.asDict()}, default=str))
        for r in checks if run is not None else []:
            print(json.dumps({"kind": "check", **r.asDict()}, default=str))
        return 0 if ok == len(rows) and (run is None or run.exit_code == 0) else 1
    _print_table(
        ["status", "source", "target", "source_rows", "target_rows", "error"],
        [[r["status"], r["source"], r["target"] or "", r["source_rows"], r["target_rows"], r["error"] or ""] for r in rows],
    )
    print(f"tables: {ok} ok, {len(rows) - ok} not ok")
    if run is not None:
        _print_checks(run, checks)
    return 0 if ok == len(rows) and (run is None or run.exit_code == 0) else 1


def _print_table(header: list[str], body: list[list[object]]) -> None:
    cells = [header] + [["" if v is None else str(v) for v in row] for row in body]
    widths = [max(len(row[i]) for row in cells) for i in range(len(header))]
    for row in cells:
        print("  ".join(v.ljust(w) for v, w in zip(row, widths)).rstrip())


def _print_checks(run, report_rows) -> None:
    _print_table(
        ["#", "kind", "status", "label", "detail"],
        [[r["position"], r["kind"], r["status"], r["label"], r["detail"] or ""] for r in report_rows],
    )
    for label, sample in run.samples.items():
        print(f"-- {label}")
        for row in sample:
            print(f"   {row}")
    print(f"checks: {run.passed} passed, {run.failed} failed")


def cmd_verify(args: argparse.Namespace) -> int:
    cfg = load_config(args.config)
    spark = _session(cfg)
    try:
        try:
            run = run_check_file(spark, args.checks, parallelism=args.parallelism, fuse=args.fuse)
        except (OSError, UnicodeDecodeError) as exc:
            print(f"cannot read check file {args.checks}: {exc}")
            return 1
        if args.json:
            for r in run.report.collect():
                print(json.dumps({"kind": "check", **r.asDict()}, default=str))
        else:
            _print_checks(run, run.report.collect())
        return run.exit_code
    finally:
        spark.stop()


def cmd_validate(args: argparse.Namespace) -> int:
    """Check a config file without starting Spark."""
    try:
        cfg = load_config(args.config)
    except Exception as exc:  # noqa: BLE001 - any problem with the file is the answer
        print(f"invalid: {type(exc).__name__}: {exc}")
        return 1
    o = cfg.options
    print(
        f"valid: source={cfg.source.kind} catalog={cfg.catalog_kind}:{o.catalog} database={o.database} "
        f"mode={o.mode} tables={len(cfg.tables)}"
    )
    return 0


def _named_inputs(items: list[str]) -> dict[str, str]:
    inputs = {}
    for item in items:
        name, sep, path = item.partition("=")
        if not sep or not name or not path:
            raise SystemExit(f"expected name=path, got {item!r}")
        inputs[name] = path
    return inputs


def _stage_settings(args: argparse.Namespace) -> dict[str, str]:
    """Session settings of the staging commands: a run configuration's, or those given one by one."""
    from .sources import CatalogSource, s3a_settings

    settings = {"spark.ui.enabled": "false"}
    if args.config:
        settings |= load_config(args.config).settings
    if args.metastore_uri:
        settings |= CatalogSource(metastore_uri=args.metastore_uri).session_settings()
    settings |= s3a_settings(args.endpoint, args.access_key, args.secret_key)
    return settings


def cmd_stage_tables(args: argparse.Namespace) -> int:
    from .plans.staging import stage_tables

    spark = build_session(_stage_settings(args), master=args.master, app_name="carryover-stage")
    try:
        rows = stage_tables(spark, _named_inputs(args.inputs), args.database, max_rows=args.rows).collect()
    finally:
        spark.stop()
    _print_table(["name", "target", "n_rows", "status", "error"], [[r[c] for c in ("name", "target", "n_rows", "status", "error")] for r in rows])
    return 0 if all(r["status"] == "success" for r in rows) else 1


def cmd_stage_export(args: argparse.Namespace) -> int:
    from .plans.staging import stage_exports

    spark = build_session(_stage_settings(args), master=args.master, app_name="carryover-stage")
    try:
        rows = stage_exports(
            spark, _named_inputs(args.inputs), args.root, max_rows=args.rows,
            ds_values=[d.strip() for d in args.ds.split(",") if d.strip()],
        ).collect()
    finally:
        spark.stop()
    _print_table(["name", "ds", "n_rows", "error"], [[r["name"], r["ds"], r["n_rows"], r["error"]] for r in rows])
    return 0 if all(r["error"] is None for r in rows) else 1


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="carryover")
    parser.add_argument("-v", "--verbose", action="store_true")
    sub = parser.add_subparsers(dest="command", required=True)
    m = sub.add_parser("migrate", help="copy or register the configured tables")
    m.add_argument("-c", "--config", default="config.yaml")
    m.add_argument("-t", "--tables", default=None, help="comma-separated subset of tables")
    m.add_argument("--parallelism", type=int, default=4, help="tables (and checks) in flight at once")
    m.add_argument("--fuse", action="store_true", help="answer the plain assertions of a table by one scan of it")
    m.add_argument("-q", "--checks", default=None, help="check file to run afterwards in the same session")
    m.add_argument("--json", action="store_true", help="one JSON object per report row")
    m.set_defaults(func=cmd_migrate)
    v = sub.add_parser("verify", help="run a file of SQL checks")
    v.add_argument("-c", "--config", default="config.yaml")
    v.add_argument("-q", "--checks", required=True)
    v.add_argument("--parallelism", type=int, default=4, help="checks in flight at once")
    v.add_argument("--fuse", action="store_true", help="answer the plain assertions of a table by one scan of it")
    v.add_argument("--json", action="store_true", help="one JSON object per check")
    v.set_defaults(func=cmd_verify)
    c = sub.add_parser("validate", help="check a config file (no Spark)")
    c.add_argument("-c", "--config", default="config.yaml")
    c.set_defaults(func=cmd_validate)
    t = sub.add_parser("stage-tables", help="load Parquet files into catalog tables (overwrite)")
    t.add_argument("inputs", nargs="+", help="name=path")
    t.add_argument("--database", required=True)
    t.add_argument("--rows", type=int, default=10_000, help="rows per table, 0 = all")
    t.add_argument("--master", default="local[*]")
    t.set_defaults(func=cmd_stage_tables)
    e = sub.add_parser("stage-export", help="export Parquet files as ds= partitioned trees (append)")
    e.add_argument("inputs", nargs="+", help="name=path")
    e.add_argument("--root", required=True, help="output folder; one tree per name below it")
    e.add_argument("--rows", type=int, default=10_000, help="rows per table, 0 = all")
    e.add_argument("--ds", default="2024-01-15,2024-01-16", help="comma-separated ds values")
    e.add_argument("--master", default="local[*]")
    e.set_defaults(func=cmd_stage_export)
    for p in (t, e):  # tables that outlive the command need a metastore; s3a:// paths need an endpoint
        p.add_argument("-c", "--config", default=None, help="take session settings from a run configuration")
        p.add_argument("--metastore-uri", default=None)
        p.add_argument("--endpoint", default=None, help="S3A endpoint")
        p.add_argument("--access-key", default=None)
        p.add_argument("--secret-key", default=None)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    return int(args.func(args))


if __name__ == "__main__":
    sys.exit(main())
