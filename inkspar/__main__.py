"""Commands over captured archives: backup, restore, migrate, extract, audit, audit-captures, archive-audit, archive-feeds, build, update-pages.

Exit codes: 0 done, 1 incomplete or held, 2 invalid input.
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="inkspar")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("backup", "restore"):
        p = commands.add_parser(name)
        p.add_argument("source")
        p.add_argument("target")
        for option, given in (("--areas", "current archive"), ("--folders", "entries responses states"), ("--files", "inventory.json report.json")):
            p.add_argument(option, nargs="+", default=given.split())
    commands.add_parser("migrate").add_argument("folder")
    for name in ("audit", "build", "update-pages"):
        p = commands.add_parser(name)
        for option in ("--current", "--archive", "--feeds", "--states", "--holds", "--cache"):
            p.add_argument(option)
        if name == "build":
            p.add_argument("out")
            p.add_argument("--sqlite")
        if name == "audit":
            p.add_argument("--bodies")
            p.add_argument("--ids")
        else:
            p.add_argument("--pages", required=name == "update-pages")
    for name, folders in (("extract", ("index", "bodies", "out", "states")), ("audit-captures", ("index", "bodies", "records")), ("archive-audit", ("index", "bodies", "records", "states")), ("archive-feeds", ("index", "bodies", "out", "states"))):
        p = commands.add_parser(name)
        for folder in folders:
            p.add_argument(folder)
        if name != "archive-feeds":
            for option in ("--reviews", "--omissions", "--current"):
                p.add_argument(option)
        if name == "archive-audit":
            p.add_argument("--holds")
            p.add_argument("--cache")
            p.add_argument("--write-states", action="store_true")
        if name == "archive-feeds":
            for option in ("--current", "--archive"):
                p.add_argument(option)
            for option in ("--host", "--page-path", "--label-field"):
                p.add_argument(option, required=True)
            p.add_argument("--feed-path", action="append", required=True)
            p.add_argument("--archive-host", default="archive.example.org")
    return parser


def run(arguments: list[str]) -> int:
    args = _parser().parse_args(arguments)
    try:
        if args.command in ("backup", "restore"):
            from inkspar.sources import bundle

            rule = (tuple(args.areas), tuple(args.folders), tuple(args.files))
            rows = (bundle.backup if args.command == "backup" else bundle.restore)(args.source, args.target, *rule)
            print(json.dumps({"files": len(rows), "bytes": sum(r["bytes"] for r in rows)}))
            return 0
        if args.command == "migrate":
            from inkspar.sources import records

            print(json.dumps({"moved": records.migrate(args.folder)}))
            return 0
        from pyspark.sql import SparkSession

        from inkspar import archive
        from inkspar.functions.urls import Scope
        from inkspar.shipping import ship

        spark = SparkSession.builder.appName("inkspar").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        ship(spark)
        decided = archive.decisions(spark, args.reviews, args.omissions, args.current) if hasattr(args, "reviews") else None
        if args.command == "extract":
            counts = archive.extract(spark, args.index, args.bodies, args.out, args.states, decided)
            print(json.dumps(counts))
            return 0 if set(counts) <= {"parsed", "excluded"} else 1
        if args.command == "audit-captures":
            counts = {r["outcome"]: r["count"] for r in archive.audit_captures(spark, args.index, args.bodies, args.records, decided).groupBy("outcome").count().collect()}
            print(json.dumps(counts))
            return 0 if set(counts) <= {"equal"} else 1
        if args.command == "archive-audit":
            report = archive.archive_audit(spark, args.index, args.bodies, args.records, args.states, args.holds, args.cache, args.write_states, decided)
            print(json.dumps(report))
            return 0 if report["export_ready"] else 1
        if args.command == "archive-feeds":
            scope = Scope(hosts=(args.host,), page_path=args.page_path, label_field=args.label_field, feed_paths=tuple(args.feed_path), archive_host=args.archive_host)
            counts = archive.extract_feeds(spark, args.index, args.bodies, args.out, args.states, scope, args.current, args.archive)
            print(json.dumps(counts))
            return 0 if set(counts) <= {"parsed"} else 1
        folders = {"current_folder": args.current, "archive_folder": args.archive, "feed_folder": args.feeds}
        if not any(folders.values()):
            raise ValueError("no folder of records is named")
        folders |= {"states": args.states, "holds": args.holds, "cache": args.cache}
        if args.command == "audit":
            report = archive.audit(spark, args.bodies, args.ids, **folders)
            print(json.dumps(report))
            return 0 if report["export_ready"] else 1
        if args.command == "build":
            print(json.dumps(archive.build(spark, args.out, args.sqlite, args.pages, **folders)))
        else:
            print(json.dumps({k: len(v) for k, v in archive.update_pages(spark, args.pages, **folders).items()}))
        return 0
    except (ValueError, OSError) as error:
        print(f"inkspar: {error}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(run(sys.argv[1:]))
