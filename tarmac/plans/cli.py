"""Command line: run a layer, or all of them, as a Spark job.

  python -m tarmac.plans.cli all --source bookings=s3a://…/bookings/ \\
      --source passengers=… --source airports=… [--root …]
  python -m tarmac.plans.cli dashboard [--select NAME …] [--all] [--root …]

``--root`` defaults to a folder under the cluster's ``spark.checkpoint.dir``.
Small results reach the driver, printed whole: row counts, the build summary,
the four five-row previews and the dashboard's frames (one row per airport).
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql.types import StructType

from tarmac.config import PipelineConfig, default_config
from tarmac.plans import build_bronze, build_gold
from tarmac.plans.dashboard import DEFAULT, Dashboard
from tarmac.plans.gold import previews
from tarmac.plans.silver import build_silver_audited
from tarmac.schemas import SCHEMAS, SourceSpec
from tarmac.session import build_session

log = logging.getLogger("tarmac")


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tarmac")
    ap.add_argument("layer", choices=["bronze", "silver", "gold", "all", "dashboard"])
    ap.add_argument("--source", action="append", default=[], metavar="NAME=PATH", help="CSV source (bronze)")
    ap.add_argument("--root", help="warehouse root on shared storage")
    ap.add_argument("--catalog")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--on-bad-date", choices=["fail", "null"], default="fail")
    ap.add_argument("--no-sort", action="store_true", help="skip ORDER BY before the gold writes")
    ap.add_argument("--split", action="append", default=[], metavar="NAME", help="split this source's files (no line breaks in quotes)")
    ap.add_argument("--schema", action="append", default=[], metavar="NAME=DDL", help="types of this source's columns")
    ap.add_argument("--infer", action="append", default=[], metavar="NAME", help="infer this source's types from its values")
    ap.add_argument("--infer-exact", action="append", default=[], metavar="NAME", help="infer types that write every value back as it was")
    ap.add_argument("--master")
    ap.add_argument("--select", action="append", metavar="AIRPORT", help="dashboard: airport name to show")
    ap.add_argument("--all", action="store_true", help="dashboard: every airport")
    return ap.parse_args(argv)


def main(argv=None) -> int:
    args = parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="{levelname:<7} {name}: {message}", style="{")
    spark = build_session("tarmac", master=args.master)
    options = dict(
        catalog=args.catalog,
        format=args.format,
        on_bad_date=args.on_bad_date,
        sort_output=not args.no_sort,
    )
    cfg = PipelineConfig(root=args.root, **options) if args.root else default_config(spark, **options)
    sources = source_specs(args)
    if args.layer in ("bronze", "all"):
        if not sources:
            raise SystemExit("bronze needs --source NAME=PATH for bookings, passengers and airports")
        log.info("bronze → %s", cfg.location("bronze"))
        show_whole(build_bronze(spark, cfg, sources))
    if args.layer in ("silver", "all"):
        log.info("silver → %s", cfg.location("silver"))
        for frame in build_silver_audited(spark, cfg):
            show_whole(frame)
    if args.layer in ("gold", "all"):
        log.info("gold → %s", cfg.location("gold"))
        show_whole(build_gold(spark, cfg))
        for name, df in previews(spark, cfg).items():
            log.info("sample: %s", name)
            show_whole(df)
    if args.layer == "dashboard":
        show_dashboard(spark, cfg, None if args.all else (args.select or DEFAULT))
    spark.stop()
    return 0


def source_specs(args: argparse.Namespace) -> dict[str, SourceSpec]:
    """The named sources with their paths, types and parse modes."""
    paths = dict(s.split("=", 1) for s in args.source)
    given = {name: StructType.fromDDL(ddl) for name, ddl in (s.split("=", 1) for s in args.schema)}
    inferred = {*args.infer, *args.infer_exact}
    unknown = {*given, *args.split, *inferred} - set(paths)
    if unknown:
        raise SystemExit(f"no --source for {sorted(unknown)}")
    return {
        name: SourceSpec(
            name,
            path,
            None if name in inferred else given.get(name, SCHEMAS.get(name)),
            name not in args.split,
            "exact" if name in args.infer_exact else "plain",
        )
        for name, path in paths.items()
    }


def show_whole(df) -> None:
    """Print every row of a listing (one row per table, or a few)."""
    whole = df.cache()
    whole.show(max(1, whole.count()), truncate=False)
    whole.unpersist()


def show_dashboard(spark, cfg: PipelineConfig, selection) -> None:
    """Print the data of both tabs (KPIs, series, tables) for a selection."""
    board = Dashboard(spark, cfg)
    try:
        for tab, frames in (("revenue", board.revenue_tab(selection)), ("performance", board.performance_tab(selection))):
            for name, df in frames.items():
                log.info("%s / %s", tab, name)
                order = [c for c in ("position", "rank") if c in df.columns]
                show_whole(df.orderBy(*order) if order else df)
    finally:
        board.close()


if __name__ == "__main__":
    raise SystemExit(main())
