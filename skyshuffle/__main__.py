"""Command line: python -m skyshuffle project init | stage-00 | stage-01 | stage-02 | stage-03 | stats."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import stages
from .functions import text
from .project import load_project, template


def _point(value: str) -> tuple[float, float, float]:
    parts = value.split(",")
    if len(parts) != 3:
        raise argparse.ArgumentTypeError("a point is X,Y,Z")
    return tuple(float(p) for p in parts)


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyshuffle")
    sub = top.add_subparsers(dest="command", required=True)
    project = sub.add_parser("project").add_subparsers(dest="action", required=True).add_parser("init", help="write a project file")
    for init in (project, sub.add_parser("project-init", help="the same as project init")):
        init.add_argument("path", type=Path)
    for name in ("stage-00", "stage-01", "stage-02", "stage-03"):
        p = sub.add_parser(name)
        p.add_argument("--project", required=True, type=Path)
        if name == "stage-00":
            p.add_argument("--force", action="store_true", help="rebuild finished pixels")
        if name == "stage-03":
            p.add_argument("--family")
    p = sub.add_parser("stats", help="what a bounded query touches")
    p.add_argument("tree")
    p.add_argument("--point", "--center", "--centre", type=_point, default=(0.0, 0.0, 0.0))
    p.add_argument("--magnitude", type=float, default=6.5)
    p.add_argument("--radius", type=float, default=10.0)
    p.add_argument("--nearest", "--stars", "-n", type=int, default=10)
    p.add_argument("--meta-tree")
    return top


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.command in ("project", "project-init"):
        if args.path.exists():
            print(f"{args.path} exists", file=sys.stderr)
            return 1
        args.path.write_text(template())
        return 0
    if args.command == "stats" and (args.radius < 0 or args.nearest <= 0):
        print("radius must be >= 0 and nearest > 0", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("skyshuffle").getOrCreate()
    try:
        if args.command == "stats":
            out = stages.statistics(spark, args.tree, args.point, args.magnitude, args.radius, args.nearest, args.meta_tree)
            q = [F.col(c) for c in ("mag_min", "mag_p25", "mag_p50", "mag_p75", "mag_max")]
            out["levels"].select("level", "nodes", "stars_loaded", "stars_rendered", text.kilobytes(F.col("payload_bytes")).alias("payload"), text.quartiles(*q).alias("magnitudes")).show(100, False)
            out["ranges"].show(1, False)
            out["nearest"].withColumn("teff", text.kelvin(F.col("teff"))).show(args.nearest, False)
            return 0
        project = load_project(args.project)
        if args.command == "stage-00":
            print(f"{stages.stage00(spark, project, args.force)} pixel(s) written")
        elif args.command == "stage-03":
            print("\n".join(stages.stage03(spark, project, args.family)))
        else:
            print({"stage-01": stages.stage01, "stage-02": stages.stage02}[args.command](spark, project))
    except ValueError as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
