"""``python -m strideway clean|build|validate|audit``: prepared Parquet tables to a network, and the reports of a finished one.

    clean SOURCES TARGET     SOURCES holds ways, ramps and polygons; TARGET gets the cleaned ones
    build SOURCES TARGET     SOURCES holds ways, ramps, polygons and boroughs (and nodes, tiles, cells if there are any)
    validate NETWORK         NETWORK holds nodes and edges
    audit NETWORK TARGET     TARGET gets a folder of CSV for each finding, and one of their counts
"""

from __future__ import annotations

import argparse
import json
import os

from strideway.operators import audit, findings
from strideway.plans import build
from strideway.session import get_session
from strideway.sinks import exports


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strideway", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["clean", "build", "validate", "audit"])
    parser.add_argument("source")
    parser.add_argument("target", nargs="?")
    parser.add_argument("--settings", help="a JSON file with fields of a build's settings")
    args = parser.parse_args(argv)
    spark = get_session()
    settings = build.Settings()
    if args.settings:
        with open(args.settings, encoding="utf-8") as f:
            settings = build.Settings(**json.load(f))
    read = lambda name: spark.read.parquet(f"{args.source}/{name}")
    if args.command != "validate" and not args.target:
        parser.error(f"{args.command} needs a target")
    if args.command == "clean":
        for name, clean in (("ways", build.clean_lines), ("ramps", build.clean_points), ("polygons", build.clean_polygons)):
            clean(read(name), settings).write.mode("overwrite").parquet(f"{args.target}/{name}")
        return 0
    if args.command == "build":
        edges, curbs = build.schema_map(build.clean_lines(read("ways"), settings), build.clean_points(read("ramps"), settings), build.clean_polygons(read("polygons"), settings), read("boroughs"), settings)
        have = {name: os.path.exists(f"{args.source}/{name}") for name in ("nodes", "tiles", "cells")}
        nodes, edges = build.assemble_network(edges, curbs, settings, read("nodes") if have["nodes"] else None, (read("tiles"), read("cells")) if have["tiles"] and have["cells"] else None)
        nodes.write.mode("overwrite").parquet(f"{args.target}/nodes")
        edges.write.mode("overwrite").parquet(f"{args.target}/edges")
        print(exports.markdown_table(build.topology_report(spark.read.parquet(f"{args.target}/edges"), settings), "Topology"))
        return 0
    nodes, edges = read("nodes"), read("edges")
    failures = build.validate(nodes, edges)
    if args.command == "audit":
        found = findings.findings(nodes, edges, failures=failures)
        for name, one in found.items():
            exports.write_findings(one.rows, f"{args.target}/{name}", list(one.order), one.limit)
        counted = findings.counts(found)
        exports.write_findings(counted, f"{args.target}/counts", ["finding"], None)
        print(exports.markdown_table(counted, "Findings"))
        return 0
    print(exports.markdown_table(audit.failure_rollup(failures, nodes.count() + edges.count()), "Validation"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
