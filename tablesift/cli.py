"""Command line over the library: run a registered query, list them, or check schemas.

    python -m tablesift.cli list
    python -m tablesift.cli run gate_status /path/to/tables [--out folder]
    python -m tablesift.cli schemas /path/to/yaml
"""

from __future__ import annotations

import argparse
import sys

from tablesift.plans import catalog
from tablesift.session import local_session
from tablesift.sources.registry import SchemaError, load_schemas


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tablesift")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names of all queries")
    run = commands.add_parser("run", help="run a query over a folder of tables")
    run.add_argument("name", choices=sorted(catalog.queries()))
    run.add_argument("tables")
    run.add_argument("--out", help="write parquet there instead of showing rows")
    run.add_argument("--cpus", type=int, default=8)
    schemas = commands.add_parser("schemas", help="check a folder of table schemas")
    schemas.add_argument("folder")
    given = parser.parse_args(arguments)
    if given.command == "list":
        print("\n".join(sorted(catalog.queries())))
        return 0
    if given.command == "schemas":
        try:
            found = load_schemas(given.folder)
        except SchemaError as problem:
            print(problem, file=sys.stderr)
            return 1
        print("\n".join(sorted({s["format_id"] for s in found.values()})))
        return 0
    result = catalog.queries()[given.name](local_session(given.cpus), given.tables)
    if given.out:
        result.write.mode("overwrite").parquet(given.out)
    else:
        result.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
