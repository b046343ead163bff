"""Command line: ``python -m millrace TOOL [--data DIR] [JSON arguments]``; ``tools`` and ``queries`` list what there is."""

from __future__ import annotations

import argparse
import json
import sys

from millrace import api
from millrace.plans import catalog


def _rows(df) -> list[dict]:
    return [json.loads(r) for r in df.toJSON().take(1000)]


def _shown(result):
    if isinstance(result, api.Page):
        return {"total": result.total, "next_cursor": result.next_cursor, "rows": _rows(result.rows)}
    if hasattr(result, "toJSON"):
        return _rows(result)
    if isinstance(result, dict):
        return {k: _shown(v) for k, v in result.items()}
    return result


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("tool", help=f"one of {', '.join(('tools', 'queries', *api.TOOLS))}")
    parser.add_argument("arguments", nargs="?", default="{}", help="JSON object")
    parser.add_argument("--data", default=".", help="directory of the tables")
    given = parser.parse_args(argv)
    if given.tool in ("tools", "queries"):
        print("\n".join(sorted(api.TOOLS if given.tool == "tools" else catalog.queries())))
        return 0
    try:
        arguments = json.loads(given.arguments)
    except json.JSONDecodeError as e:
        print(f"arguments are no JSON: {e}", file=sys.stderr)
        return 2
    from millrace.session import local_session

    try:
        result = api.Engine(local_session(), given.data).call(given.tool, arguments)
    except api.ArgumentError as e:
        print("\n".join(e.issues), file=sys.stderr)
        return 2
    print(json.dumps(_shown(result), ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
