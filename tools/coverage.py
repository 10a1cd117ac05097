"""Print the SURVEY §2 operator -> registered query map (markdown)."""

from __future__ import annotations

import re
import sys
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from mound.plans.registry import load_all  # noqa: E402


def main():
    by_op = defaultdict(list)
    oracle = {}
    for name, q in load_all().items():
        oracle[name] = q.sql is not None
        for op in q.operators:
            by_op[op].append(name)
    key = lambda s: (re.match(r"[A-Z]+", s).group(0), int(re.search(r"\d+", s).group(0)), s)
    print("| Operator | Registered queries (✓ = DuckDB oracle, r = rows-only) |")
    print("|---|---|")
    for op in sorted(by_op, key=key):
        qs = ", ".join(f"`{n}` {'✓' if oracle[n] else 'r'}" for n in by_op[op])
        print(f"| {op} | {qs} |")


if __name__ == "__main__":
    main()
