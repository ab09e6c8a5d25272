"""Refresh the query column of COVERAGE.md from the registry (implementation column is kept as written).

Usage: python tools/coverage.py
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from riskframe.plans import registry
    registry.load_all()
    path = os.path.join(ROOT, "COVERAGE.md")
    lines = open(path).read().splitlines()
    out = []
    for ln in lines:
        m = re.match(r"\| (\w+) \| (.*?) \| (.*) \|$", ln)
        if not m or m.group(1) == "ID":
            out.append(ln)
            continue
        key, impl, qs = m.groups()
        names = re.findall(r"`([a-z0-9_]+)`", qs)
        names += [n for n in registry.QUERIES if re.match(rf"{key.lower()}_", n)]
        names = [n for n in dict.fromkeys(names) if n in registry.QUERIES]
        cell = ", ".join(f"`{n}` ({'O' if n in registry.ORACLES else 'R'})" for n in names) or "—"
        out.append(f"| {key} | {impl} | {cell} |")
    open(path, "w").write("\n".join(out) + "\n")
    print(f"{len(registry.QUERIES)} queries, {len(registry.ORACLES)} with an oracle")


if __name__ == "__main__":
    main()
