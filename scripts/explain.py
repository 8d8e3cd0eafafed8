"""Print the formatted physical plan of registered queries.

Usage: python scripts/explain.py [sf_dir] name [name ...]
Shows scans (ReadSchema / PushedFilters), exchanges and join strategies.
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from demandflow.plans.registry import load_all  # noqa: E402
from demandflow.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    reg = load_all()
    for name in args:
        print(f"==== {name}")
        reg[name][0](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
