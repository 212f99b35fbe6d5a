"""Print the executed physical plan tree of catalogued queries (for PLANS.md).

``python -m tickerlake.plans.explain /root/testdata/sf0.1 q1 q2 ...``
Each query is executed through its own QueryExecution (``collect``) so the
adaptive plan printed is the final one, followed by the initial plan.
"""

from __future__ import annotations

import contextlib
import io
import sys

from tickerlake.plans.catalog import QUERIES
from tickerlake.session import get_session


def plan_tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    scans = [line.strip() for line in text.splitlines()
             if line.strip().startswith(("PushedFilters:", "ReadSchema:"))]
    return tree.rstrip() + "\n" + "\n".join(dict.fromkeys(scans))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or sorted(QUERIES)
    spark = get_session("local[8]")
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        df.collect()  # same QueryExecution as explain(): shows the final adaptive plan
        print(f"### {n}\n\n```\n{plan_tree(df)}\n```\n")


if __name__ == "__main__":
    main(sys.argv)
