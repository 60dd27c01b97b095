"""Print the formatted physical plan of registered queries.

``python tools/explain.py NAME [NAME ...] [--sf DIR] [--scale]``; ``--scale``
plans without size-based broadcasts and without AQE, as on large inputs.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--scale", action="store_true")
    args = ap.parse_args()
    from matchlake.plans import QUERIES
    from matchlake.session import build_session
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"} if args.scale else {}
    spark = build_session("local[8]", extra=extra)
    for name in args.names:
        print(f"== {name} ==")
        QUERIES[name](spark, args.sf).explain("formatted")


if __name__ == "__main__":
    main()
