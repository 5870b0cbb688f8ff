"""Print ``explain("formatted")`` for registered queries (plan review aid).

usage: python tools/plans.py [sf_dir] key [key ...]
"""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strata.plans.registry import REGISTRY  # noqa: E402
from strata.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    spark = build_session()
    for k in args:
        print(f"===== {k}")
        REGISTRY[k](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
