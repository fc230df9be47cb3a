"""Print the formatted physical plan of slate queries.

usage: python tools/plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martspark.plans.session import local_session  # noqa: E402
from martspark.plans.slate import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["kpi_monthly", "promo_daily"]
    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        print(f"===== {name} =====")
        df.explain("formatted")


if __name__ == "__main__":
    main()
