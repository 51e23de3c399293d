"""Print the formatted physical plans of the headline queries (after a run,
so AQE's final plan is shown).

    python tools/show_plans.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from conceptnorm.plans import queries as Q  # noqa: E402
from conceptnorm.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = get_spark()
    for name in names:
        df = Q.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        print("=" * 30, name)
        df.explain("formatted")


if __name__ == "__main__":
    main()
