"""Print the formatted physical plan of registered queries (scale review aid).

usage: python tools/show_plans.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    from shelfcast.queries import QUERIES
    from shelfcast.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        print(f"==================== {name}")
        QUERIES[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
