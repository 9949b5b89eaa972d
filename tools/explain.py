"""Print the formatted physical plan of registered queries.

Usage: python tools/explain.py [sf_dir] key [key ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir, keys = argv[0], argv[1:]
    from tripdemand import catalog
    from tripdemand.session import get_spark
    spark = get_spark("local[8]", 8)
    for key in keys:
        print(f"===== {key} =====")
        catalog.QUERIES[key](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
