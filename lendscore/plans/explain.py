"""Print the physical plan of registered queries:
``python -m lendscore.plans.explain <sf_dir> <query> [<query> ...]``."""

from __future__ import annotations

import sys


def main(argv: list[str]) -> None:
    from ..session import get_spark, storage_root
    from .catalog import QUERIES

    sf_dir, names = argv[0], argv[1:] or sorted(QUERIES)
    spark = get_spark("local[*]", shuffle_partitions=8)
    storage_root(spark)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv[1:])
