"""Build layers from a shell: ``python -m monthmill.plans.build STORE LAYER --months 2013-01,2013-02`` or ``--pending``.

The exit code is 1 where a month was rejected, 2 where the arguments are wrong.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..operators.serve import check_month
from . import layers, publish

#: What each layer is built from, the tables that building it publishes, and its builder.
LAYERS = {
    "curated": (layers.RAW, [layers.CURATED], layers.build_curated),
    "players": (layers.CURATED, [layers.PLAYERS], layers.build_players),
    "aggregates": (layers.PLAYERS, layers.AGGREGATES, layers.build_aggregates),
    "explorer": (layers.CURATED, [layers.EXPLORER], layers.build_explorer),
}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="monthmill.plans.build", description=__doc__)
    parser.add_argument("store", help="folder of the published tables")
    parser.add_argument("layer", choices=sorted(LAYERS))
    which = parser.add_mutually_exclusive_group(required=True)
    which.add_argument("--months", help="comma-joined months, YYYY-MM")
    which.add_argument("--pending", action="store_true", help="months that the layer lacks, or built from another run")
    asked = parser.parse_args(argv)
    months: list[str] | str = "pending" if asked.pending else [m.strip() for m in asked.months.split(",") if m.strip()]
    try:
        for month in [] if asked.pending else months:
            check_month(month)
    except ValueError as e:
        parser.error(str(e))
    source, targets, step = LAYERS[asked.layer]
    store = publish.Store(spark or SparkSession.builder.getOrCreate(), asked.store.rstrip("/"))
    built = publish.build(store, months, source, targets, step)
    for month, ok in built.items():
        print(f"{month} {'published' if ok else 'rejected'}")
    return 0 if all(built.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
