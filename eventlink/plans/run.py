"""Write registered products as tables (S3: create-or-replace per step).

    python -m eventlink.plans.run --sf /root/testdata/sf0.01 --out <shared dir> [name ...]

Each product is written with ``mode("overwrite")`` as parquet under ``out``;
the job survives executor loss like any Spark write (failed tasks re-run, the
commit protocol publishes each table once).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..session import drop_materialized
from .registry import QUERIES


def write_tables(spark: SparkSession, sf_dir: str, out: str, names: list[str] | None = None) -> list[str]:
    from . import q_events, q_features, q_model  # noqa: F401  (registers)

    done = []
    for n in names or list(QUERIES):
        QUERIES[n].build(spark, sf_dir).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{n}")
        drop_materialized(spark)
        done.append(n)
    return done


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("eventlink-run").getOrCreate()
    for n in write_tables(spark, a.sf, a.out, a.names or None):
        print(n)
    return 0


if __name__ == "__main__":
    sys.exit(main())
