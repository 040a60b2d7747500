"""Command line: run the whole job on a CSV file or folder.

    python -m riskframe <input_csv_or_dir> <output_dir> [--master local[8]]

Uses the incident layout (``riskframe.spec.ACCIDENTS``) and its explicit
schema; reports land in ``<output_dir>/reports``, the model in
``<output_dir>/model`` and the prepared table in ``<output_dir>/prepared``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.pipeline import run_pipeline
from .session import ENGINE_CONF, ensure_checkpoint_dir
from .spec import ACCIDENTS, accident_schema


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="riskframe")
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--master", default=None, help="omit when submitted to a cluster")
    args = ap.parse_args(argv)
    b = SparkSession.builder.appName("riskframe")
    if args.master:
        b = b.master(args.master).config("spark.ui.enabled", "false")
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    res = run_pipeline(spark, ACCIDENTS, args.input, args.output, schema=accident_schema())
    print(res.stage_counts)
    res.metrics.show(16, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
