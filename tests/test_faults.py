"""Task failures: multi-pass operators give identical results when tasks die.

Runs in a separate process with ``local[4,3]`` (up to 3 attempts per task).
The input column goes through a test-only function that raises on the first
attempt of every other partition, so each scan of every pass loses tasks
and Spark recomputes them from lineage. Results must equal a failure-free run.
"""

import os
import subprocess
import sys
import textwrap

from .conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from riskframe.session import ENGINE_CONF, ensure_checkpoint_dir
    from riskframe.operators import evaluate, features, quantiles, stats

    b = SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false") \\
        .config("spark.sql.shuffle.partitions", "4")
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)

    @F.udf("double")
    def flaky(x):   # test-only fault injection
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("injected task failure")
        return x

    li = spark.read.parquet({SF_SMALL!r} + "/lineitem.parquet").repartition(4)
    base = li.select("l_extendedprice", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    hurt = base.select(flaky("l_extendedprice").alias("l_extendedprice"), "l_quantity", "label")

    def run(df):
        q = quantiles.exact_quantile_values(df, ["l_extendedprice"], (0.1, 0.5, 0.9), ["label"])
        cs = sorted(map(tuple, stats.column_stats(df, ["l_extendedprice", "l_quantity"]).collect()))
        h = sorted(map(tuple, stats.histograms(df, ["l_extendedprice"], 30).collect()))
        sc = df.select("label", (F.col("l_extendedprice") / 105000.0).alias("p1"))
        auc = evaluate.auc_exact(sc).first()[0]
        return q, cs, h, auc

    clean_res, hurt_res = run(base), run(hurt)
    o = spark.read.parquet({SF_SMALL!r} + "/orders.parquet").repartition(4)
    o_hurt = o.withColumn("o_totalprice", flaky("o_totalprice"))
    def quarters(df):
        t = features.customer_quarter_table(df, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
        return sorted(map(tuple, t.collect()))
    assert quarters(o) == quarters(o_hurt), "customer quarters differ"
    assert clean_res == hurt_res, "results differ under task failures"
    print("FAULTS-OK")
""")


def test_operators_survive_task_failures(tmp_path):
    env = dict(os.environ, TMPDIR=str(tmp_path))
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True,
                         timeout=900, env=env)
    assert "FAULTS-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
