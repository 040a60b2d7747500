"""Customer quarters kept up to date under late and corrected orders.

Orders arrive in batches in any order of time; an order that comes again replaces its
earlier version, also when it moves to another customer. A batch touches the customers of
its orders and of the versions that these replace. Only those customers' orders are read
(pruned to their hash buckets), only their quarters, trends and labels are computed again,
and only they are written, as a folder of the batch. Readers take each customer from the
last batch that touched it.

Orders live in buckets of customers, one folder a bucket and batch. Where a correction
takes an order from a customer, that customer's bucket gets a removal, so a customer's
orders are complete in the own bucket. A batch that is tried again overwrites its folders
and reads earlier batches only. Null customers or order ids are not orders and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import col
from ..operators import features
from ..session import scratch_dir
from ..sources import publish

ORDER = "customer long, order_id long, ts timestamp, amount double, removed boolean"


class QuarterTable:
    """Maintained table of ``features.customer_quarter_table`` below ``base``. ``columns``: customer,
    order id, time and amount of the batches."""

    def __init__(self, spark: SparkSession, base: str, columns: tuple[str, str, str, str], buckets: int = 64):
        self.spark, self.base, self.columns, self.buckets = spark, base.rstrip("/"), columns, buckets

    def _folder(self, name: str, batch: int) -> str:
        return f"{self.base}/{name}/batch={batch}"

    def _read(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        """A table of batch folders, of the batches before one (all of them by default)."""
        full = f"{schema}, batch long" + (", bucket int" if name == "orders" else "")
        root = f"{self.base}/{name}"
        done = [f for f in publish.folders(self.spark, root) if publish.exists(self.spark, f"{root}/{f}/_SUCCESS")]
        paths = [f"{root}/{f}" for f in done if before is None or int(f.split("=")[1]) < before]
        if not paths:
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).option("basePath", root).parquet(*paths)

    def apply(self, orders: DataFrame, batch: int) -> None:
        """Take a batch of new, late or corrected orders in."""
        spark = self.spark
        c, o, t, a = self.columns
        new = orders.select(col(c).cast("long").alias("customer"), col(o).cast("long").alias("order_id"),
                            col(t).cast("timestamp").alias("ts"), col(a).cast("double").alias("amount"),
                            F.lit(False).alias("removed")).where("customer is not null and order_id is not null")
        # one version of an order in a batch: the latest (ties: the greater amount, then customer)
        new = new.groupBy("order_id").agg(F.max(F.struct("ts", "amount", "customer", "removed")).alias("r")).select(
            "r.customer", "order_id", "r.ts", "r.amount", "r.removed")
        # written outside the table: the versions to replace are looked for by it
        aside = scratch_dir(spark, "quarter-batch")
        new.write.parquet(aside)
        new = spark.read.schema(ORDER).parquet(aside)
        held = self._read("orders", ORDER, batch)
        moved = (held.select("order_id", F.col("customer").alias("old")).join(
                    new.select("order_id", F.col("customer").alias("now")), "order_id")
                 .where("old <> now").select("order_id", "old").distinct()
                 .select(F.col("old").alias("customer"), "order_id", F.lit(None).cast("timestamp").alias("ts"),
                         F.lit(None).cast("double").alias("amount"), F.lit(True).alias("removed")))
        bucket = F.pmod(F.xxhash64("customer"), F.lit(self.buckets)).cast("int").alias("bucket")
        (new.unionByName(moved).select("*", bucket).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(self._folder("orders", batch)))
        mine = spark.read.schema(f"{ORDER}, bucket int").parquet(self._folder("orders", batch))
        mine.select("customer").distinct().write.mode("overwrite").parquet(self._folder("touched", batch))
        touched = spark.read.schema("customer long").parquet(self._folder("touched", batch))
        # orders of the touched customers; buckets without any are pruned (at most `buckets` numbers)
        there = [r[0] for r in mine.select("bucket").distinct().collect()]
        every = held.where(F.col("bucket").isin(there)).select("customer", "order_id", "ts", "amount", "removed", "batch")
        every = every.join(touched, "customer", "left_semi").unionByName(
            mine.select("customer", "order_id", "ts", "amount", "removed", F.lit(batch).cast("long").alias("batch")))
        last = every.groupBy("customer", "order_id").agg(F.max_by(F.struct("ts", "amount", "removed"), "batch").alias("r"))
        live = last.where("not r.removed").select("customer", "order_id", "r.ts", "r.amount")
        qf = features.quarter_trend(features.quarter_features(live, "customer", "order_id", "ts", "amount"), "customer")
        w = Window.partitionBy("customer").orderBy("quarter_idx")
        nxt = F.lead("quarter_idx").over(w)
        qf = qf.withColumn("label", F.when(nxt == F.col("quarter_idx") + 1, F.lit(1)).otherwise(F.lit(0)))
        qf.write.mode("overwrite").parquet(self._folder("quarters", batch))

    SCHEMA = ("customer long, quarter_idx long, year long, quarter int, quarter_amount double, quarter_frequency long, "
              "quarter_avg_value double, purchase_trend int, label int")

    def quarters(self) -> DataFrame:
        """Every customer quarter with trend and next-quarter label, as the last batch that
        touched its customer left it."""
        last = self._read("touched", "customer long").groupBy("customer").agg(F.max("batch").alias("batch"))
        return self._read("quarters", self.SCHEMA).join(last, ["customer", "batch"]).drop("batch")

    def labelled(self, last_quarter: int | None = None) -> DataFrame:
        """The rows whose next quarter is observed (see ``next_quarter_label``)."""
        q = self.quarters()
        if last_quarter is None:
            last_quarter = q.agg(F.max("quarter_idx")).first()[0]
        return q.where(F.col("quarter_idx") < F.lit(last_quarter))
