"""Mergeable partial states of the reports.

A state is a small table: a row per feature (count, central moments, extremes, a quantile
sketch), per level, per histogram cell, per outcome and per score bin. A batch gives a
state in a few aggregates; states merge by addition (central moments by their parallel
formulas), so the reports of a growing table come from the last state and the new batch
alone. A state's size is set by features, levels and bins, never by rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import EPS_LOG, col
from .evaluate import rate_columns
from .quantiles import stack_long
from .stats import bin_index

SKETCH_K = 800                  # size of the quantile sketch: rank error about 0.4 percent
STATE = T.StructType([T.StructField(n, t()) for t, names in (
    (T.StringType, "kind feature level"), (T.IntegerType, "bin"), (T.LongType, "n"),
    (T.DoubleType, "mean m2 m3 m4 lo hi s1 s2"), (T.BinaryType, "sketch")) for n in names.split()])
KEY = ("kind", "feature", "level", "bin")


def _state(df: DataFrame, kind: str, **cols: Column) -> DataFrame:
    """Rows of one kind; columns that it does not have are null (counts 0)."""
    given = {"kind": F.lit(kind), "n": F.lit(0), **cols}
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields])


def moments_state(df: DataFrame, features: Sequence[str], sketch_k: int = SKETCH_K) -> DataFrame:
    """Count, central moments, extremes and a quantile sketch of every feature, in one scan."""
    long = stack_long(df, features, drop_nan=True)
    g = long.groupBy("feature").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("v"), F.skewness("x").alias("g1"),
        F.kurtosis("x").alias("g2"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.kll_sketch_agg_double("x", F.lit(sketch_k)).alias("sketch"))
    m2 = F.col("v") * F.col("n")
    flat = m2 == 0
    return _state(g, "moments", feature=F.col("feature"), n=F.col("n"), mean=F.col("mean"), m2=m2,
                  m3=F.when(flat, 0.0).otherwise(F.col("g1") * F.pow(m2, 1.5) / F.sqrt("n")),
                  m4=F.when(flat, 0.0).otherwise((F.col("g2") + 3.0) * m2 * m2 / F.col("n")),
                  lo=F.col("lo"), hi=F.col("hi"), sketch=F.col("sketch"))


def rows_state(df: DataFrame) -> DataFrame:
    return _state(df.agg(F.count("*").alias("n")), "rows", n=F.col("n"))


def levels_state(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column (as text; a null value is a level of its own)."""
    g = df.groupBy(col(column).cast("string").alias("level")).agg(F.count("*").alias("n"))
    return _state(g, "level", feature=F.lit(column), level=F.col("level"), n=F.col("n"))


def edges_state(moments: DataFrame, bins: int) -> DataFrame:
    """Histogram ranges of the features of a moments state: those of the first batch are
    kept for good, values beyond them are counted below and above."""
    m = moments.where("kind = 'moments' and n > 0")
    same = F.col("lo") == F.col("hi")
    return _state(m, "edges", feature=F.col("feature"), bin=F.lit(bins),
                  lo=F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")),
                  hi=F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")))


def edges_of(state: DataFrame) -> dict[str, tuple[float, float, int]]:
    return {r["feature"]: (r["lo"], r["hi"], r["bin"]) for r in state.where("kind = 'edges'").collect()}


def cells_state(df: DataFrame, edges: Mapping[str, tuple[float, float, int]]) -> DataFrame:
    """Rows per histogram cell of given ranges; bin -1 is below them, bin ``bins`` above."""
    spark = df.sparkSession
    if not edges:
        return spark.createDataFrame([], STATE)
    feats = list(edges)
    as_map = lambda i, t: F.create_map(*[x for f in feats for x in (F.lit(f), F.lit(edges[f][i]).cast(t))])
    long = stack_long(df, feats, drop_nan=True)
    lo, hi, bins = (as_map(i, t)[F.col("feature")] for i, t in ((0, "double"), (1, "double"), (2, "int")))
    long = long.select("feature", "x", lo.alias("_lo"), hi.alias("_hi"), bins.alias("_bins"))
    places = {b for _, _, b in edges.values()}
    inside = F.coalesce(*[F.when(F.col("_bins") == b, bin_index(F.col("x"), F.col("_lo"), F.col("_hi"), b))
                          for b in sorted(places)])
    cell = F.when(F.col("x") < F.col("_lo"), -1).when(F.col("x") > F.col("_hi"), F.col("_bins")).otherwise(inside)
    g = long.groupBy("feature", cell.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return _state(g, "cell", feature=F.col("feature"), bin=F.col("bin"), n=F.col("n"))


def evaluation_state(pred: DataFrame, label: str = "label", prediction: str = "prediction", p: str = "p1",
                     score_bins: int = 1000) -> DataFrame:
    """Outcome cells, loss sums and (score bin, label) counts of scored rows; rows without a
    label, a prediction or a score have no outcome."""
    y, yhat, q = col(label).cast("double"), col(prediction).cast("double"), col(p).cast("double")
    loss = y * F.log(q + F.lit(EPS_LOG)) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - q + F.lit(EPS_LOG))
    rows = pred.select(y.cast("int").alias("y"), yhat.cast("int").alias("z"), ((q - y) * (q - y)).alias("b"),
                       (-loss).alias("l"), F.least(F.floor(q * score_bins), F.lit(score_bins - 1)).alias("s")).dropna()
    g = rows.groupBy("y", "z", "s").agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.sum("l").alias("l"))
    return _state(g, "outcome", level=F.concat_ws(",", "y", "z"), bin=F.col("s"), n=F.col("n"), s1=F.col("b"),
                  s2=F.col("l"))


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several; the parts of one row are as many as the states."""
    out = states[0].select(*STATE.names)
    for s in states[1:]:
        out = out.unionByName(s.select(*STATE.names))
    total = lambda c: F.sum(c).alias(c)
    g = out.groupBy(*KEY).agg(
        total("n"), total("s1"), total("s2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2", "m3", "m4"))).alias("parts"))
    n = F.col("n").cast("double")
    add = lambda f: F.aggregate("parts", F.lit(0.0), lambda a, x: a + f(x))
    g = g.withColumn("mean", F.when(n > 0, add(lambda x: x["n"] * x["mean"]) / n))
    d = lambda x: x["mean"] - F.col("mean")
    g = g.withColumns({
        "m2": add(lambda x: x["m2"] + x["n"] * d(x) * d(x)),
        "m3": add(lambda x: x["m3"] + 3.0 * d(x) * x["m2"] + x["n"] * d(x) * d(x) * d(x)),
        "m4": add(lambda x: x["m4"] + 4.0 * d(x) * x["m3"] + 6.0 * d(x) * d(x) * x["m2"]
                  + x["n"] * d(x) * d(x) * d(x) * d(x))})
    only = F.col("kind") == "moments"
    keep = {c: F.when(only, F.col(c)) for c in ("mean", "m2", "m3", "m4", "sketch")}
    return g.select(*[keep.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in STATE.fields])


# -------------------------------------------------------------- reports ---

def column_statistics(state: DataFrame) -> DataFrame:
    """A5-A7 from a state; the quartiles are the sketch's (see ``sketch_quantiles``)."""
    n, m2 = F.col("n").cast("double"), F.col("m2")
    q = F.kll_sketch_get_quantile_double("sketch", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    varies = m2 > 0
    return state.where("kind = 'moments'").withColumn("q", q).select(
        F.col("feature").alias("Feature"), F.col("n").alias("Count"), F.col("mean").alias("Mean"),
        F.col("q")[1].alias("Median"), F.when(n > 1, F.sqrt(m2 / (n - 1))).alias("Std"), F.col("lo").alias("Min"),
        F.col("hi").alias("Max"), F.col("q")[0].alias("Q1"), F.col("q")[2].alias("Q3"),
        F.when(varies, F.sqrt(n) * F.col("m3") / F.pow(m2, 1.5)).alias("Skewness"),
        F.when(varies, n * F.col("m4") / (m2 * m2) - 3.0).alias("Kurtosis"))


def sketch_quantiles(state: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(feature, prob, value)`` from the stored sketches, for any ranks asked for later."""
    answers = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double(
        "sketch", F.lit(float(p))).alias("value")) for p in probs])
    return state.where("kind = 'moments' and n > 0").select("feature", F.explode(answers).alias("a")).select("feature", "a.*")


def row_count(state: DataFrame) -> DataFrame:
    return state.where("kind = 'rows'").select(F.col("n").alias("rows"))


def level_counts(state: DataFrame, column: str, dtype: str = "int") -> DataFrame:
    """The distribution of a column."""
    return state.where((F.col("kind") == "level") & (F.col("feature") == column)).select(
        F.col("level").cast(dtype).alias(column), F.col("n").alias("count"))


def histogram_cells(state: DataFrame) -> DataFrame:
    """``(feature, bin, bin_lo, bin_hi, count)`` with empty cells; the open cells below
    and above the range have infinite edges. A row per cell: a bounded result."""
    edges = state.where("kind = 'edges'").select("feature", F.col("lo").alias("a"), F.col("hi").alias("z"),
                                                 F.col("bin").alias("bins"))
    grid = edges.select("feature", "a", "z", "bins", F.explode(F.sequence(F.lit(-1), F.col("bins"))).alias("bin"))
    at = lambda i: i.cast("double") * ((F.col("z") - F.col("a")) / F.col("bins")) + F.col("a")
    i = F.col("bin")
    grid = grid.select(
        "feature", "bin",
        F.when(i < 0, F.lit(float("-inf"))).when(i == F.col("bins"), F.col("z")).otherwise(at(i)).alias("bin_lo"),
        F.when(i < 0, F.col("a")).when(i == F.col("bins"), F.lit(float("inf")))
         .when(i == F.col("bins") - 1, F.col("z")).otherwise(at(i + 1)).alias("bin_hi"))
    cells = state.where("kind = 'cell'").select("feature", "bin", "n")
    return grid.join(cells, ["feature", "bin"], "left").select(
        "feature", "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0).cast("long")).alias("count"))


def evaluation(state: DataFrame) -> DataFrame:
    """A12-A18, A21 in one row: cells, rates, losses, and bounds of the AUC. Pairs of one score
    bin are all lost or all won in the bounds; ``auc_mid`` counts them half."""
    o = state.where("kind = 'outcome'").select(
        F.split("level", ",")[0].cast("int").alias("y"), F.split("level", ",")[1].cast("int").alias("z"), "bin", "n",
        "s1", "s2")
    cell = lambda a, b: F.coalesce(F.sum(F.when((F.col("y") == a) & (F.col("z") == b), F.col("n"))),
                                   F.lit(0)).cast("double")
    one = o.agg(cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                F.try_divide(F.sum("s1"), F.sum("n")).alias("brier"), F.try_divide(F.sum("s2"), F.sum("n")).alias("log_loss"))
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    rates = rate_columns()
    one = one.select("*", F.try_divide(F.col("tp") + F.col("tn"), total).alias("accuracy"),
                     *[rates[k].alias(k) for k in ("precision", "sensitivity", "specificity", "f1", "fnr", "fpr",
                                                   "mcc", "youden_j")])
    auc = auc_of_bins(o.where("bin is not null").groupBy("bin").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n"))).alias("pos"),
        F.sum(F.when(F.col("y") == 0, F.col("n"))).alias("neg"))).first()
    return one.select("*", *[F.lit(auc[c]).cast("double").alias(c) for c in auc.asDict()])


def auc_of_bins(bins: DataFrame) -> DataFrame:
    """``(auc_lower, auc_upper, auc_mid)`` of ``(bin, pos, neg)``, bins in score order."""
    from pyspark.sql import Window
    b = bins.select("bin", F.coalesce("pos", F.lit(0)).cast("double").alias("pos"),
                    F.coalesce("neg", F.lit(0)).cast("double").alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    b = b.withColumn("below", below)             # a row per bin of an aggregate: bounded
    won, open_ = F.sum(F.col("pos") * F.col("below")), F.sum(F.col("pos") * F.col("neg"))
    pairs = F.sum("pos") * F.sum("neg")
    share = lambda x: F.when(pairs > 0, x / pairs)
    return b.agg(share(won).alias("auc_lower"), share(won + open_).alias("auc_upper"),
                 share(won + 0.5 * open_).alias("auc_mid"))
