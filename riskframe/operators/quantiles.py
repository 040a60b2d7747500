"""Exact and approximate quantiles without gathering a group into one task.

``exact_quantiles`` finds order statistics by bracketing and narrowing:

  pass 1: per (group, feature) count, min, max and a mergeable quantile
          sketch (``percentile_approx``, rank error <= n / accuracy) read at
          p -/+ a margin: a value bracket [lo, hi] around every wanted rank.
          Callers that already aggregate the column (``column_stats``) fuse
          this into their own single aggregate.
  pass k: one scan; every value falls in exactly one slot of its (group,
          feature): a gap between brackets (only counted) or a bracket,
          inside which it is counted per equal-width bucket (the bucket
          holding the rank becomes the next bracket) or, once the bracket is
          small, per distinct value so the rank is read off exactly.

Only per-slot / per-bucket / per-value counts are shuffled, never a group's
value list (the ``percentile`` aggregate's final merge would hold every
value of a group in one task). Ranks are located from cumulative counts
over all slots, so a bracket the sketch got wrong only costs one more pass
(the gap holding the rank becomes the bracket): results are always exact.

Interpolation: h = p*(n-1), v = x[floor h] + (h - floor h)*(x[ceil h] - x[floor h])
(``percentile`` / ``quantile_cont`` / numpy default).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col

FINITE = 1.7976931348623157e308
MAX_TARGETS = 50_000        # targets in one broadcast table; more go in parts
SKETCH_ACCURACY = 10_000    # rank error of the bracketing sketch: n / 10_000
FINAL_ROWS = 4096           # a bracket with at most this many rows is resolved by value
VALUE_BUDGET = 1_000_000    # at most this many (estimated) values fetched per pass


def stack_long(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = (),
               drop_nan: bool = True) -> DataFrame:
    """Unpivot measures into (group..., feature, x double); nulls (and NaN) removed."""
    if not value_cols:
        raise ValueError("no value columns")
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in value_cols)
    st = df.select(*[col(g) for g in group_cols],
                   F.expr(f"stack({len(value_cols)}, {pairs}) as (feature, x)"))
    cond = F.col("x").isNotNull()
    if drop_nan:
        cond = cond & ~F.isnan("x")
    return st.where(cond)


def bracket_probs(probs: Sequence[float], accuracy: int = SKETCH_ACCURACY) -> list[float]:
    """Sketch probabilities read around each wanted probability (p -/+ 3/accuracy)."""
    m = 3.0 / accuracy
    out = []
    for p in probs:
        out += [max(0.0, p - m), min(1.0, p + m)]
    return out


def summary_aggs(x: str, probs: Sequence[float], accuracy: int = SKETCH_ACCURACY) -> list:
    """Aggregates of pass 1 (fusable into a caller's aggregate): NaN-free count,
    min, max and the sketch brackets."""
    v = F.when(~F.isnan(x), F.col(x))
    arr = F.array(*[F.lit(float(b)) for b in bracket_probs(probs, accuracy)])
    return [F.count(v).alias("_qn"), F.min(v).alias("_qmn"), F.max(v).alias("_qmx"),
            F.percentile_approx(v, arr, accuracy).alias("_qsk")]


def _ranks(p: float, n: int) -> tuple[int, int]:
    h = p * (n - 1)
    return int(math.floor(h)), int(math.ceil(h))


def _bracket_df(spark: SparkSession, rows, group_fields, k: int) -> DataFrame:
    fields = [T.StructField(f"_g_{f.name}", f.dataType, True) for f in group_fields]
    fields.append(T.StructField("_feature", T.StringType(), False))
    for i in range(k):
        fields += [T.StructField(f"_lo{i}", T.DoubleType(), False),
                   T.StructField(f"_hi{i}", T.DoubleType(), False),
                   T.StructField(f"_nb{i}", T.IntegerType(), False)]   # 0 = by value
    return spark.createDataFrame(rows, T.StructType(fields))


def few_summary(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                group_cols: Sequence[str], accuracy: int = SKETCH_ACCURACY) -> list | None:
    """Pass 1's rows, or None if they are more than one broadcast should hold: never more
    of them than that reach the driver."""
    most = max(1, MAX_TARGETS // (2 * len(probs)))
    rows = stack_long(df, value_cols, group_cols).groupBy(*[F.col(g) for g in group_cols], "feature").agg(
        *summary_aggs("x", probs, accuracy)).limit(most + 1).collect()
    return rows if len(rows) <= most else None


def _merge(brackets):
    """Sort brackets [lo, hi, est] and merge overlapping ones (disjoint result)."""
    out = []
    for lo, hi, est in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
            out[-1][2] += est
        else:
            out.append([lo, hi, est])
    return out


def order_statistics(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                     group_cols: Sequence[str] = (), summary: list | None = None,
                     bins: int = 1024, final_rows: int = FINAL_ROWS,
                     accuracy: int = SKETCH_ACCURACY):
    """Return ({(group_tuple, feature): n}, {(group_tuple, feature, rank): value}).

    ``summary`` (optional) are rows with the group columns, ``feature`` and
    the ``summary_aggs`` fields, when the caller already computed them.

    Each resolving pass maps every value to exactly one slot of its
    (group, feature): a gap between brackets (counted, min, max) or a
    bracket (counted per bucket, or per distinct value once small). The
    per-(group, feature) bracket arrays are a bounded broadcast table joined
    on equality, so no row is duplicated.
    """
    spark = df.sparkSession
    long = stack_long(df, value_cols, group_cols)
    if summary is None:
        summary = long.groupBy(*[F.col(g) for g in group_cols], "feature").agg(
            *summary_aggs("x", probs, accuracy)).collect()
    most = max(1, MAX_TARGETS // (2 * len(probs)))
    if len(summary) > most:               # more than one broadcast should hold: in parts
        sizes, values = {}, {}
        for i in range(0, len(summary), most):
            s, v = order_statistics(df, value_cols, probs, group_cols, summary[i:i + most], bins,
                                    final_rows, accuracy)
            sizes.update(s)
            values.update(v)
        return sizes, values
    group_fields = [df.schema[g] for g in group_cols]

    sizes: dict = {}
    values: dict = {}
    pending: dict = {}   # (gkey, feature) -> {rank: [lo, hi, est]}
    for r in summary:
        gkey = tuple(r[g] for g in group_cols)
        n = r["_qn"]
        sizes[(gkey, r["feature"])] = n
        if not n:
            continue
        sk = r["_qsk"] or []
        est_sk = max(1, int(n * 6.0 / accuracy) + 2)
        for i, p in enumerate(probs):
            for rank in _ranks(p, n):
                if r["_qmn"] == r["_qmx"]:
                    values[(gkey, r["feature"], rank)] = r["_qmn"]
                elif len(sk) > 2 * i + 1:
                    pending.setdefault((gkey, r["feature"]), {})[rank] = [sk[2 * i], sk[2 * i + 1], est_sk]
                else:
                    pending.setdefault((gkey, r["feature"]), {})[rank] = [r["_qmn"], r["_qmx"], n]

    while pending:
        merged_by_key = {key: _merge([tuple(v) for v in {tuple(b) for b in ranks.values()}])
                         for key, ranks in pending.items()}
        k = max(len(m) for m in merged_by_key.values())
        nb_wide = max(16, min(bins, 400_000 // max(1, len(pending))))
        # resolve small brackets by value, smallest first, while the total number of
        # values fetched stays within VALUE_BUDGET; the others are bucketed again
        small = sorted((est, key, i) for key, merged in merged_by_key.items()
                       for i, (lo_, hi_, est) in enumerate(merged) if est <= final_rows and lo_ != hi_)
        by_value, spent = set(), 0
        for est, key, i in small:
            if spent + est > VALUE_BUDGET:
                break
            by_value.add((key, i))
            spent += est
        rows = []
        for (gkey, f), merged in merged_by_key.items():
            flat = []
            for i in range(k):
                if i < len(merged):
                    lo_, hi_, est = merged[i]
                    resolve = lo_ == hi_ or ((gkey, f), i) in by_value
                    flat += [float(lo_), float(hi_), 0 if resolve else nb_wide]
                else:   # padding: NaN bounds never compare true
                    flat += [math.nan, math.nan, 0]
            rows.append((*gkey, f, *flat))
        t = _bracket_df(spark, rows, group_fields, k)
        hist = (_gaps(long, t, group_cols, k).union(_inside(long, t, group_cols, k))).collect()
        cells: dict = {}
        for r in hist:
            cells.setdefault((tuple(r[g] for g in group_cols), r["feature"]), []).append(r)
        nxt: dict = {}
        for key, ranks in pending.items():
            ordered = sorted(cells.get(key, []), key=lambda r: (
                r["_s"], r["_b"], r["_v"] if r["_v"] is not None else 0.0))
            for rank in ranks:
                cum = 0
                for r in ordered:
                    if cum + r["c"] > rank:
                        if r["_v"] is not None or r["mn"] == r["mx"]:
                            values[(key[0], key[1], rank)] = r["mn"]
                        else:
                            if ranks[rank][:2] == [r["mn"], r["mx"]] and r["c"] == ranks[rank][2]:
                                raise RuntimeError(f"no progress on {key} between {r['mn']} and {r['mx']}")
                            nxt.setdefault(key, {})[rank] = [r["mn"], r["mx"], r["c"]]
                        break
                    cum += r["c"]
        pending = nxt
    return sizes, values


def _with_brackets(long: DataFrame, t: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Values beside the brackets of their (group, feature)."""
    cond = long["feature"] == t["_feature"]
    for g in group_cols:
        cond = cond & long[g].eqNullSafe(t[f"_g_{g}"])
    # one row per (group, feature), bounded by MAX_TARGETS: broadcast, no data shuffle
    return long.join(F.broadcast(t), cond, "inner")


def _gaps(long: DataFrame, t: DataFrame, group_cols: Sequence[str], k: int) -> DataFrame:
    """Values between brackets, counted per gap. Apart from ``_inside``: both in one
    aggregate are more code than the JVM compiles, and then every value is interpreted."""
    x = F.col("x")
    n_lo = sum((x >= F.col(f"_lo{i}")).cast("int") for i in range(k))   # brackets started
    n_hi = sum((x > F.col(f"_hi{i}")).cast("int") for i in range(k))    # brackets passed
    keys = [*[F.col(g) for g in group_cols], F.col("feature")]
    j = _with_brackets(long, t, group_cols).select(*keys, "x", n_lo.alias("_l"), n_hi.alias("_h"))
    return (j.where("_l <= _h").groupBy(*keys, (F.col("_l") * 2).alias("_s"))
             .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
             .select(*keys, "_s", F.lit(0).alias("_b"), F.lit(None).cast("double").alias("_v"), "c", "mn", "mx"))


def _inside(long: DataFrame, t: DataFrame, group_cols: Sequence[str], k: int) -> DataFrame:
    """Values within a bracket, counted per bucket, or per value once the bracket is small."""
    each = t.select(*[f"_g_{g}" for g in group_cols], "_feature", F.explode(F.array(*[
        F.struct(F.lit(2 * i + 1).alias("_s"), F.col(f"_lo{i}").alias("_lo"), F.col(f"_hi{i}").alias("_hi"),
                 F.col(f"_nb{i}").alias("_nb")) for i in range(k)])).alias("_r")).select("*", "_r.*").drop("_r").where("not isnan(_lo)")
    x, nb = F.col("x"), F.col("_nb")
    cond = (long["feature"] == each["_feature"]) & (x >= F.col("_lo")) & (x <= F.col("_hi"))   # disjoint: one at most
    for g in group_cols:
        cond = cond & long[g].eqNullSafe(each[f"_g_{g}"])
    keys = [*[F.col(g) for g in group_cols], F.col("feature")]
    j = long.join(F.broadcast(each), cond, "inner")
    bucket = F.when(nb == 0, F.lit(0)).otherwise(_bucket(x, F.col("_lo"), F.col("_hi"), nb))
    return (j.groupBy(*keys, "_s", bucket.alias("_b"), F.when(nb == 0, x).alias("_v"))
             .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
             .select(*keys, "_s", "_b", "_v", "c", "mn", "mx"))


def _bucket(x, lo, hi, nb):
    """Bucket 0..nb-1 of ``x`` in ``lo``..``hi``; monotone for any doubles. Infinite ends are
    pulled to the largest finite double and halves are taken where a difference could
    overflow; what is equal after that (an infinity and its neighbour) is told apart by
    comparing, so every pass splits the range."""
    big = F.lit(FINITE)
    cx, cl, ch = (F.greatest(F.least(v, big), -big) for v in (x, lo, hi))
    wide = (ch > big / 2) | (cl < -big / 2)
    f = lambda a, b: F.when(wide, a / 2 - b / 2).otherwise(a - b)
    share = F.try_divide(f(cx, cl), f(ch, cl))
    # the ends' own buckets hold nothing else when they are infinite
    return (F.when(cl >= ch, (x > lo).cast("int")).when((x == lo) & (lo < -big), F.lit(0))
            .when((x == hi) & (hi > big), nb - 1)
            .otherwise(F.least(F.floor(share * nb), nb - 1).cast("int")))


SORT_ROWS = 2_000_000       # a group of at most this many values is sorted in one task (spilling)


def grouped_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                      group_cols: Sequence[str], sort_rows: int = SORT_ROWS) -> DataFrame:
    """Exact interpolated quantiles of any number of groups, as ``exact_quantiles`` but
    without a driver-side table of groups: ordinary groups are sorted by the cluster, one
    pass for all; only groups beyond ``sort_rows`` values go through range narrowing."""
    from pyspark.sql import Window
    keys = [*group_cols, "feature"]
    long = stack_long(df, value_cols, group_cols)
    whole = Window.partitionBy(*keys)
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    big = sizes.where(F.col("_n") > sort_rows).select(*[F.col(g).alias(f"_big_{g}") for g in group_cols]).distinct()
    some = not big.isEmpty()
    if some:
        match = F.lit(True)
        for g in group_cols:
            match = match & F.col(g).eqNullSafe(F.col(f"_big_{g}"))
        large = _narrowed_quantiles(df.join(big, match, "left_semi"), value_cols, probs, group_cols)
        long = stack_long(df.join(big, match, "left_anti"), value_cols, group_cols)
    ranked = long.select(*keys, "x", (F.row_number().over(whole.orderBy("x")) - 1).alias("_i"),
                         F.count(F.lit(1)).over(whole).alias("_n"))
    aggs = []
    for k, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        a, b = F.floor(h), F.ceil(h)
        aggs += [F.max(F.when(F.col("_i") == a, F.col("x"))).alias(f"_a{k}"),
                 F.max(F.when(F.col("_i") == b, F.col("x"))).alias(f"_b{k}"), F.max(h - a).alias(f"_f{k}")]
    g = ranked.groupBy(*keys).agg(*aggs)

    def value(k):
        a, b, f = F.col(f"_a{k}"), F.col(f"_b{k}"), F.col(f"_f{k}")
        return F.when((f == 0) | (a == b), a).otherwise(a + f * (b - a))      # equal infinities too

    out = g.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), value(k).alias("value")) for k, p in enumerate(probs)])).alias("_q"))
    out = out.select(*keys, "_q.prob", "_q.value")
    return out.unionByName(large) if some else out


def exact_quantile_values(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                          group_cols: Sequence[str] = (), **kw) -> dict:
    """{(group_tuple, feature, prob): value} with linear interpolation."""
    sizes, vals = order_statistics(df, value_cols, probs, group_cols, **kw)
    out = {}
    for (g, f), n in sizes.items():
        for p in probs:
            if not n:
                out[(g, f, p)] = None
                continue
            lo_r, hi_r = _ranks(p, n)
            a, b = vals[(g, f, lo_r)], vals[(g, f, hi_r)]
            h = p * (n - 1)
            out[(g, f, p)] = a if hi_r == lo_r or a == b else a + (h - lo_r) * (b - a)
    return out


def exact_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (), **kw) -> DataFrame:
    """Long table (group..., feature, prob, value) of exact interpolated quantiles. With
    more groups than one broadcast should hold nothing of them comes to the driver
    (``grouped_quantiles``)."""
    if group_cols and kw.get("summary") is None:
        kw["summary"] = few_summary(df, value_cols, probs, group_cols, kw.get("accuracy", SKETCH_ACCURACY))
        if kw["summary"] is None:
            return grouped_quantiles(df, value_cols, probs, group_cols)
    return _narrowed_quantiles(df, value_cols, probs, group_cols, **kw)


def _narrowed_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                        group_cols: Sequence[str] = (), **kw) -> DataFrame:
    vals = exact_quantile_values(df, value_cols, probs, group_cols, **kw)
    schema = T.StructType(
        [df.schema[g] for g in group_cols]
        + [T.StructField("feature", T.StringType()), T.StructField("prob", T.DoubleType()),
           T.StructField("value", T.DoubleType())])
    rows = [(*g, f, float(p), None if v is None else float(v)) for (g, f, p), v in vals.items()]
    return df.sparkSession.createDataFrame(rows, schema)


def approx_quantiles(df: DataFrame, value_cols: Sequence[str], probs: Sequence[float],
                     group_cols: Sequence[str] = (), relative_error: float = 0.01) -> DataFrame:
    """Long table (group..., feature, prob, value) from a mergeable quantile sketch
    (``percentile_approx``); values are actual data points, rank error <= rel. error * n."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    long = stack_long(df, value_cols, group_cols)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    agg = long.groupBy(*[F.col(g) for g in group_cols], "feature").agg(
        F.percentile_approx("x", arr, accuracy).alias("_q"))
    return agg.select(*[F.col(g) for g in group_cols], "feature",
                      F.explode(F.arrays_zip(arr.alias("prob"), F.col("_q").alias("value"))).alias("z")
                      ).select(*[F.col(g) for g in group_cols], "feature",
                               F.col("z.prob").alias("prob"), F.col("z.value").alias("value"))
