"""N-gram Jaccard join: size-aware, light sets by subsets, heavy sets by inverted lists.

A document's set is its distinct ``n``-word shingles (A-Z lower-cased; fewer words: all of
them as one shingle), as 64-bit fingerprints. Documents with equal sets are one *class*;
the join runs on classes. Two classes link if 100 * intersection >= ``percent`` * union.

Light sets (up to ``x`` shingles) enumerate their subsets of every fixed size that an
intersection can have; sets that share a subset large enough for their sizes link, and
the smallest set of each subset stands for the others, so a shared subset costs one row
per set. Heavy sets go through inverted lists. ``x`` is chosen by cost: the largest size
whose subsets are fewer than the list entries that a set of that size would read.

Candidates come first: of each set the shingles with the least fingerprints are listed;
linked sets share at least ``need`` of those (prefix filter for several common elements),
so classes that have fewer listed shingles in common with any others are out. Inverted
lists are then made of the candidates' whole sets: a class stays only if other candidates
have as many of its shingles as a link needs, and it enters the lists of its rarest ones,
as many as a link must hit at least once. So a passage that many otherwise different
documents share makes no candidates.

Links are looked for along the lists in rounds: each list's most shared class is compared
with the list's other classes, exactly, on the whole sets; components grow; lists inside
one component are done. What still crosses components after ``rounds`` is compared pair by
pair inside the join, by size and by parity bits (a lossless bound on the difference of two
sets); only pairs that may link become rows, so no link between components is lost and
groups of copies are never expanded into pairs.

Defined cases: null or wordless texts have an empty set and link with nothing; rows with
equal sets are linked; rows that share an id are nodes of their own with the same id; a
null id is a node without a number: the component then takes its smallest other id, or
null; empty tables give empty results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from math import comb

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import connected_components, discard, narrow, row_slices, text_key, written

PERCENT = 80
LISTED = 30                     # a set lists its least LISTED - (100 - percent) percent above the plain prefix
SLICE = 1 << 20                 # bytes of text worked on at once
BITS = 8                        # 64-bit words of a set's parity bits
PARTS = 3                       # listed shingles, and texts, are shuffled in so many parts, one by one
MOST_SUBSETS = 128              # light sets never have more subsets than this
SETS = "doc_id long, text_key long, n int, cls long, listed array<long>, subsets array<struct<key:long,k:int>>"


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Smallest intersection of a set of ``n`` with any set that it links with."""
    return -(-percent * n // 100)


def prefix(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of ``n`` lists: the plain prefix and some, so that linked sets
    share ``common(n)`` listed ones."""
    return min(n, n - least_overlap(n, percent) + common(n, percent))


def common(n: int, percent: int = PERCENT) -> int:
    return max(1, n * (LISTED - (100 - percent)) // 100)


def subsets(n: int, percent: int = PERCENT) -> int:
    return sum(comb(n, k) for k in range(least_overlap(n, percent), n + 1))


def boundary(entry_cost: float = 8.0, percent: int = PERCENT) -> int:
    """The largest size of light sets: enumerating their subsets (a row each, shuffled once)
    costs no more than their list entries, each of which costs as much as ``entry_cost``
    rows (it is shuffled by token and by class several times, and its pairs move whole
    sets)."""
    x = 0
    while subsets(x + 1, percent) <= min(MOST_SUBSETS, prefix(x + 1, percent) * entry_cost):
        x += 1
    return x


def shingles(data, offsets, n: int):
    """Distinct shingle fingerprints of each text, ascending: (offsets of sets, values)."""
    import numpy as np

    from .fingerprints import Runs, words
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    at, _, _, (w,) = words(fold[data], offsets, lanes=(0,))
    runs = Runs(w, 0)
    size = np.diff(at)
    many = np.where(size >= n, size - n + 1, (size > 0).astype(np.int64))
    text = np.repeat(np.arange(len(size)), many)
    first = at[text] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    value = runs.of(first, np.minimum(first + n, at[text + 1]))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    text, value = text[new], value[new]
    return np.searchsorted(text, np.arange(len(size) + 1)), value


def _slices(batches):
    from .fingerprints import text_bytes
    for b in batches:
        col = b.column(1).cast(pa.large_string()).fill_null("")
        for lo, hi in row_slices(text_bytes(col, 0, len(col))[1], SLICE):
            yield (b.slice(lo, hi - lo), *text_bytes(col, lo, hi))


def shingle_sets(rows: DataFrame, n: int = 5, percent: int = PERCENT, light: int = 0) -> DataFrame:
    """Per row the set's size, class (fingerprint of the whole set), listed shingles and, for
    sets that may link with light ones, subset keys."""
    reach = 100 * light // percent

    def find(batches):
        import itertools

        import numpy as np

        from .fingerprints import U, mix
        from .common import release
        from .jaccard import _slices, least_overlap, prefix, shingles
        release()
        for b, data, offsets in _slices(batches):
            at, value = shingles(data, offsets, n)
            size = np.diff(at)
            sums = np.concatenate((np.zeros(1, U), np.cumsum(mix(value))))
            cls = mix(sums[at[1:]] - sums[at[:-1]] + size.astype(U) * U(0x9E3779B97F4A7C15)).view(np.int64)
            take = np.array([prefix(int(k), percent) if k > light else 0 for k in size], dtype=np.int64)
            ends = np.cumsum(take)
            pick = np.repeat(at[:-1], take) + np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - take, take)
            subs = []
            for i, k in enumerate(size.tolist()):
                own = []
                if 0 < k <= reach:
                    s = mix(value[at[i]:at[i + 1]])
                    for m in range(least_overlap(k, percent), k + 1):
                        idx = np.array(list(itertools.combinations(range(k), m)))
                        keys = mix(s[idx].sum(axis=1, dtype=U) + U(m)).view(np.int64)
                        own += [{"key": x, "k": m} for x in keys.tolist()]
                subs.append(own)
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                              pa.array(value[pick].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(size, pa.int32()), pa.array(cls), listed,
                 pa.array(subs, pa.list_(pa.struct([("key", pa.int64()), ("k", pa.int32())])))],
                names=["doc_id", "text_key", "n", "cls", "listed", "subsets"])

    return rows.mapInArrow(find, SETS)


def _formula(n: Column, percent: int) -> tuple[Column, Column]:
    """(listed shingles, least common ones) of a set of size ``n``, as columns."""
    over = F.ceil(percent * n / 100).cast("int")
    share = LISTED - (100 - percent)
    own = F.greatest(F.lit(1), F.floor(n * share / 100).cast("int"))
    least = F.greatest(F.lit(1), F.floor(over * share / 100).cast("int"))
    return F.least(n, n - over + own), least


def subset_links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``(a, b)`` of sets that share a subset large enough for both sizes: each set
    with the smallest set of the subset (if two link, both link with that one)."""
    s = sets.where(F.size("subsets") > 0).dropDuplicates(["cls"]).select("cls", "n", F.explode("subsets").alias("s"))
    s = s.select("cls", "n", "s.key", "s.k")
    least = written(s.groupBy("key", "k").agg(F.min(F.struct("n", "cls")).alias("m"), F.count("*").alias("c"))
                    .where("c > 1").drop("c"), "subsets")
    j = s.join(least, ["key", "k"]).where(F.col("cls") != F.col("m.cls"))
    ok = 100 * F.col("k") >= percent * (F.col("n") + F.col("m.n") - F.col("k"))
    return j.where(ok).select(F.col("m.cls").alias("a"), F.col("cls").alias("b")).distinct()


def _in_parts(parts, name: str) -> list[DataFrame]:
    """``parts`` written one after another. What a part shuffles can go before the next begins:
    the iterator makes each, and gives back what it needed."""
    tables = []
    for part in parts:
        tables.append(written(part, name))
        del part                          # else its shuffle files would stay through the next
    return tables


def _as_one(tables: list[DataFrame]) -> DataFrame:
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*[t.scratch_path for t in tables])


def _shared(m: DataFrame, sizes: DataFrame, enough, given: list[DataFrame] | None = None,
            rounds: int = 2) -> DataFrame:
    """Of ``(token, cls)`` the tokens that two classes or more have, with their list's
    length ``df``, and only classes that have at least ``enough(n)`` of them (``have``); ``n``
    from ``sizes``. A class that goes shortens other lists, so this is done twice. ``given``: the
    written tables that ``m`` reads, which go."""
    spark = m.sparkSession
    for k in range(rounds):
        # written, so that the join below has a plain exchange on both sides and hot lists split
        df = written(m.select("token").groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "list-sizes")
        discard(spark)                    # after each step: what it shuffled is not needed again
        held = written(m.select("token", "cls").join(df, "token"), "lists-held")
        discard(spark, df, *(given or ()))
        keep = held.groupBy("cls").agg(F.count("*").alias("have")).join(sizes, "cls").where(
            F.col("have") >= enough(F.col("n"))).select("cls", "have")
        m = written(held.join(keep, "cls"), "lists")
        given = [m]
        discard(spark, held)
    return m


def candidates(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``cls`` of the classes whose listed shingles can be part of a link."""
    spark = sets.sparkSession
    sizes = written(sets.select("cls", "n").dropDuplicates(["cls"]), "class-sizes")

    def lists():                          # all listed shingles at once would be the most on disk
        for k in range(PARTS):
            post = sets.select("cls", F.explode("listed").alias("token")).where(F.pmod("token", F.lit(PARTS)) == k)
            twice = written(post.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"), "tokens")
            discard(spark)
            yield post.join(twice, "token").dropDuplicates(["token", "cls"])
            discard(spark, twice)

    given = _in_parts(lists(), "lists")
    m = _shared(_as_one(given), sizes, lambda n: _formula(n, percent)[1], given)
    out = written(m.select("cls").distinct(), "candidates")
    discard(spark, m, sizes)
    return out


def inverted_lists(whole: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(token, cls, n, share)``: inverted lists over the candidates' whole sets. A class needs
    as many shared shingles as its least overlap; of those it keeps the rarest, as many as
    a link must hit at least once. ``share``: part of the set that other candidates have."""
    spark = whole.sparkSession
    sizes = whole.select("cls", F.size("tokens").alias("n"))
    m = whole.select("cls", F.explode("tokens").alias("token"))      # not written: its lists are sets turned over
    need = lambda n: F.ceil(percent * n / 100).cast("int")
    m = _shared(m, sizes, need)
    rare = Window.partitionBy("cls").orderBy("df", "token")          # as many rows as a set has
    kept = m.withColumn("r", F.row_number().over(rare)).join(sizes, "cls").where(
        F.col("r") <= F.col("have") - need(F.col("n")) + 1)
    out = written(kept.select("token", "cls", "n", (F.col("have") / F.col("n")).alias("share")), "inverted-lists")
    discard(spark, m)
    return out


def _whole_sets(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``(cls, tokens)`` of the wanted rows' classes, from the text of one row of each; written."""
    spark = rows.sparkSession
    rep = (wanted.groupBy("cls")
           .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-1)), "doc_id", "text_key")).alias("r"))
           .select("cls", F.col("r.doc_id").alias("rep_id"), F.col("r.text_key").alias("rep_key")))

    def find(batches):
        import numpy as np

        from .jaccard import BITS, _slices, parity_bits, shingles
        for b, data, offsets in _slices(batches):
            at, value = shingles(data, offsets, n)
            bits = pa.array(parity_bits(at, value).ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column(3), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(at)) * BITS, pa.int32()), bits)],
                names=["cls", "tokens", "bits"])

    def sets():                           # every text is shuffled, few stay
        for k in range(PARTS):
            part = lambda t, key: t.where(F.pmod(key, F.lit(PARTS)) == k)  # noqa: B023,E731
            # the classes grow with the corpus: merged at every size, never broadcast
            j = part(rows, "text_key").join(
                part(rep, "rep_key").hint("merge"),
                F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))
            yield (j.select("doc_id", "text", "text_key", "cls").mapInArrow(
                find, "cls long, tokens array<long>, bits array<long>").dropDuplicates(["cls"]))
            discard(spark)

    return _as_one(_in_parts(sets(), "whole-sets"))


def parity_bits(at, value):
    """``BITS`` words for each set, in which every shingle flips one bit. Two sets' words differ in
    at most as many bits as the sets in shingles (the bitmap filter for exact set joins)."""
    import numpy as np

    from .fingerprints import U, mix
    size = np.diff(at)
    place = (mix(value + U(0x51ED2701)) >> U(32)) % U(64 * BITS)
    row = np.repeat(np.arange(len(size)), size)
    odd = np.bincount(row * (64 * BITS) + place.astype(np.int64), minlength=len(size) * 64 * BITS) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(size), BITS)


def near_enough(a: str, b: str, na: Column, nb: Column, percent: int = PERCENT) -> Column:
    """Whether two sets' words allow a link: sets that link differ in at most
    (100 - percent) / (100 + percent) of the sum of their sizes."""
    apart = sum((F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(BITS)), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * (na + nb)


def verified(pairs: DataFrame, whole: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` that link, by their whole sets."""
    a = whole.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    b = whole.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    j = pairs.join(b, "b").join(a, "a")
    both = F.size(F.array_intersect("ta", "tb"))
    return j.where(100 * both >= percent * (F.size("ta") + F.size("tb") - both)).select("a", "b")


def list_links(rows: DataFrame, sets: DataFrame, n: int, percent: int = PERCENT, rounds: int = 3) -> DataFrame:
    """Links ``(a, b)`` between heavy classes, enough of them to connect every component.
    ``sets`` (written) goes as soon as the candidates are known: it is mostly listed shingles,
    which the inverted lists do not need beside them."""
    spark = rows.sparkSession
    some = candidates(sets, percent)
    wanted = written(sets.select("doc_id", "text_key", "cls").join(some, "cls"), "candidate-rows")
    discard(spark, sets, some)
    whole = _whole_sets(rows, wanted, n)
    discard(spark, wanted)
    lists = inverted_lists(whole, percent)
    links, comp, led = [], None, None
    fits = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))

    def joined(tables):
        out = tables[0]
        for t in tables[1:]:
            out = out.union(t)
        return out

    def in_components(t, name):
        if comp is None:
            return t.withColumn("comp", F.col(name))
        c = comp.select(F.col("node").alias(name), "component")
        return t.join(c, name, "left").withColumn("comp", F.coalesce("component", name)).drop("component")

    for k in range(rounds + 1):
        cur = in_components(lists, "cls")
        crossed = written(cur.groupBy("token").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                          .where("c0 <> c1"), "crossed-lists")
        open_ = written(cur.join(crossed.select("token"), "token"), "open-lists")
        if open_.isEmpty():
            break
        if k < rounds:
            # of each list the most shared class outside the components that have led it
            free = open_ if led is None else open_.join(
                in_components(led, "lead").select("token", "comp"), ["token", "comp"], "left_anti")
            lead = free.groupBy("token").agg(F.max(F.struct("share", "n", "cls", "comp")).alias("m"))
            lead = written(lead, "leaders")
            mine = lead.select("token", F.col("m.cls").alias("lead"))
            led = mine if led is None else led.union(mine)
            j = open_.join(lead, "token").where(F.col("comp") != F.col("m.comp"))
            pairs = j.where(fits(F.col("n"), F.col("m.n"))).select(
                F.least("cls", "m.cls").alias("a"), F.greatest("cls", "m.cls").alias("b"))
        else:                                # whatever still crosses components
            own = whole.select(F.col("cls").alias("own"), *[F.get("bits", F.lit(i)).alias(f"bit{i}") for i in range(BITS)])
            rest = written(open_.join(own, F.col("cls") == F.col("own")).drop("own"), "rest-lists")
            side = lambda z: rest.select("token", *[F.col(c).alias(f"{z}_{c}") for c in (
                "cls", "n", "comp", *(f"bit{i}" for i in range(BITS)))])
            # the condition is part of the join: a pair that cannot link is no row
            pairs = side("x").join(side("y"), "token").where(
                (F.col("x_cls") < F.col("y_cls")) & (F.col("x_comp") != F.col("y_comp"))
                & fits(F.col("x_n"), F.col("y_n"))
                & near_enough("x_bit", "y_bit", F.col("x_n"), F.col("y_n"), percent)).select(
                F.col("x_cls").alias("a"), F.col("y_cls").alias("b"))
        new = written(verified(pairs.distinct(), whole, percent), "links")
        discard(spark)
        links.append(new)
        if k < rounds and not new.isEmpty():
            comp = written(connected_components(joined(links)), "components")
            discard(spark)
    return joined(links) if links else lists.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row ``(doc_id, text_key, n_shingles, component_id, cls)``: the set's size, the
    smallest doc_id reachable by links (its own included), and its class."""
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    light = boundary(percent=percent)
    sets = written(shingle_sets(rows, n, percent, light), "shingle-sets")
    thin = written(sets.select("doc_id", "text_key", "n", "cls"), "nodes")
    few = written(subset_links(sets, percent), "subset-links")
    discard(docs.sparkSession)
    links = few.union(list_links(rows, sets, n, percent))
    comp = connected_components(links).select(F.col("node").alias("cls"), "component")
    nodes = thin.join(comp, "cls", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "cls"))
    first = nodes.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("first"))
    out = nodes.where("n > 0").join(first, "component").select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), F.col("first").alias("component_id"), "cls")
    empty = thin.where("n = 0").select("doc_id", "text_key", F.lit(0).cast("long").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"), "cls")
    return out.union(empty)
