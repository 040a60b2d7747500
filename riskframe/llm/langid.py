"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over *all* its segmentations into pieces (forward algorithm); a
text's is the product over its words, and Bayes' rule gives the language. The piece
probabilities are fitted by expectation-maximisation (forward-backward counts) on a
bounded sample of labelled documents.

Words are runs of letters, lower-cased, preceded by the vocabulary's word mark. A letter
without a piece of its own has a small fixed probability in every language.

Defined cases: a text that is null or has no letter is ``und`` with score 0; ties go to
the first language in string order; without any labelled document every text is
``und``; null labels are not learnt from; rows that share an id, or copies of one row, are
learnt from like any others; rows are predicted one by one, repeated or not; words of any
length are scored whole (the fit counts pieces of very long ones in parts). Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, ship, tokenizer_path, written

LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"                 # the vocabulary's sign for a word start
LONG = 60                       # letters of a word in the tables of many words at once
UNKNOWN = 1e-7                  # probability of a letter without a piece
MEMO = 400_000                  # words remembered per worker


@dataclass
class Model:
    """Languages, their prior, the pieces, and ``prob[piece, language]``."""
    langs: list[str]
    prior: np.ndarray
    pieces: list[str]
    prob: np.ndarray


def letter_pieces(path: str) -> list[str]:
    """Pieces of the vocabulary that lower-cased words can be made of."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (sp.id_to_piece(i) for i in range(sp.vocab_size()))
    body = lambda p: p[1:] if p[0] == MARK else p
    return sorted({p for p in every if p == MARK or (body(p).isalpha() and p == p.lower())})


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased (lower-casing first: it may change a text's length)."""
    return LETTERS.findall(text.lower())


class Scorer:
    """Forward (and backward) algorithm for many words at once."""

    def __init__(self, model: Model):
        self.m = model
        import ahocorasick
        self.index = {p: i for i, p in enumerate(model.pieces)}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.index.items():
            self.automaton.add_word(p, (len(p) << 16) | i)
        self.automaton.make_automaton()
        self.singles = {p for p in model.pieces if len(p) == 1}
        n = len(model.langs)
        self.p = np.vstack([model.prob, np.full((1, n), UNKNOWN)])
        self.rows: dict[str, int] = {}
        self.used = 0
        self.log = np.zeros((1 << 12, n), dtype=np.float32)

    def edges(self, words: list[str]):
        """Every place of every piece: arrays (end, length, word, piece) sorted by end. All
        pieces of all words come from one pass of a string automaton."""
        found = [(e << 24) | v for e, v in self.automaton.iter("\n".join([MARK + w for w in words]))] if words else []
        found = np.array(found, dtype=np.int64)
        start = np.cumsum([0] + [len(w) + 2 for w in words[:-1]])
        word = np.searchsorted(start, found >> 24, side="right") - 1
        end = (found >> 24) + 1 - start[word]
        length, piece = (found >> 16) & 255, found & 0xFFFF
        odd = [(w, i + 2) for w, x in enumerate(words) if not self.singles.issuperset(x)
               for i, c in enumerate(x) if c not in self.singles]
        if odd:                                  # letters without a piece
            w, e = np.array(odd).T
            word, end = np.concatenate((word, w)), np.concatenate((end, e))
            length = np.concatenate((length, np.ones(len(w), np.int64)))
            piece = np.concatenate((piece, np.full(len(w), len(self.m.pieces))))
        order = np.lexsort((length, end))
        return end[order], length[order], word[order], piece[order]

    @staticmethod
    def groups(end, length):
        key = end * 256 + length
        cut = np.flatnonzero(np.diff(key)) + 1
        return zip([0, *cut.tolist()], [*cut.tolist(), len(key)]) if len(key) else ()

    def forward(self, words: list[str], langs: slice = slice(None)):
        """alpha[word, place, language] for some languages (all of them) and the edges."""
        end, length, word, piece = self.edges(words)
        size = max(map(len, words)) + 2
        p = self.p[:, langs]
        a = np.zeros((len(words), size, p.shape[1]))
        a[:, 0] = 1.0
        for lo, hi in self.groups(end, length):
            w, j, n = word[lo:hi], int(end[lo]), int(length[lo])
            a[w, j] += a[w, j - n] * p[piece[lo:hi]]
        return a, (end, length, word, piece)

    def log_words(self, words: list[str]) -> np.ndarray:
        out = np.empty((len(words), len(self.m.langs)), dtype=np.float32)
        order = sorted((i for i in range(len(words)) if len(words[i]) <= LONG), key=lambda i: len(words[i]))
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.log_long(w)
        step = self.share(8192)
        for i in range(0, len(order), step):
            part = order[i:i + step]
            ws = [words[k] for k in part]
            a, _ = self.forward(ws)
            out[part] = np.log(a[np.arange(len(ws)), [len(w) + 1 for w in ws]] + 1e-300)
        return out

    def log_long(self, word: str) -> np.ndarray:
        """The same sum for one word of any length, scaled as it goes (it would underflow)."""
        end, length, _, piece = self.edges([word])
        reach, n = int(length.max()), len(word) + 1
        a = np.zeros((n + 1, self.p.shape[1]))
        a[0] = 1.0
        scale = np.zeros(self.p.shape[1])
        cut = np.flatnonzero(np.diff(end)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(end)]):
            j = int(end[lo])
            a[j] = (a[j - length[lo:hi]] * self.p[piece[lo:hi]]).sum(axis=0)
            if j % 8 == 0:
                first = max(0, j - reach)
                top = a[first:j + 1].max(axis=0)
                a[first:j + 1] /= top
                scale += np.log(top)
        return scale + np.log(a[n])

    def expected(self, words: list[str], weights: np.ndarray, lang: int) -> np.ndarray:
        """Expected piece counts of one language (forward-backward)."""
        total = np.zeros(len(self.m.pieces) + 1)
        for i in range(0, len(words), 8192):
            ws, wt = words[i:i + 8192], weights[i:i + 8192]
            a, (end, length, word, piece) = self.forward(ws, slice(lang, lang + 1))
            a = a[:, :, 0]
            n = np.array([len(w) + 1 for w in ws])
            b = np.zeros_like(a)
            b[np.arange(len(ws)), n] = 1.0
            p = self.p[piece, lang]
            for lo, hi in reversed(list(self.groups(end, length))):
                w, j, k = word[lo:hi], int(end[lo]), int(length[lo])
                b[w, j - k] += b[w, j] * p[lo:hi]
            z = a[np.arange(len(ws)), n]
            share = a[word, end - length] * p * b[word, end] * (wt / np.maximum(z, 1e-300))[word]
            total += np.bincount(piece, weights=share, minlength=len(total))
        return total[:-1]

    def share(self, n: int) -> int:
        """``n`` for up to 16 languages, less for more: tables of words x languages keep
        their size."""
        return max(1, n * 16 // max(16, len(self.m.langs)))

    def score(self, texts: list[str | None]):
        """-> (index of the best language or -1, its posterior) for each text."""
        split = [words_of(t) if t else [] for t in texts]
        seen = set().union(*split)
        new = [w for w in seen if w not in self.rows]
        if self.used + len(new) > self.share(MEMO):
            self.rows.clear()
            self.used, new = 0, list(seen)
        if new:
            # letters only: digits of some scripts pass the expression above
            clean = [w if w.isalpha() else "".join(c for c in w if c.isalpha()) for w in new]
            k = self.used + 1
            self.used += len(new)
            while k + len(new) > len(self.log):
                self.log = np.concatenate([self.log, np.zeros_like(self.log)])
            self.log[k:k + len(new)] = self.log_words(clean)
            self.rows.update((w, k + i if c else 0) for i, (w, c) in enumerate(zip(new, clean)))
        best, post = np.full(len(texts), -1), np.zeros(len(texts))
        prior = np.log(self.m.prior)
        rows = self.rows
        for i, ws in enumerate(split):
            at = np.array([rows[w] for w in ws], dtype=np.int64)
            at = at[at > 0]
            if not len(at) or not len(prior):
                continue
            x = self.log[at].sum(axis=0, dtype=np.float64) + prior
            best[i] = int(np.argmax(x))
            post[i] = 1.0 / np.exp(x - x.max()).sum()
        for w in new:
            if len(w) > LONG:                    # not remembered: their number is bounded, not their length
                del rows[w]
        return best, post


def fit(labelled: DataFrame, vocabulary: str | None = None, text_col: str = "text",
        lang_col: str = "lang", key_col: str = "doc_id", docs_per_language: int = 200,
        max_languages: int | None = None, rounds: int = 2, smoothing: float = 0.1) -> Model:
    """Fit on at most ``docs_per_language`` documents of each label (chosen by a hash of
    their key and text). Every label that is not null is learnt, or only the ``max_languages`` most
    frequent ones if that is given. What reaches the driver is pieces x languages; priors
    count all labelled rows."""
    ship(labelled.sparkSession)
    path = vocabulary or tokenizer_path("piece_bpe_32k.model")
    rows = labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"),
                           F.col(f"`{text_col}`").cast("string").alias("text"),
                           F.xxhash64(F.col(f"`{key_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
                           .alias("h")).where("lang is not null")
    # rows that share a key differ by text; copies of a row are one hash and pass together
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("own"),
                                             F.min("h").alias("least")), "langid-sizes")
    if max_languages is not None:
        sizes = sizes.orderBy(F.desc("count"), "lang").limit(max_languages)
    counts = sizes.collect()
    langs = sorted(r["lang"] for r in counts)
    n_of = {r["lang"]: r["count"] for r in counts}
    pieces = letter_pieces(path)
    if not langs:
        return Model([], np.zeros(0), pieces, np.zeros((len(pieces), 0)))
    # a share of each language's rows by hash, then exactly the first ones: no task sorts a language
    share = sizes.select("lang", "least", F.least(
        F.lit(1.0), F.lit(2.0 * docs_per_language) / F.col("own") + F.lit(1e-4)).alias("share"))
    near = rows.join(share, "lang").where((F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20))
                                          | (F.col("h") == F.col("least")))
    first = Window.partitionBy("lang").orderBy("h", "text")
    sample = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= docs_per_language)
    schema = pa.schema([("lang", pa.string()), ("word", pa.string())])

    def explode(batches):
        from .langid import words_of
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = ["".join(c for c in w if c.isalpha()) for w in words_of(text)] if text else []
                # counts are taken from parts of very long words
                ws = [w[i:i + LONG] for w in ws for i in range(0, len(w), LONG)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ws), pa.string()),
                                                  pa.array(ws, pa.string())], schema=schema)

    words = written(sample.select("lang", "text").mapInArrow(explode, "lang string, word string")
                    .groupBy("lang", "word").count(), "langid-words")
    n = len(langs)
    model = Model(langs, np.array([n_of[k] for k in langs], float) / sum(n_of.values()), pieces,
                  np.full((len(pieces), n), 1.0 / max(1, len(pieces))))
    for _ in range(rounds):
        model.prob = _maximise(words, model, smoothing)
    return model


def _maximise(words: DataFrame, model: Model, smoothing: float) -> np.ndarray:
    spark = words.sparkSession
    held = spark.sparkContext.broadcast(model)
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])

    def expect(batches):
        from .langid import Scorer
        sc = Scorer(held.value)
        at = {k: i for i, k in enumerate(held.value.langs)}
        total = {}
        for b in batches:
            by = {}
            for lang, word, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                by.setdefault(at[lang], []).append((word, n))
            for k, ws in by.items():
                ws.sort(key=lambda x: len(x[0]))
                got = sc.expected([w for w, _ in ws], np.array([c for _, c in ws], float), k)
                total[k] = total.get(k, 0) + got
        for k, got in total.items():
            i = np.flatnonzero(got > 1e-9)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), k), pa.int32()), pa.array(i, pa.int32()),
                                              pa.array(got[i], pa.float64())], schema=schema)

    got = (words.mapInArrow(expect, "lang int, piece int, n double")
           .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())
    held.unpersist()
    count = np.full((len(model.pieces), len(model.langs)), smoothing)
    count[got["piece"].to_numpy(), got["lang"].to_numpy()] += got["n"].to_numpy()
    return count / count.sum(axis=0)


def scorer(held) -> Scorer:
    """One scorer with its memo per worker process, as long as the model is the same."""
    m = held.value
    key = (tuple(m.langs), hash(m.prob.tobytes()), hash(m.prior.tobytes()))
    return kept("scorer", key, lambda: Scorer(m))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, lang_pred, score)`` per row; only the text is looked at."""
    from .common import narrow, text_key
    rows = narrow(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("lang_pred", pa.string()),
                        ("score", pa.float64())])

    def run(batches):
        from .langid import scorer
        sc = scorer(held)
        langs = np.array([*held.value.langs, "und"], dtype=object)
        for b in batches:
            step = sc.share(500)
            for lo in range(0, len(b), step):
                part = b.slice(lo, step)
                best, post = sc.score(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2),
                                                  pa.array(langs[best], pa.string()), pa.array(post, pa.float64())],
                                                 schema=schema)

    return rows.mapInArrow(run, "doc_id long, text_key long, lang_pred string, score double")


def with_prediction(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, lang_pred, score)``: whole input rows with their prediction, in the task that
    reads them; no row moves."""
    from .common import arrow_schema, packed
    rows = packed(docs, id_col, text_col).select("row", "text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = rows.select("row").withColumns({"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")})
    schema = arrow_schema(out.schema)

    def run(batches):
        from .langid import scorer
        sc = scorer(held)
        langs = np.array([*held.value.langs, "und"], dtype=object)
        for b in batches:
            step = sc.share(500)
            for lo in range(0, len(b), step):
                part = b.slice(lo, step)
                best, post = sc.score(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).cast(schema.field(0).type),
                                                  pa.array(langs[best], pa.string()), pa.array(post, pa.float64())],
                                                 schema=schema)

    return rows.mapInArrow(run, out.schema)


def held_out(id_col: str = "doc_id"):
    """The fold that is never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    rest = F.crc32(F.col(f"`{id_col}`").cast("string")) % 4
    return F.coalesce(rest == 2, F.lit(False))
