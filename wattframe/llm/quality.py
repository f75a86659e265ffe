"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum is taken in time
linear in the features by 1/2 * sum_f ((sum_i v_if x_i)**2 - sum_i (v_if x_i)**2).

The tasks turn texts into features. The model is fitted on a bounded sample of labelled rows and
has a fixed size; every text is scored where it is read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import crc_mod, written
from wattframe.llm.textops import Words, chunks, mix

U = np.uint64
SAMPLE = 6000        # labelled rows that the model is fitted on, at most
BUCKETS = 1 << 12    # hashed words
RANK = 8
STRUCTURE = (
    "words", "chars", "mean word length", "letters", "digits", "upper case", "symbols", "bars", "line ends",
    "full stops", "distinct words", "commonest word", "distinct lines", "doubled symbols", "all-caps words", "long words",
)
N_FEATURES = BUCKETS + len(STRUCTURE)

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SYMBOL = (_BYTE > 32) & ~_LETTER & ~_DIGIT & ~np.isin(_BYTE, list(b".,;:'\"()-"))
_STOP = np.isin(_BYTE, list(b".!?"))


def _share(table: np.ndarray, data: np.ndarray, ends: np.ndarray, per: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(table[data])])
    return (sums[ends[1:]] - sums[ends[:-1]]) / per


def features(data: np.ndarray, offsets: np.ndarray):
    """(row, column, value) of the hashed words of some texts, and their structure statistics.

    A word's value is log(1 + count), each row scaled to length 1. Lower case is not forced: all
    statistics come from the whole text. Texts without words have structure values of 0.
    """
    w = Words(data, offsets, lower=False)
    n_docs = len(offsets) - 1
    n_words = np.diff(w.bounds)
    doc = np.repeat(np.arange(n_docs), n_words)
    length = w.end - w.start
    one, some = np.maximum(n_words, 1), np.maximum(np.diff(offsets), 1)

    order = np.lexsort((w.hash, doc))
    d, h = doc[order], w.hash[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(d)))
    rows, distinct = d[first], np.bincount(d[first], minlength=n_docs)
    most = np.zeros(n_docs)
    np.maximum.at(most, rows, count)
    col = (mix(h[first]) >> U(64 - 12)).astype(np.int64)
    val = np.log1p(count)
    norm = np.sqrt(np.bincount(rows, weights=val * val, minlength=n_docs))
    val = val / np.maximum(norm, 1e-9)[rows]

    lines = np.bincount(doc, weights=_line_starts(data, w.start, offsets, doc), minlength=n_docs)
    line_hashes = _distinct_lines(w, data, doc, offsets, n_docs)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    caps = ((upper[w.end] - upper[w.start]) >= 2) & (upper[w.end] - upper[w.start] == letters[w.end] - letters[w.start])
    doubled = (symbols[w.end] - symbols[w.start]) >= 2
    per_word = lambda flag: np.bincount(doc, weights=flag, minlength=n_docs) / one
    s = np.stack([
        np.log1p(n_words) / 10, np.log1p(np.diff(offsets)) / 12, np.bincount(doc, weights=length, minlength=n_docs) / one / 10,
        _share(_LETTER, data, offsets, some), _share(_DIGIT, data, offsets, some), _share(_UPPER, data, offsets, some),
        _share(_SYMBOL, data, offsets, some), _share(_BYTE == 0x7C, data, offsets, some), _share(_BYTE == 0x0A, data, offsets, some) * 10,
        _share(_STOP, data, offsets, some) * 5, distinct / one, most / one, line_hashes / np.maximum(lines, 1),
        per_word(doubled), per_word(caps), per_word(length > 25)], axis=1)
    s[n_words == 0] = 0
    return rows, col, val, s


def _line_starts(data, start, offsets, doc):
    """1 for the first word of every line."""
    ends = np.concatenate([[0], np.cumsum(data == 0x0A)])
    flag = np.ones(len(start))
    if len(start) > 1:
        flag[1:] = (ends[start[1:]] != ends[start[:-1]]) | (doc[1:] != doc[:-1])
    return flag


def _distinct_lines(w: Words, data, doc, offsets, n_docs):
    """Number of distinct lines (as sequences of words) of each text."""
    if not len(w.hash):
        return np.zeros(n_docs)
    at = np.flatnonzero(_line_starts(data, w.start, offsets, doc))
    place = np.arange(len(w.hash)) - np.repeat(at, np.diff(np.append(at, len(w.hash))))
    line = np.add.reduceat(mix(w.hash ^ mix(place.astype(U))), at)
    order = np.lexsort((line, doc[at]))
    d, x = doc[at][order], line[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return np.bincount(d[new], minlength=n_docs)


@dataclass
class Machine:
    """A factorisation machine over hashed words (sparse) and structure statistics (dense)."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def structure(self, s: np.ndarray) -> np.ndarray:
        return np.clip((s - self.mean) / self.scale, -4, 4) / 4

    def margins(self, rows, col, val, s, n: int):
        """w0 + linear + pairwise part of each row, and the sums that the gradient needs."""
        z = self.structure(s)
        vx = self.factors[col] * val[:, None]
        total = z @ self.factors[BUCKETS:]
        square = (z ** 2) @ (self.factors[BUCKETS:] ** 2)
        for f in range(RANK):
            total[:, f] += np.bincount(rows, weights=vx[:, f], minlength=n)
            square[:, f] += np.bincount(rows, weights=vx[:, f] ** 2, minlength=n)
        out = self.bias + z @ self.linear[BUCKETS:] + np.bincount(rows, weights=self.linear[col] * val, minlength=n)
        return out + 0.5 * (total ** 2 - square).sum(axis=1), total, z

    def scores(self, rows, col, val, s, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows, col, val, s, n)[0], -30, 30)))


def fit_machine(rows, col, val, s, y, epochs: int = 30, batch: int = 256, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss; both classes weigh the same. Same input, same model."""
    rng = np.random.default_rng(seed)
    n = len(y)
    mean, scale = (s.mean(axis=0), s.std(axis=0) + 1e-3) if n else (np.zeros(len(STRUCTURE)), np.ones(len(STRUCTURE)))
    m = Machine(0.0, np.zeros(N_FEATURES), rng.normal(0, 0.05, (N_FEATURES, RANK)), mean, scale)
    if not n:
        return m
    share = np.clip(np.mean(y), 1e-3, 1 - 1e-3)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    order = np.argsort(rows, kind="stable")
    rows, col, val = rows[order], col[order], val[order]
    edges = np.searchsorted(rows, np.arange(n + 1))
    g_lin, g_fac, g_bias = np.full(N_FEATURES, 1e-6), np.full((N_FEATURES, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        shuffled = rng.permutation(n)
        for at in range(0, n, batch):
            pick = shuffled[at:at + batch]
            k = len(pick)
            spans = edges[pick + 1] - edges[pick]
            idx = np.repeat(edges[pick] - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            r, c, v = np.repeat(np.arange(k), spans), col[idx], val[idx]
            margin, total, z = m.margins(r, c, v, s[pick], k)
            err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[pick]) * weight[pick] / k
            lin, fac = decay * m.linear, decay * m.factors
            lin += np.bincount(c, weights=err[r] * v, minlength=N_FEATURES)
            lin[BUCKETS:] += err @ z
            ev, ev2 = err[r] * v, err[r] * v * v
            own = np.bincount(c, weights=ev2, minlength=N_FEATURES)
            for f in range(RANK):
                fac[:, f] += np.bincount(c, weights=ev * total[r, f], minlength=N_FEATURES) - own * m.factors[:, f]
            fac[BUCKETS:] += (err[:, None] * z).T @ total - (err @ (z ** 2))[:, None] * m.factors[BUCKETS:]
            bias = err.sum()
            g_lin, g_fac, g_bias = g_lin + lin ** 2, g_fac + fac ** 2, g_bias + bias ** 2
            m.linear -= rate * lin / np.sqrt(g_lin)
            m.factors -= rate * fac / np.sqrt(g_fac)
            m.bias -= rate * bias / np.sqrt(g_bias)
    return m


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``sample`` labelled rows: those with the smallest hash of their doc_id.

    Only rows whose crc32(doc_id as text) mod 3 is not 1 are used, and of labels 0 and 1 up to half
    of the sample each. Their ids are a table of ``sample`` rows at most, so they are broadcast.
    """
    fit = labels.where((crc_mod(F.col("doc_id"), 3) != 1) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    ids = [fit.where(F.col("label") == y).withColumn("order_", F.xxhash64("doc_id")).orderBy("order_", "doc_id").limit(sample // 2).select("doc_id", "label") for y in (0, 1)]
    ids = written(ids[0].unionAll(ids[1]), "label-sample")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", F.col("text").cast("string").alias("text"), "label")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """The model of a sample. The tasks make the features; the driver gets the sample's, which the
    sample size bounds (long texts have at most ``BUCKETS`` word features), and runs the epochs."""
    def scan(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                rows, col, val, s = features(data, offsets)
                n = len(offsets) - 1
                key = rows * BUCKETS + col
                uniq, inverse = np.unique(key, return_inverse=True)
                merged = np.bincount(inverse, weights=val).astype(np.float32)
                ends = np.searchsorted(uniq // BUCKETS, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array((uniq % BUCKETS).astype(np.int16))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(merged)),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(STRUCTURE)), pa.array(s.ravel()))],
                    ["doc_id", "label", "col", "val", "s"])

    table = training_rows(docs, labels, sample).mapInArrow(
        scan, "doc_id long, label int, col array<short>, val array<float>, s array<double>").toArrow()
    if not table.num_rows:
        return fit_machine(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty((0, len(STRUCTURE))), np.empty(0))
    table = table.sort_by("doc_id").combine_chunks()
    lists = [table.column(i).combine_chunks() for i in range(5)]
    spans = np.diff(lists[2].offsets.to_numpy())
    rows = np.repeat(np.arange(table.num_rows), spans)
    return fit_machine(rows, lists[2].flatten().to_numpy().astype(np.int64), lists[3].flatten().to_numpy().astype(np.float64),
                       lists[4].flatten().to_numpy().reshape(table.num_rows, -1), lists[1].to_numpy().astype(np.float64))


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Every whole text is scored; null text counts as empty and gets the score of an empty text. A
    null doc_id has no remainder and counts as not held out. Without labels every score is the one
    of an untrained model, near 0.5.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_quality(docs, labels, sample))

    def scan(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                rows, col, val, s = features(data, offsets)
                score = model.value.scores(rows, col, val, s, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        scan, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
                        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


def accepted_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as 1, all columns. Filtered where they are read."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit_quality(docs, labels, sample))
    at = docs.columns.index("text")

    def scan(batches):
        for batch in batches:
            named = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.string())], ["text"])
            done = 0
            for part, data, offsets in chunks(named):
                rows, col, val, s = features(data, offsets)
                score = model.value.scores(rows, col, val, s, len(offsets) - 1)
                yield batch.slice(done, part.num_rows).filter(pa.array(score >= 0.5))
                done += part.num_rows

    return docs.mapInArrow(scan, docs.schema)
