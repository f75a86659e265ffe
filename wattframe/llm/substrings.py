"""Substring dedup by level-wise doubling.

Level 1 looks at windows of half the length. Of the short windows inside every full window only
the one with the smallest hash is put forward, so that equal full windows put forward equal short
ones; those held by one text alone are dropped. Level 2 extends what is left to windows of full
length and again keeps the repeated ones. ``repeat_levels`` goes on to twice, four times, ... the
length, from the windows that repeat at one length alone, until none does.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import bloom, bloom_has, written
from wattframe.llm.textops import Words, chunks, mix, signed

U = np.uint64
WINDOW = 13


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _seeds(w: Words, window: int):
    """Per full window: its hash, whether it is there, and the smallest hash of its short windows."""
    half = (window + 1) // 2
    short, _ = w.shingles(half)
    full, room = w.shingles(window)
    n, reach = len(short), window - half + 1
    least = short.copy()
    for j in range(1, min(reach, n)):  # a chunk may have fewer words than a window
        np.minimum(least[:n - j], short[j:], out=least[:n - j])
    return full, room, least


def _key(w: Words, i: int) -> int:
    return int(w.whole(i).astype(np.int64))


def level_one(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, key (hash of the word sequence), n_words, the distinct short windows put forward."""
    def scan(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                w = Words(data, offsets, lower=False)
                _, room, least = _seeds(w, window)
                seeds, keys = [], []
                for i in range(len(offsets) - 1):
                    at = slice(w.bounds[i], w.bounds[i + 1])
                    seeds.append(signed(np.unique(least[at][room[at]])))
                    keys.append(_key(w, i))
                ends = np.cumsum([0, *map(len, seeds)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.int64()), pa.array(np.diff(w.bounds), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(seeds), pa.int64()))],
                    ["doc_id", "key", "n_words", "seeds"])

    return _texts(docs).mapInArrow(scan, "doc_id long, key long, n_words long, seeds array<long>")


def _place(key, start):
    """A start and part of the text's key in one long: rows that repeat a doc_id have other keys."""
    return ((key & ((1 << 23) - 1)) << 40) | start


def level_two(docs: DataFrame, window: int, wanted) -> DataFrame:
    """(doc_id, place, hash) of the full windows whose short window passes the filter."""
    def scan(batches):
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            for part, data, offsets in chunks(batch):
                w = Words(data, offsets, lower=False)
                full, room, least = _seeds(w, window)
                at = np.flatnonzero(room)
                at = at[bloom_has(bits, least[at])]
                i = np.searchsorted(w.bounds, at, side="right") - 1
                # of equal bounds (texts without words) the last one is the text of the window
                keys = np.zeros(len(offsets) - 1, dtype=np.int64)
                for k in np.unique(i):
                    keys[k] = _key(w, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(i)), pa.array(_place(keys[i], at - w.bounds[i])), pa.array(signed(full[at]))],
                    ["doc_id", "place", "hash"])

    return _texts(docs).mapInArrow(scan, "doc_id long, place long, hash long")


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, key, n_words; the windows that different documents share).

    The windows have doc_id, place, hash and first (the smallest doc_id they start in). Documents
    with equal word sequences share a key. A short window that only such copies hold is not put
    forward: what goes of copies follows from the key.
    """
    rows = written(level_one(docs, window), "level-one")
    short = rows.select("key", F.explode("seeds").alias("seed")).groupBy("seed").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    short = written(short.where("lo != hi").select("seed"), "short-repeats")
    full = written(level_two(docs, window, bloom(short, "seed")), "level-two")
    per = full.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = written(per.where("first != last").select("hash", "first"), "full-repeats")
    # Both sides come from tables: adaptive execution splits the partition of a frequent window.
    return rows.select("doc_id", "key", "n_words"), full.join(firsts, "hash")


def removals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, places of removed windows, keys of texts that go as a whole."""
    rows, shared = repeated_windows(docs, window)
    hits = shared.where(F.col("first") < F.col("doc_id")).groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    of_key = written(rows.where(F.col("n_words") >= window).groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last"), "copies")
    whole = rows.where(F.col("n_words") >= window).join(of_key, "key").where(F.col("doc_id") > F.col("first")) \
        .groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    return hits.join(whole, "doc_id", "full")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text, kept_sha256.

    A word goes if a window of ``window`` words that covers it has a word sequence that also
    starts in a document with a smaller doc_id. Windows are judged on the input. Null text has no
    words; a text with fewer words than a window stays whole. A null doc_id is neither smaller nor
    larger than another, and such rows stay whole; of rows that repeat a doc_id each is judged by
    its own text. Kept words are joined by one space.
    """
    gone = written(removals(docs, window), "removals")
    touched = bloom(gone, "doc_id")

    def split(batches, touched_ones):
        bits = np.frombuffer(touched.value, dtype=np.uint8)
        for batch in batches:
            ids = batch.column(0)
            hit = bloom_has(bits, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U))
            hit &= ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit if touched_ones else ~hit))

    def without_removals(batches):
        for batch in split(batches, False):
            yield batch.append_column("places", pa.nulls(batch.num_rows)).append_column("keys", pa.nulls(batch.num_rows))

    def apply(batches):
        # About a megabyte of text at a time: a batch of Spark's is 10,000 rows, however long.
        for batch in (part for whole_batch in batches for part, _, _ in chunks(whole_batch)):
            out = []
            for doc_id, text, places, keys in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist()):
                data = (text.as_py() or "").encode()
                words = data.split()
                n, removed = len(words), 0
                if keys or places.is_valid:
                    key = _key(Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), lower=False), 0)
                    stay = np.ones(n, dtype=bool)
                    if keys and key in keys:
                        stay[:] = False
                    elif places.is_valid:
                        places = places.values.to_numpy()
                        starts = places[places >> 40 == _place(key, 0) >> 40] & ((1 << 40) - 1)
                        drop = np.zeros(n + 1, dtype=np.int64)
                        np.add.at(drop, starts, 1)
                        np.subtract.at(drop, starts + window, 1)
                        stay = np.cumsum(drop[:n]) == 0
                    removed = int(n - stay.sum())
                    if removed:
                        words = [words[i] for i in np.flatnonzero(stay)]
                kept = b" ".join(words)
                out.append((doc_id, n, removed, kept.decode(), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    # Texts of which nothing goes are finished where they are read, the others meet their removals.
    result = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"
    texts = "doc_id long, text string"
    whole = _texts(docs).mapInArrow(lambda batches: apply(without_removals(batches)), result)
    rest = _texts(docs).mapInArrow(lambda batches: split(batches, True), texts)
    return whole.unionAll(rest.join(gone, "doc_id", "left").mapInArrow(apply, result))


def repeat_levels(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, longest: the longest of window, 2 * window, 4 * window, ... at which a window of the
    document also starts in another document. Documents without one are left out, and so are those
    that only share windows with their own copies.

    A window of twice the length is two windows that repeat and follow each other; whether the
    longer one repeats is counted again, until no window does.
    """
    _, shared = repeated_windows(docs, window)
    level = written(shared.where(F.col("doc_id").isNotNull()).select("doc_id", "place", "hash").distinct(), "level")
    found, length = level.select("doc_id", F.lit(window).cast("long").alias("longest")).distinct(), window
    while level.head(1):
        nxt = level.select("doc_id", (F.col("place") - length).alias("place"), F.col("hash").alias("after"))
        longer = level.join(nxt, ["doc_id", "place"]).select("doc_id", "place", F.xxhash64("hash", "after").alias("hash"))
        longer = written(longer, "longer")
        per = written(longer.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo != hi").select("hash"), "longer-repeats")
        length *= 2
        level = written(longer.join(per, "hash"), "level")
        found = found.unionAll(level.select("doc_id", F.lit(length).cast("long").alias("longest")).distinct())
    return found.groupBy("doc_id").agg(F.max("longest").alias("longest"))
