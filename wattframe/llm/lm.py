"""LM scoring with a hashed maximum-entropy model and a class-factored softmax.

p(word | context) is a product of two-way softmaxes down a Huffman tree of word classes: a class
splits in two until a word is left, so that a frequent word takes few steps. Features of a context are
the previous word, the two previous words, and a skip to the second word back; together
with the class each is hashed to a weight, so that all of them act on every step.

Every training word is in the tree: those with a share of 1 / 262,144 or more by themselves, all
others through one of several classes by their hash, in which a word has its smoothed unigram share.
Depth, number of hashed classes and of weights follow from the number of distinct words. Counts
cover all training documents and stay in a table; rare words meet theirs in a join.

Training goes once over the training documents, in rounds. In each round a task starts from the
model, makes an Adagrad step for every 32,768 tokens of its own documents, and hands over how far each
weight has moved and the squares of its gradients; the moves are averaged by these, in a tree of groups
of 32 tasks. Scoring is one scan in batches.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import crc_mod, written
from wattframe.llm.textops import mix, signed, words_of

U = np.uint64
END, START = U(0x0123456789ABCDEF), U(0x7EDCBA9876543210)  # neither is a word's hash, but by chance
FREQUENT = 1 << 18   # words with a share of more than 1 / FREQUENT: at most so many
FEATURES = 3
AT_ONCE, CACHED = 1 << 15, 1 << 12  # tokens of a step, and of what is worked on at a time
ROUNDS = 2
RATE = 0.8
DAMP = 10.0          # a row that few tokens speak for moves little, as with a prior around 0
PSEUDO = 0.1
SLICES = 64


def token_hashes(w):
    """Hashes of all tokens (words, then one end for each text), the text of each, and its place."""
    n_docs = len(w.bounds) - 1
    tokens = np.insert(w.hash, w.bounds[1:], END)
    counts = np.diff(w.bounds) + 1
    doc = np.repeat(np.arange(n_docs), counts)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
    return tokens, doc, place


def context_features(tokens: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Hashes of the FEATURES of every token's context."""
    back = []
    for k in (1, 2):
        b = np.full(len(tokens), START, dtype=U)
        b[k:] = tokens[:-k] if k < len(tokens) else tokens[:0]
        b[place < k] = START
        back.append(b)
    raw = (mix(back[0]), mix(back[1] + U(1)), mix(mix(back[0]) ^ (back[1] * U(3))))
    return [(x >> U(32)).astype(np.uint32) for x in raw]


def bits_for(distinct: int) -> tuple[int, int]:
    """log2 of the number of hashed classes and of weights, for so many distinct words."""
    return max(1, -(-int(distinct).bit_length() // 2)), min(max(int(distinct).bit_length() + 2, 12), 20)


def huffman(mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, side, bias) of a tree over leaves of these masses (at least one).

    Class k, with number ``len(mass) + k``, is made k-th; ``bias`` is the log odds of its right side.
    """
    n = len(mass)
    parent, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, dtype=bool)
    bias = np.zeros(n - 1, dtype=np.float32)
    heap = sorted(zip(mass.tolist(), range(n)))
    for k in range(n - 1):
        a, i = heapq.heappop(heap)
        b, j = heap[0]
        parent[i] = parent[j] = n + k
        side[j] = True
        bias[k] = np.log(b / a)
        heapq.heapreplace(heap, (a + b, n + k))
    return parent, side, bias


@dataclass
class MaxEnt:
    """The tree, as the way from the root to every leaf, and its weights."""

    vocabulary: np.ndarray          # sorted hashes of the words with leaves of their own
    leaf: np.ndarray                # their leaves
    rare_bits: int
    rare_leaf: np.ndarray           # leaves of the hashed classes
    rare_log: np.ndarray            # log10 of their smoothed counts
    start: np.ndarray               # leaf i: classes way[start[i]:start[i + 1]] and the sides taken there
    way: np.ndarray
    right: np.ndarray               # 1 or -1
    bias: np.ndarray                # of every class: log odds of its right side
    weights: np.ndarray = field(repr=False)

    @classmethod
    def of_counts(cls, hashes: np.ndarray, counts: np.ndarray, rare_counts: np.ndarray, rare_kinds: np.ndarray, weight_bits: int) -> "MaxEnt":
        """The untrained model: that of the smoothed counts of frequent words and of the hashed classes of the others."""
        rare = rare_counts + PSEUDO * (rare_kinds + 1)
        mass = np.concatenate([counts, rare]).astype(float)
        n = len(mass)
        parent, side, bias = huffman(mass)
        at, depth = np.arange(n), np.zeros(n, dtype=np.int64)
        while (up := parent[at] >= 0).any():
            depth += up
            at = np.where(up, parent[at], at)
        start = np.append(0, np.cumsum(depth))
        way, right = np.empty(start[-1], dtype=np.int32), np.empty(start[-1], dtype=np.float32)
        at, leaf, place = np.arange(n), np.arange(n), start[:-1].copy()
        while len(at := at[keep := parent[at] >= 0]):
            leaf = leaf[keep]
            way[place[leaf]], right[place[leaf]] = parent[at] - n, np.where(side[at], 1, -1)
            place[leaf] += 1
            at = parent[at]
        by_hash = np.argsort(hashes)
        return cls(hashes[by_hash], by_hash, int(len(rare)).bit_length() - 1, np.arange(len(hashes), n), np.log10(rare),
                   start, way, right, bias, np.zeros(1 << weight_bits, np.float32))

    def find(self, tokens: np.ndarray):
        """Leaf of each token, and the hashed class of those without one of their own (-1 for the others)."""
        rare = (tokens >> U(64 - self.rare_bits)).astype(np.int64)
        if not len(self.vocabulary):
            return self.rare_leaf[rare], rare
        k = np.minimum(np.searchsorted(self.vocabulary, tokens), len(self.vocabulary) - 1)
        own = self.vocabulary[k] == tokens
        return np.where(own, self.leaf[k], self.rare_leaf[rare]), np.where(own, -1, rare)

    def steps(self, leaf: np.ndarray, features: list[np.ndarray]):
        """For some tokens: each one's first step, and per step the weights' places (FEATURES x steps), log odds of the
        side taken, its sign."""
        count = self.start[leaf + 1] - self.start[leaf]
        first = np.cumsum(count) - count
        on_way = np.arange(count.sum())
        on_way += np.repeat(self.start[leaf] - first, count)
        klass = self.way[on_way]
        sign = self.right[on_way]
        turned = klass.astype(np.uint32)
        turned *= np.uint32(0x9E3779B1)
        shift = np.uint32(32 - (len(self.weights).bit_length() - 1))
        places = np.empty((FEATURES, len(klass)), dtype=np.intp)
        odds = self.bias[klass]
        for k, f in enumerate(features):
            x = np.repeat(f, count)
            x ^= turned
            x *= np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0xC2B2AE35)
            x >>= shift
            places[k] = x
            odds += self.weights[places[k]]
        odds *= sign
        return first, places, odds, sign

    def logs(self, tokens: np.ndarray, place: np.ndarray):
        """Natural log of what the tree gives to each token (for a rare one: to its class), and that class or -1."""
        leaf, rare = self.find(tokens)
        features = context_features(tokens, place)
        out = np.zeros(len(tokens))
        for i in range(0, len(tokens), CACHED):
            part = slice(i, i + CACHED)
            first, _, odds, _ = self.steps(leaf[part], [f[part] for f in features])
            if len(odds):
                x = np.minimum(odds, 0)
                x -= np.log1p(np.exp(-np.abs(odds)))
                out[part] = np.add.reduceat(x, first)
        return out, rare

    def learn(self, tokens: np.ndarray, place: np.ndarray, seen: np.ndarray, rate: float = RATE) -> None:
        """One Adagrad step of the weights for every AT_ONCE tokens; ``seen`` has the squares of the gradients so far."""
        leaf, _ = self.find(tokens)
        features = context_features(tokens, place)
        for i in range(0, len(tokens), AT_ONCE):
            met, errs = [], []
            for j in range(i, min(i + AT_ONCE, len(tokens)), CACHED):
                part = slice(j, min(j + CACHED, i + AT_ONCE))
                _, places, odds, sign = self.steps(leaf[part], [f[part] for f in features])
                np.exp(np.minimum(odds, 80, out=odds), out=odds)
                odds += 1
                met.append(places.ravel())
                errs.append(np.tile(sign / odds, FEATURES))  # towards the side taken, by what was missing to certainty
            g = np.bincount(np.concatenate(met), weights=np.concatenate(errs), minlength=len(seen)).astype(np.float32)
            seen += g * g
            g *= np.float32(rate)
            g /= np.sqrt(seen) + np.float32(DAMP)
            self.weights += g


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id):
    """Column: whether a document is kept from training; a null doc_id is not."""
    return F.coalesce(crc_mod(doc_id, 10) == 0, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """(hash, c) of every distinct token of ``docs``; summed by batch before the shuffle."""
    def scan(batches):
        for batch in batches:
            hashes, counts = [], []
            for _, w in words_of(batch, lower=True):
                h, c = np.unique(token_hashes(w)[0], return_counts=True)
                hashes.append(h)
                counts.append(c)
            if hashes:
                h, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
                c = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(c)], ["hash", "c"])

    return written(_texts(docs).mapInArrow(scan, "hash long, c long").groupBy("hash").agg(F.sum("c").alias("c")), "token-counts")


def _averaged(pdf: pd.DataFrame) -> pd.DataFrame:
    """The moves of a slice of the weights, averaged by the squares of their gradients."""
    total, weight = 0.0, 0.0
    for move, seen in zip(pdf["move"], pdf["seen"]):
        w = np.frombuffer(seen, np.float16).astype(np.float32)
        weight = weight + w
        total = total + np.frombuffer(move, np.float16).astype(np.float32) * w
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": pdf["part"].iloc[:1],
                         "move": [(total / np.maximum(weight, 1e-12)).astype(np.float16).tobytes()], "seen": [_half(weight)]})


def _half(x: np.ndarray) -> bytes:
    return np.minimum(x, 6e4).astype(np.float16).tobytes()


_MOVES = "slice int, part long, move binary, seen binary"


def moved(docs: DataFrame, model: MaxEnt, rate: float) -> np.ndarray | None:
    """How far the weights move on ``docs``: in every task from ``model`` on, averaged over the tasks."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        m = sent.value
        start = m.weights
        m.weights = start.copy()  # the worker may serve another task of this round
        seen, any_token = np.zeros_like(start), False
        for batch in batches:
            for _, w in words_of(batch, lower=True):
                tokens, _, place = token_hashes(w)
                m.learn(tokens, place, seen, rate)
                any_token = True
        move, m.weights = (m.weights - start).astype(np.float16), start
        if any_token:
            part = TaskContext.get().partitionId()
            for k, (a, b) in enumerate(zip(np.array_split(move, SLICES), np.array_split(seen, SLICES))):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int64()), pa.array([a.tobytes()], pa.binary()),
                                                  pa.array([_half(b)], pa.binary())], ["slice", "part", "move", "seen"])

    rows = _texts(docs).mapInArrow(scan, _MOVES)
    for shift in (5, 5, 40):
        rows = rows.withColumn("part", F.shiftright("part", shift)).groupBy("slice", "part").applyInPandas(_averaged, _MOVES)
    got = sorted(rows.select("slice", "move").collect())  # SLICES rows, the size of the model
    sent.unpersist()
    return np.concatenate([np.frombuffer(r["move"], np.float16) for r in got]) if got else None


def train(docs: DataFrame, model: MaxEnt, rounds: int = ROUNDS, rate: float = RATE) -> MaxEnt:
    """One pass over ``docs``: each round learns from its share and adds the averaged moves."""
    share = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(rounds))
    for r in range(rounds):
        move = moved(docs.where(share == r), model, rate)
        if move is not None:
            model.weights = model.weights + move.astype(np.float32)
    return model


def fitted(counts: DataFrame) -> tuple[MaxEnt, np.ndarray, np.ndarray, int, int]:
    """The untrained model of a table of counts, the frequent words and their counts, tokens and distinct words."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # The counts sum to n, so at most FREQUENT words can have a share of 1 / FREQUENT.
    frequent = F.col("c") * FREQUENT >= n
    top = counts.where(frequent).toArrow()
    hashes, c = top.column(0).to_numpy().view(U), top.column(1).to_numpy()
    rare_bits, weight_bits = bits_for(v)
    rare = np.zeros((2, 1 << rare_bits))
    of_class = F.shiftrightunsigned("hash", 64 - rare_bits)
    for r in counts.where(~frequent).groupBy(of_class.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("d")).collect():
        rare[:, r["k"]] = r["c"], r["d"]
    order = np.argsort(hashes)
    hashes, c = hashes[order], c[order]
    return MaxEnt.of_counts(hashes, c, rare[0], rare[1], weight_bits), hashes, c, n, v


def lm_scored(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score is the smoothed unigram log10 probability, score the model's. Learns from the rows
    that are not held out; null text counts as empty and has one token, the end. Rows that repeat
    a doc_id are scored, and learnt from, one by one. Very long texts are scored whole. Without
    training rows every token is unknown and both scores are those of a uniform word; an empty table
    gives no rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    train_docs = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    counts = token_counts(train_docs)
    model, hashes, c, n, v = fitted(counts)
    model = train(train_docs, model, rounds)
    base_log = float(np.log10(n + PSEUDO * (v + 1)))
    sent = spark.sparkContext.broadcast((model, hashes, c))

    def scan(batches):
        m, hashes, c = sent.value
        logs = np.log10(c + PSEUDO)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part, w in words_of(batch, lower=True):
                tokens, doc, place = token_hashes(w)
                k = len(w.bounds) - 1
                nat, rare_class = m.logs(tokens, place)
                at = np.minimum(np.searchsorted(hashes, tokens), max(len(hashes) - 1, 0))
                known = (hashes[at] == tokens) if len(hashes) else np.zeros(len(tokens), dtype=bool)
                word = np.where(known, logs[at] if len(hashes) else 0.0, 0.0)
                score = nat / np.log(10) - np.where(rare_class < 0, 0.0, m.rare_log[rare_class])
                per = lambda x: np.bincount(doc, weights=x, minlength=k)
                rare = np.flatnonzero(~known)
                rare = rare[np.lexsort((tokens[rare], doc[rare]))]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (tokens[rare[1:]] != tokens[rare[:-1]]) | (doc[rare[1:]] != doc[rare[:-1]])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(rare)))
                rare = rare[first]
                ends = pa.array(np.searchsorted(doc[rare], np.arange(k + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(k)), part.column(0), pa.array(np.bincount(doc, minlength=k)),
                     pa.array(per(known).astype(np.int64)), pa.array(per(word)), pa.array(per(score)),
                     pa.ListArray.from_arrays(ends, pa.array(signed(tokens[rare]))),
                     pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))],
                    ["uid", "doc_id", "n_tokens", "known", "word_log", "score_log", "rare", "times"])
                uid += k

    rows = written(_texts(docs).mapInArrow(
        scan, "uid long, doc_id long, n_tokens long, known long, word_log double, score_log double, rare array<long>, times array<int>"), "scored")
    # Rare words (each a share of less than 1 / FREQUENT) meet their counts in a join.
    seen = rows.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("uid", F.col("r.rare").alias("hash"), F.col("r.times").alias("times"))
    found = seen.join(counts, "hash", "left").groupBy("uid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + PSEUDO)).alias("more_log"))
    more = F.coalesce("more_log", F.lit(0.0))
    return rows.select("uid", "doc_id", "n_tokens", "known", "word_log", "score_log").join(found, "uid", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("word_log") + more - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("score_log") + more).alias("score"))
