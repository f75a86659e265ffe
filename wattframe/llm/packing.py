"""Best-fit packing of tokenised documents by exact-complement hashing.

Packing depends on lengths alone, and there are at most 2048 of them. The tasks tokenise and
number the pieces of each length; the driver plans on the histogram of lengths (2048 counts at
most): for the longest length left it looks up the gap among single lengths, sums of two and
sums of three that are still available, and uses a combination as often as the counts allow;
where no combination fills the gap exactly the longest length that fits goes in. The plan maps
(length, number) to a place, so placing pieces needs no group of pieces in one task.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import written

SEQUENCE = 2048
END_ID = 0
CACHE = 300_000  # words a worker remembers, some 75 MB

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"


class ByteBpe:
    """ids of whole texts, as little-endian uint32 bytes, as ``tokenizers`` gives them.

    In this vocabulary a token never reaches over a space into the word before it. Where white
    space stands alone, the words between spaces can therefore be encoded one by one, and the
    ids of those seen before are remembered (``CACHE`` words for each worker). Texts with white
    space in runs are encoded whole, those holding a special token's string by ``tokenizers``.
    """

    _own: dict = {}

    @classmethod
    def of_worker(cls) -> "ByteBpe":
        """The one of this Python worker, so that its memory serves all of the worker's tasks."""
        if "bpe" not in cls._own:
            cls._own["bpe"] = cls()
        return cls._own["bpe"]

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import base64

        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                   special_tokens={}).encode_ordinary
        self.special, self.tokenizer = ("<|endoftext|>",), None
        self.run = re.compile(r"\s\s").search

        class Seen(dict):
            def __missing__(self, word):
                ids = array("I", encode(" " + word)).tobytes()
                if len(self) < CACHE and len(word) < 40:
                    self[word] = ids
                return ids

        self.encode, self.seen = encode, Seen()

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            if self.tokenizer is None:
                from tokenizers import Tokenizer

                self.tokenizer = Tokenizer.from_file(self.vocabulary)
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if self.run(text):
            return array("I", self.encode(text)).tobytes()
        first, *words = text.split(" ")
        return array("I", self.encode(first)).tobytes() + b"".join(map(self.seen.__getitem__, words))


def pieces(docs: DataFrame) -> DataFrame:
    """Tokenised pieces: doc_id, piece, start, length, ids_crc32 and their number in their task.

    A longer document's first piece takes what is left over when the others have 2048 tokens.
    """
    def cut(batches):
        bpe = ByteBpe.of_worker()
        part, numbers = TaskContext.get().partitionId(), {}
        end = array("I", [END_ID]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.ids(text.as_py() or "") + end
                n = len(ids) // 4
                first, at, k = (n - 1) % SEQUENCE + 1, 0, 0
                while at < n:
                    length = first if k == 0 else SEQUENCE
                    number = numbers.get(length, 0)
                    numbers[length] = number + 1
                    rows.append((doc_id, k, at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), part, number))
                    at, k = at + length, k + 1
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences) for a histogram of lengths.

    Uses every piece exactly once. Each step exhausts a length, so there are a few thousand
    patterns at most, whatever the counts.
    """
    c = np.zeros(size + 1, dtype=np.int64)
    for length, n in counts.items():
        c[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def times(lengths) -> int:
        kinds, n = np.unique(lengths, return_counts=True)
        return int((c[kinds] // n).min())

    def complement(gap: int, used: list[int]):
        """Lengths that fill ``gap`` exactly: one, two or three of those available."""
        left = c.copy()
        for x in used:
            left[x] -= 1
        if left[gap] > 0:
            return [gap]
        have = np.flatnonzero(left[:gap + 1] > 0)
        have = have[have > 0]
        if len(have) == 0:
            return None
        ok = left > 0

        def pair(total, most):
            a = have[(have <= most) & (have * 2 >= total) & (have < total)][::-1]
            a = a[ok[a] & ok[total - a] & ((total - a != a) | (left[a] > 1))]
            return [int(a[0]), int(total - a[0])] if len(a) else None

        two = pair(gap, gap)
        if two:
            return two
        for x in have[::-1]:
            x = int(x)
            if x * 3 < gap:
                break
            if gap - x < 2:
                continue
            left[x] -= 1
            ok[x] = left[x] > 0
            rest = pair(gap - x, x)
            left[x] += 1
            ok[x] = True
            if rest:
                return [x, *rest]
        return None

    for length in range(size, 0, -1):
        while c[length] > 0:
            used, gap = [length], size - length
            while gap > 0:
                fill = complement(gap, used)
                if fill:
                    used += fill
                    break
                left = c[:gap + 1].copy()
                for x in used:
                    if x <= gap:
                        left[x] -= 1
                fits = np.flatnonzero(left > 0)
                fits = fits[fits > 0]
                if len(fits) == 0:
                    break
                used.append(int(fits[-1]))
                gap -= int(fits[-1])
            n = times(used)
            for x in used:
                c[x] -= n
            out.append((tuple(used), n))
    return out


def _places(patterns) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first numbers, first sequence ids and offsets of its runs of places."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    upto: dict[int, int] = {}
    base = 0
    for lengths, n in patterns:
        offset = 0
        for x in lengths:
            rows.setdefault(x, []).append((upto.get(x, 0), base, offset))
            upto[x] = upto.get(x, 0) + n
            offset += x
        base += n
    return {x: tuple(np.array(v, dtype=np.int64).T) for x, v in rows.items()}


def packed(docs: DataFrame) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty: one token, the end id. Repeated rows are packed each. An empty table
    gives no rows.
    """
    cut = written(pieces(docs), "pieces")
    spark = docs.sparkSession
    per_part = written(cut.groupBy("length", "part").agg((F.max("number") + 1).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(plan(counts)))
    from pyspark.sql import Window

    before = per_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    numbered = cut.join(before.hint("merge"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number"))

    def place(batches):
        for b in batches:
            length, number = b.column(3).to_numpy(), b.column(5).to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, edges):
                if len(rows):
                    first, base, offset = places.value[int(length[rows[0]])]
                    k = np.searchsorted(first, number[rows], side="right") - 1
                    seq[rows] = base[k] + number[rows] - first[k]
                    off[rows] = offset[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)], schema.names)

    schema = T.StructType([*numbered.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(place, schema)
