"""Ranked lexical search: an index in blocks of documents with pair-bound MaxScore.

The index is a table with one row per block of about 1,024 documents: the postings of the terms
that the queries hold, and, for chosen pairs of a query's terms, the list of documents that hold
both with the highest joint impact among them. A query adds the highest impacts of its terms,
but a pair counts only with the most that any document of the block gets from both together.
Blocks whose bound stays below the score already reached are skipped; within a block only the
documents of those pairs and terms are looked at without which the score cannot be reached, and
the lists tighten their bounds document by document before they are scored exactly.

The documents' texts are read once for each group of queries (a few megabytes of distinct terms;
one group for any usual set). Everything else works on blocks, whose rows do not depend on how
frequent a term is or how often a text was copied. Scores are whole numbers and exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattframe.llm.common import written

TOP = 50
#: Documents and postings of a block.
DOCS, POSTINGS = 1024, 1 << 20
#: Bytes of distinct query terms that one pass over the documents serves.
QUERY_BYTES = 4 << 20
#: One block in so many is searched first, for the score that the others have to reach.
FIRST = 16

#: Upper-case ASCII becomes lower case, what is no part of a term becomes a space.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
               for b in range(256))

_FORWARD = ("block long, n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, "
            "terms binary, starts binary, docs binary, tfs binary")
_INDEX = ("block long, doc_ids array<long>, terms binary, starts binary, docs binary, parts binary, "
          "pairs binary, joint binary, pair_starts binary, pair_docs binary")


def terms_of(text: str, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """All terms of a text in order, about a megabyte of text at a time."""
    data = text.encode().translate(_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _bytes(a, kind) -> bytes:
    return np.asarray(a, dtype=kind).tobytes()


def _row(schema: str, values: tuple) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[k]) for v, (_, k) in zip(values, fields)], [n for n, _ in fields])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The blocks of a batch one by one: each is large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def forward_blocks(docs: DataFrame, vocabulary) -> DataFrame:
    """Blocks of documents with the counts of the terms in ``vocabulary`` (a broadcast term -> number)."""
    def blocks(batches):
        number, found = 0, vocabulary.value.get
        part = TaskContext.get().partitionId() << 33
        ids, lengths, posts = [], [], []
        held = with_terms = n_terms = 0

        def block():
            term = np.concatenate([p[0] for p in posts])
            doc = np.repeat(np.arange(len(posts)), [len(p[0]) for p in posts])
            order = np.argsort(term, kind="stable")
            names, starts = np.unique(term[order], return_index=True)
            tf = np.concatenate([p[1] for p in posts])[order]
            return _row(_FORWARD, (part | number, with_terms, n_terms, ids, lengths, _bytes(names, "u4"),
                                   _bytes(np.append(starts, len(term)), "u4"), _bytes(doc[order], "u2"), _bytes(tf, "i8")))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts, n = Counter(), 0
                for words in terms_of(text.as_py() or ""):
                    n += len(words)
                    counts.update(map(found, words))
                counts.pop(None, None)
                ids.append(doc_id)
                lengths.append(n)
                posts.append((np.fromiter(counts.keys(), "u4", len(counts)), np.fromiter(counts.values(), "i8", len(counts))))
                held, with_terms, n_terms = held + len(counts), with_terms + (n > 0), n_terms + n
                if len(ids) == DOCS or held > POSTINGS:
                    yield block()
                    number += 1
                    ids, lengths, posts = [], [], []
                    held = with_terms = n_terms = 0
        if ids:
            yield block()

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(blocks, _FORWARD)


def document_frequencies(forward: DataFrame) -> DataFrame:
    """(term, df) over all blocks, summed per task before the shuffle."""
    def count(batches):
        total = Counter()
        for b in batches:
            for terms, starts in zip(b.column(0), b.column(1)):
                total.update(dict(zip(np.frombuffer(terms.as_py(), "u4").tolist(), np.diff(np.frombuffer(starts.as_py(), "u4")).tolist())))
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.int64()), pa.array(total.values(), pa.int64())], ["term", "df"])

    return forward.select("terms", "starts").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def pairs_of(terms: list[int], weight: np.ndarray) -> tuple[list[tuple[int, int]], list[int]]:
    """A query's terms in pairs of neighbours by weight, and the one that may be left over."""
    order = sorted(terms, key=lambda t: (-weight[t], t))
    return [(min(a, b), max(a, b)) for a, b in zip(order[::2], order[1::2])], order[len(order) - len(order) % 2:]


class Postings:
    """Postings of one block: the documents and impacts of each of its terms."""

    def __init__(self, terms: bytes, starts: bytes, docs: bytes, parts: np.ndarray, weight: np.ndarray):
        names = np.frombuffer(terms, "u4")
        self.starts = np.frombuffer(starts, "u4").tolist()
        self.docs = np.frombuffer(docs, "u2")
        self.impacts = parts * np.repeat(weight[names], np.diff(self.starts))
        self.place = dict(zip(names.tolist(), range(len(names))))
        self.most = np.maximum.reduceat(self.impacts, self.starts[:-1]).tolist() if len(names) else []

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        k = self.place[term]
        a, b = self.starts[k], self.starts[k + 1]
        return self.docs[a:b], self.impacts[a:b]

    def bound(self, term: int) -> int:
        k = self.place.get(term)
        return 0 if k is None else self.most[k]


def index_blocks(forward: DataFrame, n: int, length: int, weight, pairs) -> DataFrame:
    """The index: per block the postings' impacts without their weight, and the lists of ``pairs``.

    ``weight`` and ``pairs`` are broadcasts (array by term; list of two terms).
    """
    def index(batches):
        w, wanted = weight.value, pairs.value
        for batch in batches:
            for row in _rows(batch):
                tf = np.frombuffer(row["tfs"], "i8")
                docs = np.frombuffer(row["docs"], "u2")
                m = np.array([100 - 50 + 50 * x * n // length if length else 50 for x in row["lengths"]], dtype=np.int64)
                parts = (1_000_000_000 * tf) // (1000 * tf + 20 * m[docs])
                block = Postings(row["terms"], row["starts"], row["docs"], parts, w)
                seen, joint, starts, both = [], [], [0], []
                for k, (a, b) in enumerate(wanted):
                    if a not in block.place or b not in block.place:
                        continue
                    (da, ia), (db, ib) = block.of(a), block.of(b)
                    common, x, y = np.intersect1d(da, db, assume_unique=True, return_indices=True)
                    if len(common):
                        seen.append(k)
                        joint.append(int((ia[x] + ib[y]).max()))
                        both.append(common)
                        starts.append(starts[-1] + len(common))
                yield _row(_INDEX, (row["block"], row["doc_ids"], row["terms"], row["starts"], row["docs"], _bytes(parts, "u4"),
                                    _bytes(seen, "u4"), _bytes(joint, "i8"), _bytes(starts, "u4"),
                                    _bytes(np.concatenate(both) if both else [], "u2")))

    return forward.mapInArrow(index, _INDEX)


class Best:
    """The best documents of one query in one task: highest score, then smallest doc_id (null last)."""

    def __init__(self, top: int, least: int):
        self.top, self.least, self.rows = top, max(least, 1), []

    def add(self, rows: list[tuple]) -> None:
        self.rows += rows
        if len(self.rows) > 4 * self.top:
            self.cut()

    def cut(self) -> None:
        self.rows = sorted(self.rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[3]))[:self.top]
        if len(self.rows) == self.top:
            self.least = max(self.least, self.rows[-1][0])


def search_block(block: Postings, lists: dict, units: list[tuple], least: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a block that reach ``least`` for one query.

    ``units`` are the query's pairs (terms, number of the pair) and single terms (None).
    ``lists`` has, per pair number, its highest joint impact and the documents that hold both.
    """
    bounds = []
    for terms, pair in units:
        alone = max(map(block.bound, terms))
        if alone:
            joint, both = lists.get(pair, (0, None))
            bounds.append((max(alone, joint), alone, joint, both, terms))
    if sum(b[0] for b in bounds) < least:
        return np.empty(0, int), np.empty(0, int)
    bounds.sort(key=lambda b: b[0])
    free, optional = 0, 0
    while optional < len(bounds) and free + bounds[optional][0] < least:
        free += bounds[optional][0]
        optional += 1
    score, hit = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=bool)
    for _, _, _, _, terms in bounds[optional:]:
        for t in terms:
            if t in block.place:
                docs, impacts = block.of(t)
                score[docs] += impacts
                hit[docs] = True
    most = score.copy()
    for bound, alone, joint, both, _ in bounds[:optional]:
        most += alone
        if joint > alone:
            most[both] += joint - alone
    left = np.flatnonzero(hit & (most >= least))
    if len(left):
        for _, _, _, _, terms in bounds[:optional]:
            for t in terms:
                if t in block.place:
                    docs, impacts = block.of(t)
                    score[docs] += impacts
        left = left[score[left] >= least]
    return left, score[left]


def search_blocks(index: DataFrame, weight, queries, least, top: int) -> DataFrame:
    """(item, score, doc_id, block, place): each task's best documents of every query.

    ``queries`` is a broadcast list of units per query, ``least`` one of scores to reach.
    """
    def search(batches):
        w, asked = weight.value, queries.value
        best = [Best(top, x) for x in least.value]
        for batch in batches:
            for row in _rows(batch):
                block = Postings(row["terms"], row["starts"], row["docs"], np.frombuffer(row["parts"], "u4").astype(np.int64), w)
                starts, both = np.frombuffer(row["pair_starts"], "u4"), np.frombuffer(row["pair_docs"], "u2")
                lists = {k: (j, both[a:b]) for k, j, a, b in zip(np.frombuffer(row["pairs"], "u4").tolist(),
                                                                 np.frombuffer(row["joint"], "i8").tolist(), starts[:-1], starts[1:])}
                ids = row["doc_ids"]
                for units, found in zip(asked, best):
                    docs, scores = search_block(block, lists, units, found.least, len(ids))
                    if len(docs):
                        found.add([(s, ids[d], row["block"], d) for d, s in zip(docs.tolist(), scores.tolist())])
        out = []
        for k, found in enumerate(best):
            found.cut()
            out += [(k, *r) for r in found.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["item", "score", "doc_id", "block", "place"])

    return index.mapInArrow(search, "item long, score long, doc_id long, block long, place long")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "block", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _query_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): distinct rows of the queries with their distinct terms, sorted."""
    def distinct(batches):
        for b in batches:
            terms = [sorted({t for part in terms_of(x.as_py() or "") for t in part}) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    return rows.mapInArrow(distinct, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents (doc_id, text) of every query in ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id and score; only scores above 0, highest first, equal
    ones by ascending doc_id. Null and empty texts have no terms: as a query they find nothing, as a
    document they are found by none and do not count in the statistics. A null doc_id comes last among
    equal scores; rows that repeat a doc_id are documents of their own and may take several
    ranks. Queries that repeat both item_id and text count once; rows with the same item_id and
    different texts are ranked one by one. Whole texts count, however long. Other columns are
    ignored, whatever their names. Without documents or queries there are no rows.
    """
    spark = docs.sparkSession
    asked = written(_query_terms(items), "query-terms")
    size = asked.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.octet_length(t)))).first()[0] or 0
    groups = size // QUERY_BYTES + 1
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for g in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(groups)) == g).orderBy("item_id", "terms").collect()
        if rows:
            out = out.unionByName(_search_group(docs, rows, kind, top))
    return out


def _search_group(docs: DataFrame, rows: list, kind: str, top: int) -> DataFrame:
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    names = sorted({bytes(t) for r in rows for t in r["terms"]})
    numbers = dict(zip(names, range(len(names))))
    forward = written(forward_blocks(docs, share(numbers)), "forward-blocks")
    n, length = forward.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weight = np.zeros(len(names), dtype=np.int64)
    for term, df in document_frequencies(forward).collect():  # at most one row per query term
        weight[term] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
    pairs: dict[tuple[int, int], int] = {}
    units = []
    for r in rows:
        two, single = pairs_of([numbers[bytes(t)] for t in r["terms"]], weight)
        units.append([(p, pairs.setdefault(p, len(pairs))) for p in two] + [((t,), None) for t in single])
    weight, units = share(weight), share(units)
    index = written(index_blocks(forward, n, length, weight, share(list(pairs))), "search-index")
    first = index.where(F.crc32(F.col("block").cast("string")) % FIRST == 0)
    least = [1] * len(rows)
    for r in _ranked(search_blocks(first, weight, units, share(least), top), top).where(F.col("rank") == top).collect():
        least[r["item"]] = r["score"]
    found = _ranked(written(search_blocks(index, weight, units, share(least), top), "found"), top)
    ids = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(rows)], f"of long, item_id {kind}")
    return found.join(ids, F.col("item") == F.col("of")).select("item_id", "rank", "doc_id", "score")
