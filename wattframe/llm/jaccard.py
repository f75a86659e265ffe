"""N-gram Jaccard join with a token-group matrix.

A document is its set of n-word shingles (the tokens). The join

1. collapses documents with equal sets (copies) to one representative,
2. proposes documents that can be similar: a set is cut into more parts than two similar sets
   can differ in tokens, so that similar sets share a whole part, and as many more as the one has
   parts beyond the difference; parts held by one representative alone are dropped, and so are
   sets with too few shared parts,
3. partitions the proposed documents into groups around a shared part, in blocks of bounded
   size, and stores the tokens of each,
4. builds each block's token-group matrix (the union of its tokens by member), bounds the overlap
   of a query with the group by the union and opens only groups that can hold a partner; overlaps
   in opened groups are counted exactly.

Blocks link their own members first, twice in different divisions, so that large groups of near
copies become one component without all pairs; then every document is a query against the blocks
that hold proposed partners in another component. No link between two components is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import bloom, bloom_has, by_row, written
from wattframe.llm.components import components
from wattframe.llm.textops import mix, signed, words_of

U = np.uint64
BLOCK_DOCS = 256          # members of a block, about
BLOCK_TOKENS = 1 << 18    # tokens of a block, about (one longer document is a block of its own)
QUERY_DOCS = 256          # queries that one task holds against a block, about
CLASS_RATIO = 1.6         # growth of the set sizes that share one way of cutting
SIGNATURE_BITS = 48       # of a part's hash; parts that meet by chance are told apart by the exact overlap
RANGE_TOKENS = 1 << 19    # tokens for each range of signatures, about
FLUSH = 1 << 19           # signatures that a task sorts and reduces at a time


def similar(overlap, a, b, num: int, den: int):
    """Exact test of overlap / union >= num / den."""
    return den * overlap >= num * (a + b - overlap)


class Cuts:
    """Ways of cutting sets into parts, one for each class of sizes of the larger set.

    Two sets with |A| <= |B| <= hi and similarity of num/den or more differ in at most
    2 * hi * (den - num) / (den + num) tokens. With more parts (by ranges of the token hash) than
    that, they agree in one part at least. Parts that are empty in both agree without a token;
    spare parts make up for them, and a set that has too many empty parts for that to be certain
    also puts forward its empty ones.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.hi = [1]
        while self.hi[-1] < 1 << 40:
            self.hi.append(max(self.hi[-1] + 1, int(self.hi[-1] * CLASS_RATIO)))
        self.hi_array = np.array(self.hi, dtype=np.int64)

    def differ(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def parts(self, k: int) -> int:
        least = self.differ(self.hi[k], self.hi[k]) + 1
        return least if least == 1 else least + 2 + least // 16

    def signatures(self, tokens: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(class, need, hashes of the parts) of a sorted token set, for every class its partner can be in.

        A similar partner in the class agrees in ``need`` of these parts at least: of the filled
        parts no more than the sets' difference can disagree.
        """
        n = len(tokens)
        most = n * self.den // self.num
        first, last = (int(np.searchsorted(self.hi_array, x)) for x in (n, most))
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum(mix(tokens), out=sums[1:])
        high = tokens >> U(32)
        out = []
        for k in range(first, last + 1):
            m = self.parts(k)
            part = (high * U(m)) >> U(32)
            edges = np.searchsorted(part, np.arange(m + 1, dtype=U))
            filled = edges[1:] > edges[:-1]
            which, need = np.arange(m, dtype=np.int64), 1
            spare = int(filled.sum()) - self.differ(n, min(self.hi[k], most))
            if spare > 0:
                which, need = which[filled], spare
            hashes = mix((sums[edges[1:]] - sums[edges[:-1]])[which] ^ mix((which + (k << 32)).astype(U)))
            out.append((k, need, hashes >> U(64 - SIGNATURE_BITS)))
        return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def set_table(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, key (128-bit hash of the set; null if empty)."""
    def scan(batches):
        for batch in batches:
            for part, w in words_of(batch, lower=True):
                n, key = [], []
                for s in w.shingle_sets(words):
                    n.append(len(s))
                    lo, hi = np.sum(mix(s), dtype=U), np.sum(mix(s ^ U(0x5851F42D4C957F2D)), dtype=U)
                    key.append(f"{int(lo):016x}{int(hi):016x}" if len(s) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(key, pa.string())],
                                                 ["doc_id", "n_shingles", "key"])

    return _texts(docs).mapInArrow(scan, "doc_id long, n_shingles long, key string")


def _shared_signatures(docs: DataFrame, words: int, cuts: Cuts, n_tokens: int) -> DataFrame:
    """(signature) of the parts that two rows of ``docs`` hold at least.

    Tasks sort and reduce what they read, FLUSH signatures at a time, and deal it out packed
    in SIGNATURE_BITS / 8 bytes each, by ranges of the signature. The number of ranges grows with
    ``n_tokens``, so that one holds about RANGE_TOKENS of them; a frequent part is one entry per flush.
    """
    range_bits = max(6, (n_tokens // RANGE_TOKENS).bit_length())
    width = SIGNATURE_BITS // 8

    def packed(sig: np.ndarray) -> pa.RecordBatch:
        value, n = np.unique(sig, return_counts=True)
        value = np.repeat(value, np.minimum(n, 2))  # twice is all that matters
        which = (value >> U(SIGNATURE_BITS - range_bits)).astype(np.int64)
        at = np.flatnonzero(np.diff(which, prepend=-1))
        ends = (np.append(at, len(value)) * width).astype(np.int32)
        raw = np.ascontiguousarray(value.view(np.uint8).reshape(-1, 8)[:, :width])
        blobs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return pa.RecordBatch.from_arrays([pa.array(which[at]), blobs], ["range", "packed"])

    def scan(batches):
        got, n = [], 0
        for batch in batches:
            for _, w in words_of(batch, lower=True):
                for s in w.shingle_sets(words):
                    if len(s):
                        own = [x for _, _, x in cuts.signatures(s)]
                        got += own
                        n += sum(map(len, own))
                        if n >= FLUSH:
                            yield packed(np.concatenate(got))
                            got, n = [], 0
        if n:
            yield packed(np.concatenate(got))

    def repeated(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(x.as_py() for x in table.column("packed")), dtype=np.uint8).reshape(-1, width)
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :width] = raw
        value = np.sort(wide.view(U).ravel())
        again = value[1:][value[1:] == value[:-1]]
        return pa.table({"signature": pa.array(signed(np.unique(again)))})

    parts = _texts(docs).mapInArrow(scan, "range long, packed binary")
    return parts.groupBy("range").applyInArrow(repeated, "signature long")


def signature_rows(docs: DataFrame, words: int, cuts: Cuts, wanted) -> DataFrame:
    """(doc_id, class, need, signature) of the parts that the Bloom filter ``wanted`` lets pass.

    Only of rows and classes with as many such parts as a similar partner shares at least.
    Signatures are made again rather than stored: they are as large as the texts.
    """
    def scan(batches):
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            for part, w in words_of(batch, lower=True):
                row, kind, need, parts = [], [], [], []
                for i, s in enumerate(w.shingle_sets(words)):
                    for k, least, x in cuts.signatures(s) if len(s) else ():
                        row.append(i)
                        kind.append(k)
                        need.append(least)
                        parts.append(x)
                if not parts:
                    continue
                length, sig = np.array([len(x) for x in parts]), np.concatenate(parts)
                hit = bloom_has(bits, sig)
                enough = np.add.reduceat(hit.astype(np.int64), np.cumsum(length) - length) >= need
                hit &= np.repeat(enough, length)
                row, kind, need = (np.repeat(np.array(x), length)[hit] for x in (row, kind, need))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(kind, pa.int64()), pa.array(need, pa.int64()), pa.array(signed(sig[hit]))],
                    ["doc_id", "class", "need", "signature"])

    return _texts(docs).mapInArrow(scan, "doc_id long, class long, need long, signature long")


def token_table(docs: DataFrame, words: int, wanted) -> DataFrame:
    """(node, tokens) of the documents that the Bloom filter ``wanted`` lets pass."""
    def scan(batches):
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            ids = batch.column(0)
            keep = bloom_has(bits, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U))
            keep &= ids.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(keep))
            for part, w in words_of(batch, lower=True):
                sets = [signed(s) for s in w.shingle_sets(words)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets), pa.int64()))],
                    ["node", "tokens"])

    return _texts(docs).mapInArrow(scan, "node long, tokens array<long>")


class Matrix:
    """Token-group matrix of one block: the union of its members' tokens, and who holds which."""

    def __init__(self, tokens: list[np.ndarray]):
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        every = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
        union, at, held = np.unique(every, return_inverse=True, return_counts=True)
        self.union = union
        owner = np.repeat(np.arange(len(tokens)), self.sizes)
        order = np.argsort(at, kind="stable")
        self.owner = owner[order]
        self.edges = np.concatenate([[0], np.cumsum(held)])

    def rows(self, query: np.ndarray) -> np.ndarray:
        """Rows of the matrix for the query's tokens; their number bounds every overlap."""
        k = np.searchsorted(self.union, query)
        k[k == len(self.union)] = 0
        return k[self.union[k] == query] if len(self.union) else k[:0]

    def overlaps(self, rows: np.ndarray) -> np.ndarray:
        """Exact overlap with each member, from the opened rows."""
        first, count = self.edges[rows], self.edges[rows + 1] - self.edges[rows]
        total = int(count.sum())
        if not total:
            return np.zeros(len(self.sizes), dtype=np.int64)
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(total)
        return np.bincount(self.owner[at], minlength=len(self.sizes))


def _link_block(num: int, den: int):
    """applyInPandas function: links members of one block, a spanning tree of each component."""
    import pandas as pd

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        nodes = pdf["node"].to_numpy()
        tokens = [np.asarray(t, dtype=np.int64) for t in pdf["tokens"]]
        m = Matrix(tokens)
        free = np.ones(len(nodes), dtype=bool)
        a, b = [], []
        for i in range(len(nodes)):
            if not free[i]:
                continue
            free[i] = False
            queue = [i]
            while queue and free.any():
                j = queue.pop()
                rows = m.rows(tokens[j])
                hit = free & similar(m.overlaps(rows), m.sizes[j], m.sizes, num, den)
                found = np.flatnonzero(hit)
                free[found] = False
                queue += found.tolist()
                a += [nodes[i]] * len(found)
                b += nodes[found].tolist()
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return link


def _ask_block(num: int, den: int):
    """cogroup function: queries against the members of a block, one link for each other component."""
    import pandas as pd

    def ask(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        nodes, comps = members["node"].to_numpy(), members["component"].to_numpy()
        a, b = [], []
        if len(nodes):
            m = Matrix([np.asarray(t, dtype=np.int64) for t in members["tokens"]])
            least = int(m.sizes.min())
            for q, comp, t in zip(queries["node"], queries["component"], queries["tokens"]):
                t = np.asarray(t, dtype=np.int64)
                rows = m.rows(t)
                # the union bounds the overlap with any member: closed groups are not looked into
                if den * len(rows) < num * max(len(t), least):
                    continue
                hit = np.flatnonzero(similar(m.overlaps(rows), len(t), m.sizes, num, den) & (comps != comp))
                if len(hit):
                    _, first = np.unique(comps[hit], return_index=True)
                    a += [q] * len(first)
                    b += nodes[hit[first]].tolist()
        return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})

    return ask


EDGE = "a long, b long"


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Links join documents whose sets of ``words``-word shingles have a Jaccard similarity of
    num/den or more. Words are runs of characters other than white space, A-Z lower-cased. A text
    with fewer words is one shingle; null, empty and blank texts have no shingle and link with
    nothing. Rows with equal sets are linked whatever their number. A row without a doc_id gets
    the component of its text, null if no row with a doc_id has it. Rows that repeat a doc_id with
    another text count as one node and share a component. Shingles are compared by 64-bit hashes. Columns of ``docs`` other than doc_id and text are not read.
    """
    cuts = Cuts(num, den)
    light = written(set_table(docs, words), "sets")
    reps = written(light.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("node")), "representatives")

    # Parts that more than one document holds; only rows that can be of these are dealt out again.
    n_tokens = light.agg(F.sum("n_shingles")).first()[0] or 0
    shared = written(_shared_signatures(docs, words, cuts, n_tokens), "shared-parts")
    held = signature_rows(docs, words, cuts, bloom(shared, "signature")).join(shared, "signature")
    only = reps.select(F.col("node").alias("doc_id"))
    held = written(held.join(only, "doc_id", "left_semi").withColumnRenamed("doc_id", "node"), "held-parts")
    # Again without the copies: parts of two representatives at least, the smallest is the pivot.
    pivots = written(held.groupBy("signature").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
                     .where(F.col("pivot") != F.col("last")).select("signature", "pivot"), "pivots")
    held = written(held.join(pivots, "signature"), "held-parts")
    enough = held.groupBy("node", "class").agg(F.count("*").alias("n"), F.min("need").alias("need")).where("n >= need")
    held = written(held.join(written(enough.select("node", "class"), "enough-parts"), ["node", "class"]).select("node", "signature", "pivot"), "held-parts")

    # Groups around a pivot, in blocks of bounded size.
    groups = written(held.groupBy("node").agg(F.min("pivot").alias("grp")), "groups")
    sizes = light.join(groups, light["doc_id"] == groups["node"]).groupBy("node", "grp").agg(F.max("n_shingles").alias("n_shingles"))
    sizes = written(sizes, "group-members")
    per = sizes.groupBy("grp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("t"))
    per = written(per.select("grp", F.greatest(F.ceil(F.col("n") / BLOCK_DOCS), F.ceil(F.col("t") / BLOCK_TOKENS)).alias("blocks")), "group-blocks")
    placed = written(sizes.join(per, "grp").select(
        "node", "grp", "n_shingles", "blocks",
        F.pmod(F.xxhash64("node"), "blocks").alias("block"),
        F.pmod(F.xxhash64("node", F.lit(1)), "blocks").alias("other")), "placed")
    tokens = written(token_table(docs, words, bloom(groups, "node")), "tokens")
    tokens = written(placed.join(tokens.groupBy("node").agg(F.min("tokens").alias("tokens")), "node"), "group-tokens")

    link = _link_block(num, den)
    edges = written(tokens.select("grp", "block", "node", "tokens").groupBy("grp", "block").applyInPandas(link, EDGE), "links")
    more = written(tokens.where("blocks > 1").select("grp", "other", "node", "tokens").groupBy("grp", "other").applyInPandas(link, EDGE), "links")
    edges = edges.unionAll(more)
    comp = _labels(groups, edges)

    # What is left: proposed partners in different components.
    size = written(comp.groupBy("component").agg(F.count("*").alias("members")), "component-sizes")
    comp = written(comp.join(size, "component"), "components")
    rank = F.struct("members", "component")
    ranked = held.select("node", "signature").join(comp, "node").select("node", "signature", "component", rank.alias("rank"))
    mixed = ranked.groupBy("signature").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("signature")
    ranked = written(ranked.join(written(mixed, "open-parts"), "signature").join(placed.select("node", "grp", "block"), "node"), "open-held")
    blocks = written(ranked.groupBy("signature", "grp", "block").agg(F.max("rank").alias("top")), "open-blocks")
    # Every such pair of components once: the member of the smaller one asks.
    asks = ranked.select("signature", F.col("node").alias("query"), "component", "rank").join(blocks, "signature") \
        .where(F.col("rank") < F.col("top")).select("query", "component", "grp", "block").distinct()
    asks = written(asks, "queries")
    n_asks = asks.groupBy("grp", "block").agg(F.ceil(F.count("*") / QUERY_DOCS).alias("shares"))
    n_asks = written(n_asks, "query-shares")
    asked = asks.join(n_asks, ["grp", "block"]).select(
        "grp", "block", F.pmod(F.xxhash64("query", F.lit(2)), "shares").alias("share"), F.col("query").alias("node"), "component")
    asked = asked.join(tokens.select("node", "tokens"), "node")
    members = _fresh(tokens).select("node", "grp", "block", "tokens").join(_fresh(n_asks), ["grp", "block"]) \
        .join(_fresh(comp).select("node", "component"), "node") \
        .select("grp", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "node", "component", "tokens")
    key = ["grp", "block", "share"]
    across = asked.groupBy(*key).cogroup(members.groupBy(*key)).applyInPandas(
        lambda q, m: _ask_block(num, den)(q, m), EDGE)
    edges = written(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(across), "all-links")
    final = components(edges)

    # A plain join on the key: adaptive execution splits the copies of one text.
    of_key = written(reps.join(final, "node", "left").select("key", F.coalesce("component", "node").alias("component_id")), "component-of-key")
    return light.join(of_key, "key", "left").select(
        "doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _fresh(df: DataFrame) -> DataFrame:
    """The same rows under new column identities, for a table that both sides of a cogroup use."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) of all ``nodes``, those without an edge included."""
    labels = written(components(edges), "labels")
    return written(nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels")


def near_distinct_documents(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, all columns.

    The smallest doc_id of the component stays, a null one only if there is no other; of rows
    that repeat it one stays.
    """
    return by_row(docs, lambda rows: _near_distinct(rows, words, num, den))


def _near_distinct(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    found = jaccard_components(docs, words, num, den)
    gone = written(found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("gone_id")).distinct(), "near-copies")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
