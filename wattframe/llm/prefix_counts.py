"""Exact token counts at every prefix of a text (SentencePiece BPE), by dynamic programming.

The tokens of a text are the only sequence of pieces in which every two neighbours stay apart
when they alone are merged. So the last token of a prefix follows from those of shorter
prefixes: it is the piece ending there whose left neighbour, the last token of the prefix before
it, does not merge with it. One pass over a text gives the count of every prefix. Counts are
stored as one signed byte for each code point (the change against the prefix one shorter) in
blocks; how many tokens a prefix has, where a text must be cut to fit a limit and which texts fit
a budget are then answered from the table, without tokenising again.

No piece of the vocabularies served here holds a space after another character, and characters
outside the vocabulary (line feeds among them) never merge, so the texts' parts between such
places are independent: each worker remembers the prefix counts of parts it has seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import written

#: Limit of the registered query.
LIMIT = 4096
#: Code points of a text in one row of the table.
BLOCK = 1 << 16
#: Parts and pairs of pieces that a worker remembers at most.
PARTS, PAIRS = 500_000, 300_000
SPACE = "▁"
#: Parts that no merge crosses, and where one begins.
_PART = re.compile("[▁\n]+[^▁\n]*")
_BORDER = re.compile("(?<=[^▁\n])[▁\n]")

TABLE = ("row long, doc_id long, block int, last boolean, start_chars long, start_tokens long, "
         "end_tokens long, n_bytes long, steps binary")


class Pieces:
    """A SentencePiece BPE model: merges of short strings and prefix counts of any text."""

    _loaded: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        #: Merge order of every piece: higher scores first, equal ones from the left.
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids if i not in special}
        self.longest = max(map(len, self.score))
        self.bytes = any(model.is_byte(i) for i in ids)
        if any(SPACE in p.lstrip(SPACE) for p in self.score) or "\n" in self.score or not self.bytes:
            raise ValueError("pieces with inner spaces or line feeds, or without byte fallback, are not supported")
        probe = "  ﬁ é\t\x01　x  "
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("models that normalise texts are not supported")
        #: Piece -> the two strings that its last merge joins; none for characters.
        self.halves, self.irregular = {}, set()
        #: Beginning of a piece -> whether it is one that can be a token.
        self.starts: dict[str, bool] = {}
        for piece in self.score:
            self._learn(piece)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.parts: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, path: str) -> "Pieces":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn(self, piece: str) -> None:
        """What ``apart`` and ``part_steps`` need to know of a piece."""
        if len(piece) > 1:
            trail = []
            if self.merged(piece, trail) != [piece]:
                return
            self.halves[piece] = trail[-1]
            if any(len(x) > 1 and self.score[x] <= self.score[piece] for x in trail[-1]):
                self.irregular.add(piece)
        for k in range(1, len(piece)):
            self.starts.setdefault(piece[:k], False)
        self.starts[piece] = True

    def merged(self, text: str, trail: list | None = None) -> list[str]:
        """The pieces of a short string: the best pair of neighbours merges, until none can."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            if trail is not None:
                trail.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def apart(self, left: str, right: str) -> bool:
        """Whether two pieces stay two tokens next to each other.

        Takes back their merges, the latest first, down to two characters: they stay apart if at
        no time the two strings at their border had a merge that came before the next one of
        either. Equal merges go from left to right.
        """
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._unwound(left, right)
        return found

    def _unwound(self, a: str, b: str) -> bool:
        if a in self.irregular or b in self.irregular:
            return self.merged(a + b) == [a, b]
        score, halves = self.score, self.halves
        s = score.get(a + b)
        while s is None:
            x, y = halves.get(a), halves.get(b)
            if x is None and y is None:
                return True
            if y is None or x is not None and score[a] < score[b]:
                until, a = score[a], x[1]
                s = score.get(a + b)
                if s is not None and s <= until:
                    s = None
            else:
                until, b = score[b], y[0]
                s = score.get(a + b)
                if s is not None and s < until:
                    s = None
        return False

    def part_steps(self, part: str) -> bytes:
        """Change of the token count by each character of ``part``.

        From every place all pieces that begin there are tried against the last token of the
        prefix before it. A stretch of ``BLOCK`` places is kept at a time.
        """
        starts, pairs, apart, most, n = self.starts, self.pairs, self.apart, self.longest, len(part)
        steps = bytearray(n)
        last, count = [""], [0]
        for base in range(0, n, BLOCK):
            room = min(n - base, BLOCK + most) + 1
            last += [None] * (room - len(last))
            count += [0] * (room - len(count))
            here = min(BLOCK, n - base)
            for j in range(here):
                left, c = last[j], count[j]
                at = base + j
                piece = part[at]
                whole = starts.get(piece)
                if whole is None:
                    last[j + 1], count[j + 1] = "", c + len(piece.encode())
                else:
                    k = j + 1
                    while True:
                        if whole and last[k] is None and (not left or (
                                ok if (ok := pairs.get((left, piece))) is not None else apart(left, piece))):
                            last[k], count[k] = piece, c + 1
                        k += 1
                        if k >= room:
                            break
                        piece = part[at:base + k]
                        whole = starts.get(piece)
                        if whole is None:
                            break
                steps[at] = (count[j + 1] - c) & 255
            last, count = last[here:], count[here:]
        return bytes(steps)

    def _new_part(self, part: str) -> bytes:
        steps = self.part_steps(part)
        if len(self.parts) < PARTS and len(part) < 64:
            self.parts[part] = steps
        return steps

    def steps(self, text: str, size: int = BLOCK) -> Iterator[np.ndarray]:
        """Changes of the count by each code point of ``text``, about ``size`` at a time."""
        known, new = self.parts.get, self._new_part
        text = SPACE + text.replace(" ", SPACE)
        at, n = 0, len(text)
        while at < n:
            border = _BORDER.search(text, at + size)
            end = border.start() if border else n
            s = np.frombuffer(b"".join([known(x) or new(x) for x in _PART.findall(text, at, end)]), dtype=np.int8)
            if at == 0:  # the space that the model puts before a text counts with the first code point
                s, before = s[1:].copy(), s[0]
                s[:1] += before
            if len(s):
                yield s
            at = end


def prefix_table(docs: DataFrame, model: str) -> DataFrame:
    """Token counts at every prefix of ``docs`` (doc_id, text): see ``TABLE``.

    ``row`` numbers the rows of ``docs``; block k of a row starts after ``start_chars`` code points
    and ``start_tokens`` tokens, and ``steps`` holds one signed byte for each further code point.
    Every row has a block flagged ``last`` (with no steps if the text is null or empty), with the
    count of the whole text in ``end_tokens`` and its UTF-8 bytes in ``n_bytes``. ``model`` is the path of a
    SentencePiece BPE model that does not normalise texts. A text of any length is processed a
    block at a time.
    """
    def table(batches):
        pieces = Pieces.of_worker(model)
        for batch in batches:
            rows, held = [], 0
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or ""
                block = chars = tokens = 0
                size = len(text) if text.isascii() else len(text.encode())
                pending = None
                for whole in pieces.steps(text):
                    for at in range(0, len(whole), BLOCK):
                        s = whole[at:at + BLOCK]
                        if pending is not None:
                            rows.append((*pending[:3], False, *pending[3:]))
                        end = tokens + int(s.sum(dtype=np.int64))
                        pending = (row, doc_id, block, chars, tokens, end, size, s.tobytes())
                        block, chars, tokens = block + 1, chars + len(s), end
                        held += len(s)
                pending = pending or (row, doc_id, 0, 0, 0, 0, size, b"")
                rows.append((*pending[:3], True, *pending[3:]))
                if held > 1 << 20:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text"))
    return numbered.mapInArrow(table, TABLE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    names = [c.split()[0] for c in TABLE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _of_blocks(table: DataFrame, answer, kind: str) -> DataFrame:
    """``answer(counts, start_chars)`` of every block, beside its other columns; ``counts`` are those of its prefixes."""
    names = ["row", "doc_id", "last", "end_tokens", "n_bytes"]

    def each(batches):
        for b in batches:
            found = [answer(start_tokens + np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64), start_chars)
                     for steps, start_tokens, start_chars in zip(*(b.column(c).to_pylist() for c in ("steps", "start_tokens", "start_chars")))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(found, pa.int64())], [*names, "answer"])

    return table.mapInArrow(each, f"row long, doc_id long, last boolean, end_tokens long, n_bytes long, answer {kind}")


def within(table: DataFrame, limit: int) -> DataFrame:
    """Per row of the documents: doc_id, n_bytes, n_tokens and fits_chars.

    ``fits_chars`` is the length in code points of the longest prefix of at most ``limit`` tokens: where a
    text must be cut, also where a longer prefix has fewer tokens than a shorter one.
    """
    def longest(counts: np.ndarray, start: int):
        fits = np.flatnonzero(counts <= limit)
        return start + int(fits[-1]) + 1 if len(fits) else 0

    blocks = _of_blocks(table, longest, "long")
    return blocks.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
        F.max(F.when(F.col("last"), F.col("end_tokens"))).alias("n_tokens"), F.max("answer").alias("fits_chars"))


def tokens_before(table: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (row, chars) with ``tokens``: the exact count of the first ``chars`` code points.

    ``chars`` beyond the text's end means the whole text; 0, less or null is the empty prefix.
    """
    length = F.octet_length("steps")
    p = places.select(F.col("row").alias("of"), F.greatest(F.coalesce("chars", F.lit(0)), F.lit(0)).alias("chars"))
    inside = (F.col("chars") > F.col("start_chars")) | (F.col("block") == 0)
    hit = table.join(p, F.col("row") == F.col("of")).where(
        inside & (F.col("last") | (F.col("chars") <= F.col("start_chars") + length)))

    def count(batches):
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("steps", "start_tokens", "start_chars", "chars")))
            found = [t + int(np.frombuffer(s, dtype=np.int8)[:max(n - c, 0)].sum(dtype=np.int64)) for s, t, c, n in rows]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("chars"), pa.array(found, pa.int64())], ["row", "chars", "tokens"])

    return hit.select("row", "steps", "start_tokens", "start_chars", "chars").mapInArrow(count, "row long, chars long, tokens long")


def within_budget(table: DataFrame, budget: int) -> DataFrame:
    """(row, doc_id, n_tokens) of the documents that fit a budget of tokens, in the order of their rows.

    Rows are taken in ascending order as long as the sum of their tokens stays within
    ``budget``. Sums run per block of 2**16 rows first, so that no task meets all rows.
    """
    rows = table.where("last").select("row", "doc_id", F.col("end_tokens").alias("n_tokens"),
                                      F.shiftright("row", 16).alias("run"))
    runs = rows.groupBy("run").agg(F.sum("n_tokens").alias("in_run")).selectExpr(
        "run as of_run", "sum(in_run) over (order by run rows between unbounded preceding and current row) - in_run as before")
    upto = rows.selectExpr("*", "sum(n_tokens) over (partition by run order by row) as upto")
    return upto.join(runs, F.col("run") == F.col("of_run")).where(F.col("before") + F.col("upto") <= budget).select(
        "row", "doc_id", "n_tokens")


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit, fits_chars.

    Written prefix counts answer all of them. ``n_tokens`` is what the library gives for the whole
    text without added tokens; ``over_limit`` says that it exceeds ``limit``; ``fits_chars`` is the longest
    prefix within it. A null text counts as empty: no bytes, no tokens. doc_ids may be null or
    repeat: every row is counted by itself. Very long texts, also of a single word, are counted block by block. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    table = written(prefix_table(docs, model), "prefix-counts")
    return within(table, limit).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fits_chars")
