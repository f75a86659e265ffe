"""Ranked search, prefix token counts and the Merkle manifest against plain re-statements."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from wattframe.llm import merkle, prefix_counts, search

from . import helpers as H

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOC = "doc_id long, source string, lang string, n_chars long, text string"


def with_clashes(df, names):
    """``df`` with more columns, named like those that the operators use themselves."""
    return df.withColumns({n: F.lit("mine") for n in names if n not in df.columns})


# ---- search

def terms(text):
    return re.findall(TERM, (text or "").translate(H.ASCII_LOWER))


def ranked(docs, items, top):
    """[(item_id, rank, doc_id, score)] by scoring every document."""
    lists = [(d, Counter(terms(t))) for d, t in docs]
    lists = [(d, c) for d, c in lists if c]
    n, total = len(lists), sum(sum(c.values()) for _, c in lists)
    df = Counter(t for _, c in lists for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c in lists:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item_id, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(found, key=lambda r: r[:3])[:top])]
    return out


def search_docs():
    rng = random.Random(7)
    common, rare = [f"w{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    docs = [(i, " ".join(rng.choice(rare if rng.random() < 0.2 else common).title() for _ in range(rng.randrange(1, 60)))) for i in range(700)]
    docs += [(1000 + i, "W1 w2, r7é! w1") for i in range(120)]  # equal scores beyond the last rank
    docs += [(None, "w1 r9é r9é"), (5, docs[5][1]), (5, "r1é only"), (2000, None), (2001, ""), (2002, " .;"), (2003, "w3 " * 40000)]
    items = [(i, " ".join(rng.choice(common) for _ in range(6)) + " " + " ".join(rng.choice(rare) for _ in range(4))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "absent words"), (53, "w1 w1 W1 r7É r7é"), (53, "r9é"), (54, "r1é"), (54, "r1é"), (None, "w2 w3 r3é")]
    return docs, items


@pytest.mark.parametrize("block", [64, 1024])
def test_search_equals_scoring_everything(spark, monkeypatch, block):
    monkeypatch.setattr(search, "DOCS", block)
    docs, items = search_docs()
    d = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"), ["rank", "score", "item", "block", "n_terms"])
    q = with_clashes(spark.createDataFrame(items, "item_id long, text string"), ["rank", "score", "terms", "of"])
    got = search.search(d.repartition(3), q, top=50)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[2] is None, r[2] or 0, r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(ranked(docs, dict.fromkeys(items), 50), key=key)


def test_search_in_groups_of_queries_and_of_empty_tables(spark, monkeypatch):
    docs, items = search_docs()
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:12], "item_id long, text string")
    monkeypatch.setattr(search, "QUERY_BYTES", 100)
    assert sorted(map(tuple, search.search(d, q, top=3).collect())) == sorted(ranked(docs, items[:12], 3))
    assert search.search(d.limit(0), q).count() == 0 and search.search(d, q.limit(0)).count() == 0


def test_pair_bounds_skip_what_single_maxima_do_not():
    """Two terms that never meet: their joint bound is the larger of both, so the block is skipped."""
    weight = np.array([1, 1])
    block = search.Postings(np.array([0, 1], "u4").tobytes(), np.array([0, 1, 2], "u4").tobytes(), np.array([0, 1], "u2").tobytes(),
                            np.array([10, 9]), weight)
    units = [((0, 1), 0)]
    assert search.search_block(block, {}, units, 11, 2)[0].tolist() == []
    assert search.search_block(block, {}, units, 10, 2)[1].tolist() == [10]
    assert search.search_block(block, {0: (30, np.array([1], "u2"))}, units, 9, 2)[1].tolist() == [10, 9]


def test_terms_of_long_texts_are_whole():
    text = "Ab-ñ " * 1000 + "x" * 5000 + " end"
    assert [t.decode() for part in search.terms_of(text, 64) for t in part] == terms(text)


# ---- token counts at prefixes

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_every_prefix_has_the_librarys_count(library):
    rng = random.Random(3)
    alphabet = ["a", "b", "the", "  ", "   ", " ", "\n", "\t", "é", "é", "日本", "\U0001F600", "▁", "<s>", "</s>", "<0x41>", "\x00",
                "ing", " th", "1", "23", "==", "    ", "　", "ñ", "aaaa", "-----", "\n\n"]
    pieces = prefix_counts.Pieces.of_worker(MODEL)
    for size in (1 << 16, 5):
        for _ in range(250):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            counts = np.cumsum(np.concatenate([np.zeros(0, np.int8), *pieces.steps(text, size)]), dtype=int)
            assert counts.tolist() == [len(library.encode(text[:i + 1])) for i in range(len(text))], text


def test_pairs_stay_apart_as_merging_says():
    pieces = prefix_counts.Pieces.of_worker(MODEL)
    rng, some = random.Random(1), list(pieces.halves)
    for _ in range(3000):
        a, b = rng.choice(some), rng.choice(some)
        assert pieces._unwound(a, b) == (pieces.merged(a + b) == [a, b]), (a, b)


def count_rows():
    rng = random.Random(4)
    long_text = " ".join("".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9))) for _ in range(30000))
    return [(1, None), (2, ""), (3, "x" * 9000), (4, "<s> one </s>"), (None, "no id"), (4, "again"), (4, "again"), (5, " "), (6, long_text),
            (7, "\U0001F600" * 70000), (8, "  lines\n\nand\ttabs  ")]


def test_token_counts_and_cuts(spark, library, monkeypatch):
    monkeypatch.setattr(prefix_counts, "BLOCK", 4096)
    rows = count_rows()
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), ["row", "last", "n_tokens", "steps", "of"]).coalesce(2)
    got = sorted(map(tuple, prefix_counts.token_counts(df, MODEL, limit=4096).collect()), key=str)
    expected = []
    for doc_id, text in rows:
        text = text or ""
        n = len(library.encode(text))
        fits = len(text)
        if n > 4096:  # the last prefixes within the limit are close to where its tokens end
            guess = len(library.decode(library.encode(text)[:4096])) + 40
            fits = next(i for i in range(min(guess, len(text)), 0, -1) if len(library.encode(text[:i])) <= 4096)
        expected.append((doc_id, len(text.encode()), n, n > 4096, fits))
    assert got == sorted(expected, key=str)
    assert prefix_counts.token_counts(df.limit(0), MODEL).count() == 0


def test_stored_counts_answer_places_and_budgets(spark, library, monkeypatch):
    monkeypatch.setattr(prefix_counts, "BLOCK", 50)
    rows = [(i, t) for i, t in enumerate(["some words  of a text, " * 20, "", "日本 x" * 30, None, "end"])]
    table = prefix_counts.prefix_table(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), MODEL).cache()
    texts = {r.row: rows[r.doc_id][1] or "" for r in table.where("last").collect()}
    places = [(row, n) for row in texts for n in (0, 1, 49, 50, 51, 100, 119, 10**6)]
    got = prefix_counts.tokens_before(table, spark.createDataFrame(places, "row long, chars long")).collect()
    assert sorted(map(tuple, got)) == sorted((row, n, len(library.encode(texts[row][:n]))) for row, n in places)
    counts = [len(library.encode(texts[r])) for r in sorted(texts)]
    for budget in (0, counts[0], sum(counts) - 1, sum(counts)):
        taken = prefix_counts.within_budget(table, budget).count()
        assert taken == sum(sum(counts[:k + 1]) <= budget for k in range(len(counts)))
    table.unpersist()


# ---- manifest

def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, add=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, n_chars + add if n_chars is not None else None, text)
    return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([hashed("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def manifest(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by_lang[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = [tree([leaf_of(r) for r in by_lang[x]]) for x in langs]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(by_lang[x]):
            node = leaf_of(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            proof = ""
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    run = level[at // 2 * 2:at // 2 * 2 + 2]
                    proof += "".join(n for j, n in enumerate(run) if j != at % 2)
                    node = hashed("".join(node if j == at % 2 else n for j, n in enumerate(run)))
                    at //= 2
            out.append((r[0], trees[k][0][i], trees[k][-1][0], top[-1][0], hashed(proof), node, node == top[-1][0]))
    return out


def manifest_rows(n):
    rng = random.Random(n)
    rows = [(i * 3, rng.choice([None, "a", "bé"]), "en", rng.choice([None, 5, i]), rng.choice([None, "", "tëxt", "x" * 3000]) or f"t{i}") for i in range(n)]
    rows += [(i, "s", rng.choice(["de", "fr", "é", "Z"]), i, "other") for i in range(n // 7)]
    return rows + [(4, None, None, None, None), (5, "s", None, 1, ""), (None, "s", "en", 2, "t"), (None, None, "en", None, None)] + [(9, "s", "en", 4, "same")] * 3


@pytest.mark.parametrize("levels", [1, 3, 8])
def test_manifest_equals_plain_trees(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows = manifest_rows(300 if levels == 8 else 60)
    df = with_clashes(spark.createDataFrame(rows, DOC), ["tree", "pos", "node", "path", "block", "leaf", "root", "row"])
    got = merkle.manifest(df.repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(manifest(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 3, "abc")], [(1, "s", "en", 3, "abc"), (2, "s", "de", 3, "abc")]])
def test_manifest_of_few_rows(spark, rows):
    got = merkle.manifest(spark.createDataFrame(rows, DOC))
    assert sorted(map(tuple, got.collect())) == (sorted(manifest(rows)) if rows else [])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
