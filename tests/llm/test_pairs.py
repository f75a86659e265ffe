"""N-gram Jaccard join, substring dedup, exact dedup."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.llm import components as cc
from wattframe.llm import exact, jaccard, substrings

from . import helpers as H


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_jaccard_equals_brute_force(spark, n, num, den):
    rows = H.odd_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(H.documents(spark), n, num, den).collect()}
    assert got == H.components([(r[0], r[1]) for r in rows], n, num, den)


def test_jaccard_large_borderline_group_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 8)
    monkeypatch.setattr(jaccard, "QUERY_DOCS", 4)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for d in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"c{rng.randrange(40)}"
        texts.append((d, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, 3, 8, 10).collect()}
    assert got == H.components(texts, 3, 8, 10)


def test_cuts_share_as_many_parts_as_needed_between_similar_sets():
    rng = np.random.default_rng(1)
    for num, den in ((9, 10), (4, 5), (1, 2)):
        cuts = jaccard.Cuts(num, den)
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            drop = int(rng.integers(0, max(1, len(a) * (den - num) // den) + 1))
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64)]))
            if not len(b):
                continue
            o = len(np.intersect1d(a, b))
            if jaccard.similar(o, len(a), len(b), num, den):
                one, two = ({k: (need, x) for k, need, x in cuts.signatures(s)} for s in (a, b))
                k = int(np.searchsorted(cuts.hi_array, max(len(a), len(b))))
                assert np.intersect1d(one[k][1], two[k][1]).size >= max(one[k][0], two[k][0])


def test_jaccard_null_ids_repeated_rows_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "q r s t u"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 1, None), (None, 0, None)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_near_distinct_keeps_one_of_each_group(spark):
    docs = H.documents(spark)
    expect = H.components([(r[0], r[1]) for r in H.odd_rows()], 5, 4, 5)
    kept = jaccard.near_distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in expect.items() if c == d)


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in cc.components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_substring_dedup_equals_brute_force(spark):
    rows = H.odd_rows()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(H.documents(spark)).collect()}
    assert got == H.without_repeats([(r[0], r[1]) for r in rows])


def test_substring_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(None, text), (2, text), (2, "other " + text), (3, text + " tail"), (4, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substrings.without_repeats(df).collect()), key=str)
    assert got == sorted([(None, 20, 0), (2, 20, 0), (2, 21, 0), (3, 21, 20), (4, 0, 0)], key=str)
    assert substrings.without_repeats(df.limit(0)).count() == 0


def test_substring_dedup_chunks_of_few_words(spark):
    long = " ".join(f"w{i}" for i in range(200_000))  # over 1 MB: the texts beside it are chunks of their own
    for texts in (["a b c"], ["one two", long, "a b c d e"]):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.without_repeats(df).collect()}
        assert got == H.without_repeats(enumerate(texts))


def test_repeat_levels_double_until_none_survives(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, shared + " a"), (2, "b " + shared), (3, " ".join(f"x{i}" for i in range(50)))], "doc_id long, text string")
    assert {r.doc_id: r.longest for r in substrings.repeat_levels(df).collect()} == {1: 52, 2: 52}


def test_exact_dedup_rules_and_index(spark):
    df = spark.createDataFrame(
        [(5, "a b"), (3, "ab"), (4, "a  b"), (9, "a\tb\n"), (7, None), (8, " "), (6, ""), (10, "AB"), (None, "ab")],
        "doc_id long, text string")
    index = exact.DigestIndex(spark)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in index.add(df).collect()}
    assert got == {5: (4, 5, False), 3: (4, 5, False), 4: (4, 5, True), 9: (4, 5, False), None: (4, 5, False),
                   7: (8, 3, False), 8: (8, 3, True), 6: (8, 3, False), 10: (10, 1, True)}
    later = spark.createDataFrame([(1, "a b      "), (2, "new"), (2, "new")], "doc_id long, text string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in index.add(later).collect())
    assert got == [(1, 4, 1, False), (2, 2, 2, True), (2, 2, 2, True)]
    assert index.read().count() == 4
    assert exact.exact_dedup(df.limit(0)).count() == 0
    docs = H.documents(spark)
    kept = exact.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in exact.exact_dedup(docs).collect())


def test_exact_dedup_hot_text(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("same  text")).otherwise(F.col("id").cast("string")).alias("text")) \
        .withColumnRenamed("id", "doc_id")
    out = exact.exact_dedup(df)
    assert out.where("kept").count() == 2001 and out.where("group_size = 1000").select("keep_id").distinct().collect()[0][0] == 0


def test_dedup_stages_keep_one_row_of_repeated_and_null_ids(spark):
    base = [f"w{i}" for i in range(80)]
    near = " ".join(base[:79] + ["other"])  # 75 of 77 five-word shingles shared
    copy, unique, lone = " ".join(base), "a text of its own that nobody else has", "x y z " * 9
    rows = [(7, copy, "a"), (7, copy, "a"), (7, copy, "b"), (7, unique, "c"), (3, copy, "d"), (None, copy, "e"), (None, near, "f"),
            (None, lone, "g"), (None, lone, "g"), (9, near, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    exactly = exact.kept_documents(docs)
    assert exactly.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in exactly.collect()), key=str) == sorted([(3, copy), (7, unique), (9, near), (None, lone)], key=str)
    nearly = jaccard.near_distinct_documents(docs)
    assert nearly.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in nearly.collect()), key=str) == sorted([(3, copy), (7, unique), (None, lone)], key=str)


def test_texts_built_to_collide_stay_apart(spark):
    """Thue-Morse words, and texts in that order of two words, are different texts for every operator."""
    def order(n, a, b):
        return [b if bin(i).count("1") % 2 else a for i in range(n)]

    tail = " ".join(f"w{i}" for i in range(20))
    texts = ["".join(order(1024, "a", "b")) + " x y", "".join(order(1024, "b", "a")) + " x y",
             " ".join(order(1024, "p", "q")), " ".join(order(1024, "q", "p")) + " " + tail, tail]
    docs = H.documents(spark, [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, words=3, num=9, den=10).collect()}
    assert got == H.components(list(enumerate(texts)), 3, 9, 10)
    out = substrings.without_repeats(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out.collect()} == H.without_repeats(list(enumerate(texts)))
