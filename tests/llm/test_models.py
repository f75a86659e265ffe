"""Mixing, quality classifier, language model, packing, pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattframe.llm import lm, mixing, packing, quality

from . import helpers as H


def test_mixing_hits_targets_and_keeps_the_cap(spark):
    rows = [(i, " ".join("w" * (i % 17)), None, None if i % 11 == 0 else f"s{i % 4}", None, None, None, None) for i in range(1500)]
    out = mixing.mixed(H.documents(spark, rows)).toPandas()
    assert len(out) == 1500 and (out.taken <= 2 * out["size"]).all()
    per = out.fillna({"source": "~"}).groupby("source").agg(size=("size", "sum"), told=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.told).all() and (abs(per.taken - per.target) <= 16).all()
    assert math.isclose(per.target.sum(), 1.5 * per["size"].sum()) and (per.target <= 2 * per["size"]).all()
    again = mixing.mixed(H.documents(spark, rows).repartition(7)).toPandas()
    assert out.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_mixing_odd_rows_and_documents(spark):
    docs = H.documents(spark)
    out = mixing.mixed(docs)
    taken = {r.doc_id: r.copies for r in out.collect()}
    assert set(taken) == {r[0] for r in H.odd_rows()}
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns
    assert Counter(r.doc_id for r in mix.collect()) == Counter({d: n for d, n in taken.items() if n})
    assert mixing.mixed(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(None, "a b", "x"), (None, "a b", "x"), (1, None, None)], "doc_id long, text string, source string")
    assert sorted(r["size"] for r in mixing.mixed(one).collect()) == [0, 2, 2]


def test_factorisation_machine_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=quality.N_FEATURES), rng.normal(size=(quality.N_FEATURES, quality.RANK)),
                        np.zeros(len(quality.STRUCTURE)), np.ones(len(quality.STRUCTURE)))
    col, val, s = np.array([3, 70, 900]), rng.normal(size=3), rng.uniform(-1, 1, (1, len(quality.STRUCTURE)))
    x = np.concatenate([np.zeros(quality.BUCKETS), m.structure(s)[0]])
    x[col] = val
    on = np.flatnonzero(x)
    pairs = sum(m.factors[i] @ m.factors[j] * x[i] * x[j] for a, i in enumerate(on) for j in on[:a])
    assert math.isclose(m.margins(np.zeros(3, int), col, val, s, 1)[0][0], 0.3 + m.linear @ x + pairs, rel_tol=1e-9)


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.scored(docs, labels)
    held = out.where("held_out").join(labels, "doc_id")
    assert out.count() == docs.count() and held.count() > 50
    assert held.where("predicted = quality").count() / held.count() > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out.collect())


def test_quality_odd_rows(spark):
    docs = H.documents(spark)
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(H.odd_rows())] + [(None, 1, None), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    out = quality.scored(docs, labels).collect()
    assert len(out) == len(H.odd_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert quality.scored(docs, labels.limit(0)).count() == len(out)
    assert quality.scored(docs.limit(0), labels).count() == 0
    kept = quality.accepted_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)


def test_lm_base_scores_and_normalisation(spark):
    rows = [(r[0], r[1]) for r in H.odd_rows()]
    out = {r.doc_id: r for r in lm.lm_scored(H.documents(spark)).collect()}
    tokens = {d: [*(w.encode() for w in H.words(t, lower=True)), None] for d, t in rows}
    counts = Counter()
    for d, t in tokens.items():
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    for d, t in tokens.items():
        r = out[d]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(counts[x] > 0 for x in t), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0
        assert r.held_out == (zlib.crc32(str(d).encode()) % 10 == 0)
    assert lm.lm_scored(H.documents(spark).limit(0)).count() == 0


def _counts(spark, tokens):
    """A table of counts of hashes, as ``lm.token_counts`` gives it."""
    kinds, n = np.unique(tokens, return_counts=True)
    return spark.createDataFrame(list(zip(kinds.view(np.int64).tolist(), n.tolist())), "hash long, c long")


def _probability(model, counts, hashes, token):
    """Of one token given the (up to three) before it, by a plain walk down the tree."""
    def weight(feature, klass):
        x = (int(feature) ^ (klass * 0x9E3779B1 % 2**32)) * 0x85EBCA6B % 2**32
        x = (x ^ (x >> 15)) * 0xC2B2AE35 % 2**32
        return float(model.weights[x >> (32 - int(math.log2(len(model.weights))))])

    own = dict(zip(model.vocabulary.tolist(), model.leaf.tolist()))
    features = [f[-1] for f in lm.context_features(np.append(hashes, np.uint64(token)), np.arange(len(hashes) + 1))]
    p, leaf = 1.0, own.get(token)
    if leaf is None:
        k = token >> (64 - model.rare_bits)
        leaf = int(model.rare_leaf[k])
        p = (counts.get(token, 0) + 0.1) / 10 ** model.rare_log[k]
    for i in range(model.start[leaf], model.start[leaf + 1]):
        klass = int(model.way[i])
        odds = float(model.bias[klass]) + sum(weight(f, klass) for f in features)
        p /= 1 + math.exp(-odds * model.right[i])
    return p


@pytest.mark.parametrize("frequent", [1 << 18, 60])
def test_lm_probabilities_sum_to_one_and_training_helps(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rng = np.random.default_rng(2)
    hashes = np.sort(rng.integers(1, 1 << 63, 300).astype(np.uint64) * np.uint64(2))
    text = hashes[np.cumsum(rng.integers(0, 3, 6000)) % 300]  # the next word follows from the last one
    text = np.append(text, hashes[:5].repeat(400))
    model, _, _, n, v = lm.fitted(_counts(spark, text))
    assert n == len(text) and v == 300 and (len(model.vocabulary) == 300) == (frequent > 60)
    place = np.arange(len(text))
    before = model.logs(text, place)[0].mean()
    seen = np.zeros_like(model.weights)
    for _ in range(8):
        model.learn(text, place, seen)
    assert model.logs(text, place)[0].mean() > before + 0.2
    counts = Counter(text.tolist())
    unknown = [(k << (64 - model.rare_bits)) + 1 for k in range(1 << model.rare_bits)]  # one unseen word of every hashed class
    for i in (3, 100, 5000):
        total = sum(_probability(model, counts, text[i - 3:i], t) for t in [*hashes.tolist(), *unknown])
        assert math.isclose(total, 1.0, rel_tol=1e-4)


@pytest.mark.parametrize("frequent", [1 << 18, 1 << 9])
def test_lm_scores_equal_a_direct_sum(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.2, 60) % 4000) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.doc_id: r for r in lm.lm_scored(docs).collect()}
    tokens = {}
    for d, t in enumerate(texts):
        (_, w), = lm.words_of(pa.RecordBatch.from_pydict({"text": [t]}), lower=True)
        tokens[d] = lm.token_hashes(w)[0]
    learnt = np.concatenate([t for d, t in tokens.items() if not got[d].held_out])
    counts = Counter(learnt.tolist())
    model = lm.fitted(_counts(spark, learnt))[0]
    assert (len(model.vocabulary) < len(counts)) == (frequent == 1 << 9)
    model = lm.train(docs.where(~lm.held_out(F.col("doc_id"))), model)
    assert np.abs(model.weights).max() > 0
    for d, t in tokens.items():
        total = sum(math.log10(_probability(model, counts, t[:i], h)) for i, h in enumerate(t.tolist()))
        assert math.isclose(got[d].score, total, rel_tol=1e-4), d


def test_lm_grows_with_the_corpus_and_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = [lm.fitted(lm.token_counts(d))[0] for d in (docs.where("doc_id < 100"), docs)]
    assert len(sizes[0].vocabulary) < len(sizes[1].vocabulary) and len(sizes[0].weights) < len(sizes[1].weights)
    r = lm.lm_scored(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert r.s / r.n > r.b / r.n + 0.02


def test_plan_uses_every_piece_once_near_the_bound():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(1, 2049, 4000), np.full(500, 1025), rng.integers(1, 30, 3000), np.array([2047, 1, 1024, 1024, 700, 700, 648])):
        counts = Counter(lengths.tolist())
        used, bins = Counter(), 0
        for pattern, n in packing.plan(counts):
            assert sum(pattern) <= 2048 and n > 0
            bins += n
            for x in pattern:
                used[x] += n
        assert used == counts
        big = sum(x > 1024 for x in lengths)
        assert bins <= max(big, math.ceil(lengths.sum() / 2048)) * 1.12 + 1
    assert packing.plan({}) == []


def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = H.odd_rows() + [H.odd_rows()[6]]  # a repeated row
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.packed(H.documents(spark, rows).repartition(3)).toPandas()
    ids = {r[0]: np.array(reference.encode(r[1] or "", add_special_tokens=False).ids + [0], dtype="<u4") for r in rows}
    for d, g in out.groupby("doc_id"):
        times = sum(r[0] == d for r in rows)
        for _, p in g.iterrows():
            assert zlib.crc32(ids[d][p.start:p.start + p.length].tobytes()) == p.ids_crc32
        assert g.length.sum() == times * len(ids[d]) and (g.length[g.piece > 0] == 2048).all()
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == np.concatenate([[0], np.cumsum(g.length)[:-1]]).tolist() and g.length.sum() <= 2048
    assert packing.packed(H.documents(spark).limit(0)).count() == 0


def test_tokens_equal_the_tokenizer_on_real_texts(spark):
    from tokenizers import Tokenizer

    bpe = packing.ByteBpe.of_worker()
    reference = Tokenizer.from_file(bpe.vocabulary)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for t in texts + [" lead", "trail ", "a  b", "it's  we'll", " x y", "a\n\n b", "x\u0085 y", "é 12 3a"]:
        assert bpe.ids(t) == np.array(reference.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, empty):
    import corpus_pipeline
    from wattframe.llm.common import written

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.limit(0) if empty else docs
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    if not empty:
        assert sizes[2] > 100 and docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_stages_keep_columns_that_clash_with_their_own(spark):
    from wattframe.llm import exact, mixing

    rows = [(1, "a b c", "s", 7, "x", "y", "z"), (1, "a b c", "s", 8, None, "y", "z"), (None, "d e", None, 9, "x", None, "z"), (2, None, "s", 10, "x", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, OWN_ID long, _copy string, _copy_2 string, _Copy_ string")
    kept = exact.kept_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 3 and {tuple(r) for r in kept.collect()} <= set(rows)
    mix = mixing.mixed_documents(docs)
    assert mix.columns == docs.columns and {tuple(r) for r in mix.collect()} <= set(rows)
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
