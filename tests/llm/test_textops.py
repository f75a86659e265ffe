"""Hashes of words and shingles: no built collisions, pieces of long texts, plain re-statement."""

import re

import numpy as np
import pytest

from wattframe.llm.textops import Words, sequence_hash


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def words(*texts, lower=True):
    data = [t.encode() for t in texts]
    return Words(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0, *map(len, data)]), lower)


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_thue_morse_words_and_sequences_differ(n):
    w = words(thue_morse(n) + " " + thue_morse(n, "b", "a"))
    assert w.hash[0] != w.hash[1]
    x, y = words(" ".join(thue_morse(n))), words(" ".join(thue_morse(n, "b", "a")))
    assert x.whole(0) != y.whole(0) and sequence_hash(x.hash[:7]) != sequence_hash(x.hash[:8])


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(1)
    letters = list("abcé\U0001F600")
    lengths = [1, 2, 3, 63, 64, 65, 127, 128, 129, 1023, 5000]
    kinds = ["".join(rng.choice(letters, n)) for n in lengths for _ in range(4)] + ["a" * n for n in lengths]
    texts = [" ".join(rng.choice(kinds, 40)) + "\n" for _ in range(30)] + ["", " ", "x" * (3 << 20)]
    w = words(*texts)
    flat = [x for t in texts for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert len(flat) == len(w.hash) and w.bounds[-1] == len(flat)
    assert len(set(flat)) == len(set(w.hash.tolist())) == len(set(zip(flat, w.hash.tolist())))


def test_only_ascii_case_is_folded():
    w = words("Ab É é ab", lower=True)
    assert w.hash[0] == w.hash[3] and w.hash[1] != w.hash[2]
    assert len(set(words("Ab aB ab", lower=False).hash.tolist())) == 3


def test_filter_grows_with_the_values_and_loses_none(spark):
    from wattframe.llm.common import bloom, bloom_has

    rng = np.random.default_rng(3)
    sizes = []
    for n in (0, 10, 20_000):
        held, others = rng.integers(-2**62, 2**62, n), rng.integers(-2**62, 2**62, 20_000)
        values = [(int(x),) for x in [*held, *held[:5]]] + [(None,)]
        bits = np.frombuffer(bloom(spark.createDataFrame(values, "v long"), "v").value, dtype=np.uint8)
        sizes.append(len(bits))
        assert bloom_has(bits, held.astype(np.int64).view(np.uint64)).all()
        assert bloom_has(bits, others.view(np.uint64)).mean() < 0.05
    assert sizes[2] >= 4 * sizes[1]
