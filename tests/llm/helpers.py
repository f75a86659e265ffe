"""A small table with the odd cases, and plain re-statements of the operators."""

import hashlib
import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, hash string, key string"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(ASCII_LOWER) if lower else text)


def odd_rows():
    """Null and empty texts, blanks, copies, near copies, shared passages, long texts, null columns."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "é", "on", "ther", "ing")]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(120), prose(30)
    near = [base.split() for _ in range(6)]
    for i, w in enumerate(near):
        w[10 + 13 * i] = f"changed{i}"
    texts = [None, "", "  \t\n ", "one", "one two", "One  Two x", base, base, base.upper(), base.replace(" ", "\n"),
             *(" ".join(w) for w in near), prose(40) + " " + passage + " " + prose(40), passage, passage + " " + prose(20),
             "\U0001F600 é a@b.co +1 (988) 555-2485", "Released under the MIT License.", prose(6000), "x" * 30000, prose(60), prose(14),
             "<|endoftext|> two  spaces here", prose(300), prose(300)]
    rows = [(i * 3, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None, None, None, None) for i, t in enumerate(texts)]
    return rows


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)


def shingles(text, n):
    w = words(text, lower=True)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(texts, n, num, den):
    sets = {d: shingles(t, n) for d, t in texts}
    inverted = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for b in inverted[x]:
                if b > a:
                    shared[b] += 1
        for b, o in shared.items():
            if den * o >= num * (len(s) + len(sets[b]) - o):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def without_repeats(texts, window=13):
    first = {}
    lists = {d: words(t) for d, t in texts}
    for d in sorted(lists):
        w = lists[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), d)
    out = {}
    for d, w in lists.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out
