"""Fingerprints, licenses, personal data: native operators against plain re-statements."""

import hashlib
import math
import random
import re

from wattframe.llm import fingerprints as fp
from wattframe.llm import licenses, pii

from . import helpers as H


def _native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|InArrow", plan)


def test_fingerprints_edit_and_estimates(spark):
    rows = H.odd_rows()
    df = fp.fingerprints(H.documents(spark))
    assert _native(df)
    got = {r.doc_id: r for r in df.collect()}
    ids = sorted(r[0] for r in rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for k, d in enumerate(ids):
        t, nxt = texts[d], texts[ids[(k + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == t:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
        a, b = (set(map(tuple, _shingles(x))) for x in (t, edited))
        if len(a) > 1000:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 0.08
        if len(a) <= fp.SMALL and len(b) <= fp.SMALL and a | b:
            assert abs(r.near_edited - len(a & b) / len(a | b)) < 1e-9


def _shingles(text):
    w = H.words(text)
    return [w[i:i + 5] for i in range(len(w) - 4)] if len(w) >= 5 else ([w] if w else [])


def test_sketches_merge_and_contain(spark):
    a = " ".join(f"a{i}" for i in range(3000))
    b = " ".join(f"b{i}" for i in range(400))
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, both string")
    for c in ("a", "b", "both"):
        df = fp.with_sketch(df, c, f"{c}_scale", f"{c}_sketch")
    r = df.select(fp.containment(df.b_scale, df.b_sketch, df.both_scale, df.both_sketch).alias("inside"),
                  fp.likeness(df.a_scale, df.a_sketch, df.b_scale, df.b_sketch).alias("apart"),
                  fp.merged(df.a_scale, df.a_sketch, df.b_scale, df.b_sketch).alias("merged"), "both_sketch").first()
    assert r.inside == 1.0 and r.apart == 0.0
    assert len(set(r.both_sketch) - set(r.merged)) <= 4 and set(r.merged) <= set(r.both_sketch)


def test_merging_equals_sketching_the_whole(spark):
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    rows = []
    for n, m in ((9, 0), (60, 70), (3000, 3000), (4100, 4100), (9000, 400), (50000, 30)):
        a, b = prose(n), prose(m)
        b = a[-4:] + b if m else b           # the shingles of the joined text are those of both parts
        rows.append((" ".join(a), " ".join(b), " ".join(a + b[4:])))
    df = spark.createDataFrame(rows, "a string, b string, both string")
    for c in ("a", "b", "both"):
        df = fp.with_sketch(df, c, f"{c}_scale", f"{c}_sketch")
    parts = [df[c] for c in ("a_scale", "a_sketch", "b_scale", "b_sketch")]
    for r in df.select("*", fp.merged(*parts).alias("merged"), fp.merged_scale(*parts).alias("scale"),
                       fp.containment(*parts[2:], df.both_scale, df.both_sketch).alias("inside")).collect():
        assert (r.merged, r.scale) == (r.both_sketch, r.both_scale) and r.inside in (1.0, None)


def test_fingerprints_of_repetitive_texts(spark):
    texts = ["", *(f"{w} " * 1000 for w in "abcdefgh"), "\n".join(["one line of a few words"] * 300)]
    got = fp.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    by_id = {r.doc_id: r for r in got}
    assert len({r.fingerprint for r in got}) == len(texts) and by_id[0].fingerprint == "1:"
    for d, t in enumerate(texts):
        nxt = texts[(d + 1) % len(texts)]
        a, b, e = (set(map(tuple, _shingles(x))) for x in (t, nxt, t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]))
        assert by_id[d].near_next == 0
        assert abs(by_id[d].near_edited - (len(a & e) / len(a | e) if a | e else 1)) < 1e-9
        assert by_id[d].fingerprint.count(",") == max(len(a) - 1, 0)


def test_fingerprints_estimates_of_middle_and_long_texts(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    texts = []
    for n in (65, 70, 90, 130, 200, 300, 500, 750, 1000, 5000, 9000):
        w = prose(n + 4).split()
        texts += [" ".join(w), " ".join(w[:n // 2] + prose(n // 3).split())]
    got = {r.doc_id: r for r in fp.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for d, t in enumerate(texts):
        nxt = texts[(d + 1) % len(texts)]
        a, b, e = (set(map(tuple, _shingles(x))) for x in (t, nxt, t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]))
        for told, x in ((got[d].near_edited, e), (got[d].near_next, b)):
            assert abs(told - len(a & x) / len(a | x)) < (1e-9 if max(len(a), len(x)) <= 1000 else 0.1), (d, len(a))


def test_fingerprints_null_and_repeated_ids_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "z z z z z"), (None, "abcdefgh"), (2, None)], "doc_id long, text string")
    out = fp.fingerprints(df).collect()
    assert len(out) == 5
    alone = next(r for r in out if r.doc_id is None)
    assert alone.edited_sha256 == hashlib.sha256(b"abcdef").hexdigest() and alone.near_next == 0
    assert fp.fingerprints(df.limit(0)).count() == 0


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s), 1):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group(0).split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group(0))
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m.group(0))) <= 15]
    return sorted(out)


PII_TEXTS = ["a@b.c+d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 1.1.1.256 0001.2.3.4", "\U0001F600 é a@b.co +1 (988) 555-2485",
             "4111 1111 1111 1111 4111-1111-1111-1112", "1" * 30000, "a" * 100000, "1." * 3000, "+1+1+1+12345678901", None, "",
             "@" * 1000, "a@b a@b.c@d.e.f@g.h", "..@-.-", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
             "iban GB82 WEST 1234 5698 7654 32 ok DE89370400440532013000 DE89370400440532013001 FR7630006000011234567890189",
             "ssn 123-45-6789 vs 987-65-4321 123-45-6789", "call (555) 123-4567 or 555-123-4567"]


def test_personal_data_equals_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(PII_TEXTS)] + [(100 + r[0], r[1]) for r in H.odd_rows()]
    df = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _native(df)
    got = {r.doc_id: r for r in df.collect()}
    for d, t in rows:
        s = base_spans(t or "")
        joined = ",".join(f"{k}:{a}:{e}" for a, _, k, e in s)
        r = got[d]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[2] == k for x in s) for k in ("email", "ip", "card", "phone")], d
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), d
        assert {x for x in joined.split(",") if x} <= set(r.spans.split(","))
    extra = {k: [x for x in got[k].spans.split(",") if x.split(":")[0] in ("iban", "ssn", "local_phone")] for k in (14, 15, 16)}
    assert [PII_TEXTS[14][int(x.split(":")[1]):int(x.split(":")[2])] for x in extra[14]] == [
        "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "FR7630006000011234567890189"]
    assert extra[15] == ["ssn:4:15"]  # a context word stands before the first one only
    assert [x.split(":")[0] for x in extra[16]] == ["local_phone"]
    assert pii.personal_data(df.select("doc_id").limit(0).selectExpr("doc_id", "cast(null as string) as text")).count() == 0


def test_licenses_equal_brute_force(spark):
    texts = ["The MIT License mit-license MIT\nLicense", "license license mit license", "general public license general public license",
             "Licensed under the Apache License, Version 2.0.", None, "", "K K", "apache license " * 1500, "éMIT license mité license",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "mit der und",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
             "permission hereby free"] + [r[1] for r in H.odd_rows()]
    df = licenses.licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert _native(df)
    got = {r.doc_id: r for r in df.collect()}
    for d, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(H.ASCII_LOWER))
        at, labels = [], set()
        for label, phrase in licenses.PHRASES.items():
            p = phrase.split()
            places = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            at += places
            labels |= {label} if places else set()
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))), d
        assert labels <= set(r.labels.split(",")) | set() and 0 <= r.score <= 1
    assert got[3].labels == "apache,apache-2.0" and got[9].labels == "gpl,gpl-notice" and got[10].labels == "cc-by-nc"
    assert got[12].labels == "mit-grant" and got[13].labels == "" and got[11].labels == ""
    assert licenses.licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_labels_equal_brute_force(spark):
    rng = random.Random(12)
    filler = "the of and under this software license is in copy to any notice version public conditions".split()
    texts = []
    for _, wording, _ in licenses.TEMPLATES:
        w = wording.split()
        for lost in (0, 0.1, 0.3, 0.5, 0.8):  # words replaced, so that some are above and some below the share needed
            body = [x if rng.random() >= lost else rng.choice(filler + ["zzz"]) for x in w]
            texts.append(" ".join(rng.choices(filler, k=rng.randrange(6)) + body + rng.choices(filler, k=9)).capitalize())
        texts += [" ".join(w[3:]), " ".join(w[:len(w) * 2 // 3]), " ".join(sorted(w)), " ".join(w + w)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n_docs, frequency = licenses.document_frequencies(df)
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(H.ASCII_LOWER)) for t in texts]
    assert n_docs == len(texts) and all(frequency.get(x, 0) == sum(x in w for w in split) for x in licenses.vocabulary())
    got = {r.doc_id: r for r in licenses.licenses(df).collect()}
    n_found = 0
    for d, w in enumerate(split):
        best, labels = 0.0, set()
        for label, wording, phrase in licenses.TEMPLATES:
            words, p = wording.split(), phrase.split()
            lead = next(i for i in range(len(words)) if words[i:i + len(p)] == p)
            weight = [licenses.idf(n_docs, frequency.get(x, 0)) + 0.01 for x in words]
            for begin in range(-len(words), len(w)):
                at = lambda i: w[i] if 0 <= i < len(w) else None
                if all(at(begin + lead + i) == x for i, x in enumerate(p)):
                    share = sum(y for i, (x, y) in enumerate(zip(words, weight)) if at(begin + i) == x) / sum(weight)
                    if share >= licenses.LEAST - 1e-9:
                        labels.add(label)
                        best = max(best, share)
        n_found += len(labels)
        assert labels == set(got[d].labels.split(",")) - {""} - set(licenses.PHRASES), d
        assert abs(got[d].score - max(best, 0.5 if got[d].n_base else 0)) < 1e-9
    assert n_found > 2 * len(licenses.TEMPLATES)


def test_secrets_equal_brute_force(spark):
    hexes = hashlib.sha1(b"x").hexdigest()
    texts = [f'token = "{hexes}"', f"commit {hexes}", f"API_KEY: {hexes[:20]}", f"key={hexes[:19]}", "secret " + "a1" * 15, "token " + "abcdefghij" * 3,
             f"bearer {hexes}=== ", f"my password is {hexes}== and token {hexes[::-1]}", "token " + hexes + "é", "token " * 9 + "x" * 50000 + "1",
             f"token {'.' * 50}{hexes}", f"monkey {hexes}", f"aws_secret_key={hexes}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        t, want = texts[r.doc_id], []
        for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", t):
            x = m.group(0)
            bits = -sum(x.count(c) / len(x) * math.log2(x.count(c) / len(x)) for c in set(x))
            near = re.search(r"\b(\w+[_-])?(token|secret|key|apikey|password|passwd|credential|bearer)s?\b", t[max(m.start() - 40, 0):m.start()].lower())
            if re.search("[0-9]", x) and re.search("[A-Za-z]", x) and bits >= 3 and near:
                want.append(f"secret:{m.start()}:{m.end()}")
        assert [s for s in r.spans.split(",") if s.startswith("secret")] == want, t
        assert [x for x, s in zip(r.scores.split(","), r.spans.split(",")) if s.startswith("secret")] == ["0.5"] * len(want)
        assert len(want) == {0: 1, 2: 1, 7: 2, 8: 1, 12: 1}.get(r.doc_id, 0), t


def test_secrets_of_the_test_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = docs.where(docs.text.rlike('token = "[0-9a-f]{40}"'))
    found = pii.personal_data(docs).where("spans like '%secret:%'")
    assert planted.count() > 0 and {r.doc_id for r in planted.select("doc_id").collect()} <= {r.doc_id for r in found.select("doc_id").collect()}
