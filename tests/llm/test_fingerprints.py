"""Fingerprints against votes counted one by one, and near fingerprints against all pairs."""

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from dossier.llm import simhash

MASK = 2**64 - 1


def hashed(*parts):
    """The built-in hash: 64-bit xxHash, seeded by the hash of the parts before."""
    seed = 42
    for part in parts:
        raw = part.encode() if isinstance(part, str) else part
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed


def plain_fingerprint(text):
    words = [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    terms = list(zip(words, words[1:])) if len(words) > 1 else [(w,) for w in words]
    votes = [0] * 128
    for term in terms:
        letters = sum(map(len, term))
        weight = 1 if letters <= 6 else 2 if letters <= 12 else 3
        carrier = (hashed(*term) & ~3 & MASK) | weight
        for i in range(2):
            h = hashed(i.to_bytes(4, "little"), carrier.to_bytes(8, "little"))
            for bit in range(64):
                votes[64 * i + bit] += weight if h >> bit & 1 else -weight
    words_ = [sum(1 << b for b in range(64) if votes[64 * i + b] > 0) for i in range(2)]
    return "".join(f"{w:016x}" for w in words_)


def texts_of(rng, number):
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(1, 14))) for _ in range(90)]
    out = []
    for i in range(number):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 41, 42, 43, 44, 130]))]
        out.append(rng.choice([" ", ", ", "\n"]).join(words))
    return out + ["", None, "One", "ONE ", "Ünïcode über ß 中文 text", "\U0001f600 smile \U0001f600\U0001f600 ok", "word " * 20000]


def test_drift_against_single_votes(spark):
    texts = texts_of(random.Random(5), 60)
    rows = [(7 * i - 50, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = {r["doc_id"]: r for r in simhash.drift(df).collect()}
    assert len(got) == len(rows)
    for at, (doc_id, text, _) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == plain_fingerprint(text) and r["edited_fingerprint"] == plain_fingerprint(edited)
        like = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        assert r["near_edited"] == like(plain_fingerprint(text), plain_fingerprint(edited))
        assert r["near_next"] == like(plain_fingerprint(text), plain_fingerprint(after))


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    assert simhash.drift(spark.createDataFrame([], schema)).collect() == []
    one = simhash.drift(spark.createDataFrame([(3, "some words here")], schema)).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(3, 1.0)]
    rows = [(None, "same text"), (None, None), (1, "same text"), (1, "same text"), (2, None), (2, "other")]
    got = simhash.drift(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == [(0, 0), (0, 9), (1, 9), (1, 9), (2, 0), (2, 5)]
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 9}) == 1
    assert all((r["near_next"] is None) == (r["doc_id"] is None) for r in got)
    plan = simhash.drift(spark.createDataFrame(rows, schema))._jdf.queryExecution().toString()
    assert "InArrow" not in plan and "EvalPython" not in plan


def test_near_against_all_pairs(spark):
    rng = random.Random(8)
    marks = [rng.getrandbits(128) for _ in range(80)]
    for _ in range(300):
        value = rng.choice(marks)
        for _ in range(rng.randrange(0, 5)):
            value ^= 1 << rng.randrange(128)
        marks.append(value)
    marks = list(dict.fromkeys([*marks, 0, 1 << 63, 1 << 64, (1 << 128) - 1, (1 << 128) - 2]))
    shown = [f"{m & MASK:016x}{m >> 64:016x}" for m in marks]
    df = spark.createDataFrame([(m,) for m in [*shown, *shown[:9], None]], "fingerprint string")
    for radius, extra in ((3, 2), (1, 1), (0, 2)):
        want = {(min(a, b), max(a, b)): (int(a, 16) ^ int(b, 16)).bit_count() for i, a in enumerate(shown) for b in shown[:i]}
        want = {p: d for p, d in want.items() if d <= radius}
        rows = simhash.near(df, radius, extra).collect()
        assert len(rows) == len(want) and {(r["a"], r["b"]): r["distance"] for r in rows} == want
    some = spark.createDataFrame([(m,) for m in shown[:40]], "fingerprint string")
    found = {(r["a"], r["b"]) for r in simhash.near(df, 3, queries=some).collect()}
    assert found == {(a, b) for a in shown[:40] for b in shown if a != b and (int(a, 16) ^ int(b, 16)).bit_count() <= 3}
    counts = {r["fingerprint"]: r["n_near"] for r in simhash.near_counts(df.filter("fingerprint is not null"), 3).collect()}
    every = [*shown, *shown[:9]]
    brute = {a: sum((int(a, 16) ^ int(b, 16)).bit_count() <= 3 for b in every) - 1 for a in shown}
    assert counts == {a: n for a, n in brute.items() if n}


def test_likeness_tells_edits_from_other_documents(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(3000)}" for _ in range(9000)]
    rows = [(i, " ".join(words[300 * i:300 * i + 300])) for i in range(30)]
    got = simhash.drift(spark.createDataFrame(rows, "doc_id long, text string")).agg(F.min("near_edited"), F.max("near_next")).head()
    assert got[0] > got[1]
