"""Importance resampling against single features, one CRC at a time."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dossier.llm import target_sampling
from dossier.llm.terms import slices


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features_of(text))
    for _, text in target:
        t.update(features_of(text))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        held = features_of(text)
        weight = sum(gain[b] for b in held)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words_of(text)), len(held), weight, score))
    able = sorted((-r[4], r[0]) for r in rows if r[1] >= 20 and r[4] is not None)
    rank = {i: n for n, (_, i) in enumerate(able[: 5 * len(able) // 100], 1)}
    return {(i, f, w, s, rank.get(i)) for i, _, f, w, s in rows}


def texts_of(rng, number):
    words = [f"w{i}" for i in range(60)] + ["Größe", "中文" * 40, "x" * 200, "The", "the", "o'clock", "a-b", "é"]
    return [rng.choice(["", "."]).join(rng.choice(words) + rng.choice([" ", "  ", "\n"]) for _ in range(rng.choice([0, 1, 2, 19, 20, 21, 90]))) for _ in range(number)]


@pytest.mark.parametrize("head", [0, 5, 40, None])
def test_against_single_features(spark, monkeypatch, head):
    rng = random.Random(head or 7)
    if head is not None:
        monkeypatch.setattr(target_sampling, "HEAD_WORDS", head)
        monkeypatch.setattr(target_sampling, "PAIR_WORDS", max(1, head // 2))
        monkeypatch.setattr(target_sampling, "HEAD_PAIRS", 2 * head)
    docs = [(5 * i - 300, t) for i, t in enumerate(texts_of(rng, 500))] + [(9000, None), (9001, ""), (None, "w1 " * 50), (9002, "The the " * 20000)]
    target = [(i, t) for i, t in enumerate(texts_of(rng, 20))] + [(99, None)]
    got = target_sampling.resample(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, rank int"),
        spark.createDataFrame(target, "item_id long, text string")).collect()
    assert len(got) == len(docs)
    assert {(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == brute(docs, target)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert target_sampling.resample(docs, items).collect() == []
    some = [(1, "a b c " * 30), (1, "a b c " * 30), (2, "x " * 25)]
    got = target_sampling.resample(spark.createDataFrame(some, "doc_id long, text string"), items.limit(0)).collect()
    assert {(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == brute(some, []) and len(got) == 3


def test_ranks_of_many(spark):
    """Exactly the share that is asked for, in order, with ties to smaller ids."""
    rng = random.Random(3)
    rows = [(i, rng.choice([19, 20, 50]), 3, 7, rng.randrange(40)) for i in range(3000)]
    got = target_sampling.drawn(spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")).collect()
    able = sorted((-r[4], r[0]) for r in rows if r[1] >= 20)
    want = {i: n for n, (_, i) in enumerate(able[: 5 * len(able) // 100], 1)}
    assert len(got) == 3000 and {r["doc_id"]: r["rank"] for r in got if r["rank"]} == want


def test_states_follow_from_parts():
    text = "alpha beta " + "z" * 300 + " é 中"
    words = words_of(text)
    for head in ([], [b"beta", b"alpha"]):
        pairs = np.array([2], np.int64) if head else np.empty(0, np.int64)  # alpha beta
        tables = target_sampling.build_head(head, len(head), pairs)
        part = next(slices(pa.array([text])))
        got, _ = target_sampling.features(part, tables)
        assert sorted(got.tolist()) == sorted(features_of(text)) and len(got) == 3 * len(words) - 3
