"""Ranked search against scores of all documents."""

import math
import random
import re

import numpy as np
import pytest

from dossier.llm import lexical_search


def terms_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, most=10):
    counted = [(i, terms_of(t)) for i, t in docs]
    counted = [(i, t) for i, t in counted if t]
    number, total = len(counted), sum(len(t) for _, t in counted)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(terms_of(text))
    out = {}
    for key, terms in asked.items():
        weight = {}
        for term in terms:
            df = sum(term in t for _, t in counted)
            weight[term] = math.floor(1000 * math.log((2 * number + 2) / (2 * df + 1)))
        scored = []
        for i, t in counted:
            m = 100 - 90 + 90 * len(t) * number // total
            score = sum(w * (10**9 * t.count(x) // (1000 * t.count(x) + 8 * m)) for x, w in weight.items() if x in t)
            if score > 0:
                scored.append((-score, float("inf") if i is None else i))
        out[key] = [(r, None if i == float("inf") else i, -s) for r, (s, i) in enumerate(sorted(scored)[:most], 1)]
    return {k: v for k, v in out.items() if v}


def collection(rng, number):
    words = ["the", "of", "and"] + [f"w{i}" for i in range(200)] + ["Größe", "中文", "x_y", "A1"]
    pick = lambda: words[min(int(rng.expovariate(0.03)), len(words) - 1)]
    texts = [" ".join(pick() for _ in range(rng.choice([0, 1, 3, 30, 200]))) for _ in range(number)]
    return texts + [texts[5], texts[5], None, "", " ... ", "the " * 30000, "GRÖSSE größe the THE"]


@pytest.mark.parametrize("batch, block", [(10000, 1_000_000), (40, 60)])
def test_against_all_scores(spark, monkeypatch, batch, block):
    rng = random.Random(batch)
    docs = [(3 * i - 70, t) for i, t in enumerate(collection(rng, 400))]
    docs += docs[7:10] + [(None, docs[8][1]), (None, "w1 the of")]
    items = [(i, " ".join(rng.choice(docs)[1].split()[:25]) if i % 3 else "the of w3 w90") for i in range(12) if docs[i][1]]
    items += [(50, None), (51, "nothing-of-this occurshere"), (None, "the w7"), (3, "w11 W11 größe"), (52, "")]
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = lexical_search.ranked(
            spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int"),
            spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    assert got == brute(docs, items)


def test_empty_tables(spark):
    none, some = "doc_id long, text string", "item_id long, text string"
    docs, items = spark.createDataFrame([(1, "a b")], none), spark.createDataFrame([(1, "a")], some)
    assert lexical_search.ranked(spark.createDataFrame([], none), items).collect() == []
    assert lexical_search.ranked(docs, spark.createDataFrame([], some)).collect() == []
    assert lexical_search.ranked(spark.createDataFrame([(1, None)], none), items).collect() == []


def test_long_lists_are_skipped():
    """With ten good documents known, documents that hold only common terms are not scored."""
    rng = np.random.default_rng(1)
    n = 4096
    common = [(np.arange(n), rng.integers(1, 5, n)) for _ in range(3)]
    rare = (np.sort(rng.choice(n, 200, replace=False)), rng.integers(1, 5, 200))
    lists, docs, gains, at = [], [], [], 0
    for (d, g), w in zip([*common, rare], [3, 2, 1, 1000]):
        lists.append((at, at + len(d), w))
        docs.append(d)
        gains.append(g)
        at += len(d)
    best = []
    scored = lexical_search.best_of_batch(lists, np.concatenate(docs), np.concatenate(gains).astype(np.int64), n, best, np.arange(n))
    total = np.zeros(n, np.int64)
    for (d, g), w in zip([*common, rare], [3, 2, 1, 1000]):
        total[d] += w * g
    want = sorted(((int(s), -i) for i, s in enumerate(total)), reverse=True)[:10]
    assert sorted(best, reverse=True) == want and scored < n / 4
