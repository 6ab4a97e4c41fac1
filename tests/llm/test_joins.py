"""Similarity joins, decontamination and components against brute force."""

import os
import random
import re

import numpy as np
import pytest

from dossier.llm import common, decontamination, jaccard_join, subspace_join
from dossier.llm.common import components, shingles, written

WORDS = [f"w{i}" for i in range(400)]


def sets_of(text, width):
    small = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", small)
    k = min(width, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def roots(ids, linked):
    """Smallest id reachable from each id, by repeated sweeps."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def near_copies(rng, number):
    """Texts with exact copies, near copies around the border, and shared passages."""
    passage = [rng.choice(WORDS) for _ in range(30)]
    out = []
    for _ in range(number):
        kind = rng.random()
        if out and kind < 0.15:
            out.append(rng.choice(out))
        elif out and kind < 0.6:
            words = rng.choice(out).split(" ")
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            out.append(" ".join(words))
        elif kind < 0.8:
            out.append(" ".join(passage + [rng.choice(WORDS) for _ in range(rng.randrange(0, 40))]))
        else:
            out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 150))))
    return out


@pytest.mark.parametrize("width, least, classes", [(3, 90, jaccard_join.CLASSES), (5, 80, ((2, 1), (6, 2), (None, 3)))])
def test_jaccard_against_brute_force(spark, monkeypatch, width, least, classes):
    rng = random.Random(width)
    texts = [*near_copies(rng, 160), None, "", " \n", "One", "one", "a b", "A B", "x " * 3000 + "y", "x " * 3000 + "y z"]
    monkeypatch.setattr(jaccard_join, "CHUNK_DOCS", 7)
    monkeypatch.setattr(jaccard_join.signatures, "__defaults__", (classes,))
    rows = [(3 * i, t, "other") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, tokens string")
    got = jaccard_join.similar(df, width=width, least=least, of=100).collect()
    assert len(got) == len(rows) + 3
    sets = {i: sets_of(t, width) for i, t, _ in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
              and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])]
    want = roots(sets, linked)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in sets.items()}
    assert len(set(want.values())) < len(want) - 40


def test_jaccard_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.similar(df).collect() == []
    df = spark.createDataFrame([(None, "a b c"), (1, None)], "doc_id long, text string")
    assert [tuple(r)[:3] for r in jaccard_join.similar(df).collect()] == [(1, 0, 1)]


def test_linked_sets_share_an_entry():
    """The index never misses a link, whatever the classes and subdivisions."""
    rng = random.Random(1)
    for trial in range(300):
        n = rng.choice([9, 10, 11, 30, 127, 128, 140, 300])
        common = rng.sample(range(10**6), n)
        extra = rng.randrange(0, max(1, n // 9))
        a, b = common[: n - extra // 2], common[extra - extra // 2:] + rng.sample(range(10**6, 2 * 10**6), extra // 3)
        sa, sb = set(a), set(b)
        if 100 * len(sa & sb) < 90 * len(sa | sb):
            continue
        counts = {t: rng.choice([2, 3, 70, 500]) for t in sa | sb}
        entries = [jaccard_join.signatures([(counts[t], t) for t in s], 0, len(s), 90, 100) for s in (sa, sb)]
        assert entries[0] & entries[1], trial


def test_shingle_hashes_keep_texts_apart():
    seen = {}
    for text in ["a b c", "A B C", "a\tb\n c ", "ab c d", "a bc d", "a b", "é b c", "É b c", ""]:
        seen.setdefault(tuple(shingles(np.frombuffer(text.encode(), np.uint8), 3).tolist()), []).append(text)
    assert sorted(map(len, seen.values())) == [1, 1, 1, 1, 1, 1, 3]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(500, 560)] + [(None, 1), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = roots({x for e in real for x in e}, real)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_subspace_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(subspace_join, "LEFT_CHUNK", 40)
    monkeypatch.setattr(subspace_join, "RIGHT_CHUNK", 50)
    base = rng.standard_normal((120, 16))
    near = base[rng.integers(0, 120, 150)] + 0.11 * rng.standard_normal((150, 16))
    hot = base[0] + 0.05 * rng.standard_normal((100, 16))
    x = np.concatenate([base, near, hot, base[:20], 2 * base[20:25]]).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    odd = [(1000, None, "x"), (1001, [0.0] * 16, "x"), (1002, [float("nan")] * 16, "x"), (1003, [None] + [1.0] * 15, "x"),
           (1004, [float("inf")] + [1.0] * 15, "x"), (1005, [], "x"), (1006, [1.0, 2.0], "x"), (1007, [1.0, 2.1], "x"), (None, [1.0] * 16, "x")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, unit string")
    got = {r["vec_id"]: r for r in subspace_join.similar(df, 0.9).collect()}
    assert len(got) == len(rows) + len(odd)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    linked = [(int(a), int(b)) for a, b in zip(*np.nonzero(cosine >= 0.9)) if a < b] + [(1006, 1007)]
    want = roots([*range(len(x)), 1006, 1007], linked)
    assert {i: got[i]["component_id"] for i in want} == want
    degree = {i: 0 for i in want}
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
    assert {i: got[i]["n_links"] for i in want} == degree
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _, _ in odd if i not in (1006, 1007))
    assert all(got[i]["kept"] == (want[i] == i) for i in want)
    assert subspace_join.similar(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def linked_groups(rng, size):
    """Vectors without any structure, near copies around the border, and one dense group."""
    base = rng.standard_normal((700, size))
    near = base[rng.integers(0, 700, 200)] + 0.45 * rng.standard_normal((200, size))
    dense = base[0] + 0.1 * rng.standard_normal((400, size))
    return np.concatenate([base, near, dense])[rng.permutation(1300)].astype(np.float32)


@pytest.mark.parametrize("size, kind", [(64, np.float32), (6, np.float64), (3, np.float32)])
def test_stars_of_chunks_against_brute_force(monkeypatch, size, kind):
    """Each link is counted once, in one block and one pair of chunks, also where a cell is cut and where most pairs are linked."""
    monkeypatch.setattr(subspace_join, "PAIRS", 300)
    rng = np.random.default_rng(size)
    x = linked_groups(rng, size).astype(kind)
    weights = rng.integers(1, 4, len(x))
    unit = subspace_join.units_of(x)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    turn = subspace_join.rotation(size)
    every_pivot = subspace_join.fit_pivots(unit[:300] @ turn, 25)
    links, edges = np.zeros(len(x), np.int64), []
    for block, pivots in enumerate(every_pivot):
        budget = subspace_join.Budget(block, 0.9, turn)
        low, high = budget.share
        home = subspace_join.nearest((unit @ turn)[:, low:high].astype(np.float32), pivots)
        first, own = subspace_join.layout(np.bincount(home, minlength=len(pivots)), 90)
        place = first[home] + np.arange(len(x)) % own[home]
        assert np.bincount(place).max() <= 100 and len(np.unique(place)) > 13
        chunks = []
        for k in np.unique(place):
            rows = np.flatnonzero(place == k)
            rows = rows[np.argsort(home[rows], kind="stable")]
            chunks.append(subspace_join.Chunk(rows, weights[rows], home[rows], x[rows], budget))
        for i, left in enumerate(chunks):
            for right in chunks[i:]:
                ids, n, root = subspace_join.stars(left, right, pivots, budget)
                assert len(np.unique(ids)) == len(ids) and (root <= ids).all()
                links[ids] += n
                edges += list(zip(ids.tolist(), root.tolist()))
    assert links.tolist() == (linked @ weights).tolist()
    want = roots(range(len(x)), list(zip(*(v.tolist() for v in np.nonzero(linked)))))
    assert roots(range(len(x)), edges) == want


def test_vectors_meet_without_being_written_again(spark, monkeypatch):
    """What lies on the disks at once does not grow with the number of chunks that a vector meets."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 64)).astype(np.float32)
    x[700:800] = x[:100] + 0.1 * rng.standard_normal((100, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(subspace_join, "LEFT_CHUNK", 50)
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    seen = []

    def on_disk():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        shuffled = sum(files.apply(k).length() for k in range(files.length()) if files.apply(k).getName().startswith("shuffle"))
        return shuffled + sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(shared) for f in names)

    def watched(df, name):
        out = written(df, name)
        seen.append(on_disk())
        return out

    monkeypatch.setattr(subspace_join, "written", watched)
    before = on_disk()
    got = {r["vec_id"]: r["n_links"] for r in subspace_join.similar(df, 0.9).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, 0)
    assert got == dict(enumerate((cosine >= 0.9).sum(1).tolist()))
    assert max(seen) - before < 4 * x.nbytes


BENCH = [
    (1, "Anna bought 12 apples and 30 pears for 5 dollars on the market near the old river, how many fruits does Anna have?"),
    (2, "short question with five words"),
    (3, "tiny one"),
    (4, None),
    (5, "short question with five words"),
]


@pytest.mark.parametrize("few", [1 << 18, 0])
def test_decontamination(spark, monkeypatch, few):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", few)
    texts = [
        (1, "Before. " + BENCH[0][1] + " After that."),
        (2, "so Maria bought 99 apples and 7 pears for 31 dollars on the market near the old river, how many fruits does Maria have?"),
        (3, "so Maria bought 99 apples and 7 pears, but nothing of the market here."),
        (4, "they say short question with five words here"),
        (5, "a tiny one is not enough"),
        (6, None), (7, ""), (8, BENCH[0][1].upper()),
        (None, BENCH[1][1]),
        (10, "word " * 5000 + BENCH[0][1]),
        (10, "word " * 5000 + BENCH[0][1]),
        (11, "apples and pears for dollars on the market near an old river"),
    ]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, words int")
    items = spark.createDataFrame([(i, t, 0) for i, t in BENCH], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["same_values"] for r in decontamination.matches(docs, items).collect()}
    assert got == {(1, 1): True, (2, 1): False, (4, 2): True, (8, 1): True, (None, 2): True, (10, 1): True}
    kept = [r["doc_id"] for r in decontamination.clean(docs, items).collect()]
    assert sorted(kept, key=str) == sorted([3, 5, 6, 7, 11, None], key=str)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.matches(docs, none).collect() == []
    assert decontamination.matches(spark.createDataFrame([], "doc_id long, text string"), items).collect() == []
    plan = decontamination.matches(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_inconsistent_slots_are_no_match(spark):
    items = spark.createDataFrame([(1, "add 3 and 3 to get 6 then take away 6 and stop")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "add 4 and 4 to get 8 then take away 8 and stop"), (2, "add 4 and 5 to get 9 then take away 7 and stop"),
         (3, "add 4 and 4 to get 4 then take away 4 and stop")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.matches(docs, items).collect()] == [1]


def test_items_without_a_template_window_are_matched_exactly(spark):
    items = [(1, "12 34 56 78 90"), (2, "Anna Berta Carla Dora Emma Frida Greta Hanna Ida Jana"), (3, "日本の首都はどこですか"),
             (4, "who wrote Hamlet"), (5, "Der Hund und die Katze jagen Mäuse, Ratten, Vögel, Hasen, Füchse, Dachse und Rehe im Wald"), (6, "Say cheese")]
    docs = [(1, "sum of 12 34 56 78 90 please"), (2, "sum of 12 34 56 78 91 please"), (3, "so Anna Berta Carla Dora Emma Frida Greta Hanna Ida Jana"),
            (4, "質問:日本の首都はどこですか?答え"), (5, "日本の首都は東京です"), (6, "they ask who wrote Hamlet here"), (7, "who wrote Faust"),
            (8, "dort jagen Mäuse, Ratten, Vögel, Hasen, Füchse, Dachse und Rehe im Wald"), (9, "first\nSay cheese!\nlast"), (10, "they say cheese is good"),
            (11, "so Adam Bernd Carl Dirk Emil Fritz Georg Hans Ingo Jan")]
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["same_values"] for r in got.collect()} == {
        (1, 1): True, (3, 2): True, (4, 3): True, (6, 4): True, (8, 5): True, (9, 6): True}


def test_coinciding_values_and_single_exceptions_match(spark):
    items = [(1, "add 3 and 5 to get 8"), (2, "3 apples and 3 pears"),
             (3, "boxes of 3 hold 7 red balls and 3 blue balls while 7 others hold 9 green balls and 9 more")]
    docs = [(1, "add 4 and 4 to get 8"), (2, "4 apples and 5 pears"),
            (3, "boxes of 4 hold 6 red balls and 4 blue balls while 6 others hold 8 green balls and 5 more"),
            (4, "boxes of 4 hold 6 red balls and 5 blue balls while 2 others hold 8 green balls and 1 more"),
            (5, "boxes of 4 hold 4 red balls and 4 blue balls while 4 others hold 4 green balls and 4 more")]
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["same_values"] for r in got.collect()} == {(1, 1): False, (2, 2): False, (3, 3): False}


def test_layout_case_and_first_names_hide_nothing(spark):
    items = [(1, "Tom has 3 red apples"), (2, "every Friday Anna walks from Bonn to Linz with Carla")]
    docs = [(1, "so. Anna has 5 red apples"), (2, "TOM HAS 3 RED APPLES"), (3, "so\tTom\nhas  3\u00a0red apples"),
            (4, "every Friday\nMaria walks\tfrom  Rome to\nGraz with\nPaula"), (5, "every friday anna walks from bonn to linz with carla"),
            (6, "we know Anna has 7 red apples"), (7, "Tom has red apples")]
    got = decontamination.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["same_values"] for r in got.collect()} == {
        (1, 1): False, (2, 1): True, (3, 1): True, (4, 2): False, (5, 2): True, (6, 1): False}


def test_window_sums(spark):
    from pyspark.sql import functions as F
    rows = [(list(range(n)),) for n in range(0, 24)]
    df = spark.createDataFrame([([v * v + 3 for v in r[0]],) for r in rows], "h array<bigint>")
    widths = (1, 2, 3, 5, 7, 8, 16)
    for r in df.select("h", *[decontamination.window_sums(F.col("h"), w).alias(f"w{w}") for w in widths]).collect():
        for w in widths:
            assert r[f"w{w}"] == [sum(r["h"][i:i + w]) for i in range(len(r["h"]) - w + 1)], (w, len(r["h"]))


def test_shuffled_words_are_no_match(spark):
    """Windows of equal words in another order have equal sums and are told apart by the words."""
    items = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "eight seven six five four three two one"), (2, "so one two three four five six seven eight")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.matches(docs, items).collect()] == [2]


def test_components_of_stars_take_no_round(spark, monkeypatch):
    names = []

    def counted(df, name):
        names.append(name)
        return written(df, name)

    monkeypatch.setattr(common, "written", counted)
    edges = spark.createDataFrame([(1, 5), (6, 1), (2, 7), (2, 2), (None, 3)], "a long, b long")
    assert sorted(map(tuple, common.components(edges).collect())) == [(1, 1), (2, 2), (5, 1), (6, 1), (7, 2)]
    assert names == ["edges"]
    path = spark.createDataFrame([(i, i + 1) for i in range(1, 40)], "a long, b long")
    assert {tuple(r) for r in common.components(path).collect()} == {(i, 1) for i in range(1, 41)}


def test_perhaps_in_misses_no_key(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("id", "cast(id as int) as text").unionByName(spark.createDataFrame([(None, 1)], "id long, text int"))
    keys = common.written(df.filter("id % 7 = 0").selectExpr("cast(id as int) as id"), "keys")
    for most in (27, 15):
        monkeypatch.setattr(common, "BITS_MOST", most)
        got = common.perhaps_in(df, "id", keys, "may")
        assert got.columns == ["id", "text", "may"] and got.count() == 20_001
        assert got.filter("id % 7 = 0 and not may").count() == 0
        assert 0 <= got.filter("may and id % 7 <> 0").count() < {27: 500, 15: 4_000}[most]
    none = common.perhaps_in(df, "id", keys.limit(0), "may")
    assert none.count() == 20_001 and none.filter("may").isEmpty()


def test_few_texts_are_shuffled_for_near_duplicates(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from dossier.llm import jaccard_join

    sent = []

    def counted(df, key, keys, out):
        found = common.perhaps_in(df, key, keys, out)
        sent.append(found.filter(out).count())
        return found

    monkeypatch.setattr(corpus_pipeline, "perhaps_in", counted)
    monkeypatch.setattr(jaccard_join, "perhaps_in", counted)
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(200)]
    copies = [(1000 + i, texts[i][1]) for i in range(5)] + [(7, texts[7][1]), (8, "other words"), (None, "none"), (2000, None)]
    docs = spark.createDataFrame(texts + copies, "doc_id long, text string")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert got == sorted(texts + [(8, "other words"), (-1, "none"), (2000, "")])
    assert len(sent) == 2 and sum(sent) < 60  # of 209 rows each
