import math
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from dossier.operators import collections, evaluation, grouping, logs, ocr, ranking, sampling, skew, tagging


def ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def correlation(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    xy = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    xx, yy = sum((x - ma) ** 2 for x in a), sum((y - mb) ** 2 for y in b)
    return xy / math.sqrt(xx * yy) if xx and yy else None


# --- shared building blocks -------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 4, 50])
def test_attach_is_a_join(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        draw = random.Random(parts)
        keys = ["hot" if draw.random() < 0.4 else f"k{draw.randrange(9)}" for _ in range(200)] + [None, None]
        facts = spark.createDataFrame(list(enumerate(keys)), "id int, k string")
        dim = spark.createDataFrame([("hot", 80, None)] + [(f"k{i}", 10, i) for i in range(5)], "k string, n int, v int")
        got = skew.attach(facts, dim, ["k"])
        assert got.columns == ["id", "k", "n", "v"]
        known = {"hot": None, **{f"k{i}": i for i in range(5)}}
        want = sorted((i, k, known[k]) for i, k in enumerate(keys) if k in known)
        assert sorted((r.id, r.k, r.v) for r in got.collect()) == want
        left = {r.id: (r.n, r.v) for r in skew.attach(facts, dim, ["k"], "left").collect()}
        sizes = {"hot": 80, **{f"k{i}": 10 for i in range(5)}}
        assert left == {i: (sizes.get(k), known.get(k)) for i, k in enumerate(keys)}
        with pytest.raises(ValueError):
            skew.attach(facts, dim, ["k"], "outer")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_attach_spreads_equal_rows(spark):
    """Without adaptive execution, equal rows of a hot key stay in the partitions they came from."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(0, 40_000, 1, 8).select(F.lit("same").alias("k"), F.lit(1).alias("x"))
        dim = spark.createDataFrame([("same", 1), ("other", 2)], "k string, v int")
        sizes = skew.attach(facts, dim, ["k"]).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 40_000 and max(r["count"] for r in sizes) <= 5_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_with_index(spark):
    keys = random.Random(1).sample(range(10**9), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)
    got = {r.k: r.id for r in skew.with_index(df, "k", parts=7).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("block", [3, 100])
def test_position_and_neighbours(spark, block):
    draw = random.Random(2)
    rows = [("a" if draw.random() < 0.7 else "b", p, draw.choice("xyz")) for p in draw.sample(range(60), 40)]
    df = spark.createDataFrame(rows, "g string, p int, v string")
    placed = {(r.g, r.p): r.at for r in skew.position_in_group(df, ["g"], "p", "at", block).collect()}
    near = {(r.g, r.p): r for r in skew.neighbours(df, ["g"], "p", ["v"], block).collect()}
    for g in "ab":
        own = sorted((p, v) for q, p, v in rows if q == g)
        for i, (p, _) in enumerate(own):
            assert placed[g, p] == i
            before, after = near[g, p].previous, near[g, p].next
            assert (before.v if before else None) == (own[i - 1][1] if i else None)
            assert (after.v if after else None) == (own[i + 1][1] if i + 1 < len(own) else None)


def test_bucketed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    got = [int(r.b) for r in skew.bucketed(df, "x", [2.0, 5.0, 5.5], "b").collect()]
    assert got == [0, 0, 1, 1, 1, 2, 3, 3, 3, 3]
    assert skew.bucketed(df, "x", [], "b").count() == 10


# --- ranking ----------------------------------------------------------------------

SCORES = [("a", 1, 3.0), ("a", 2, 5.0), ("a", 3, 5.0), ("a", 4, 1.0), ("b", 5, 2.0), ("c", 6, 7.0), ("c", 7, 7.0)]


def test_minmax_and_top_k(spark):
    df = spark.createDataFrame(SCORES, "job string, id int, score double")
    scaled = {r.id: r.normalized_score for r in ranking.minmax_by_group(df, "job", "score").collect()}
    assert scaled == {1: 0.5, 2: 1.0, 3: 1.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 0.0}
    best = {(r.job, r["rank"]): r.id for r in ranking.top_k_by_group(df, "job", "score", "id", 2).collect()}
    assert best == {("a", 1): 2, ("a", 2): 3, ("b", 1): 5, ("c", 1): 6, ("c", 2): 7}
    both = {r.id: r.normalized_score for r in ranking.top_k_scaled(df, "job", "score", "id", 2).collect()}
    assert both == {2: 1.0, 3: 1.0, 5: 0.0, 6: 0.0, 7: 0.0}


@pytest.mark.parametrize("parts", [2, 9])
def test_avg_rank(spark, parts):
    draw = random.Random(parts)
    rows = [(draw.choice("ab"), draw.choice([0.1, 0.5, 0.5, draw.random()])) for _ in range(150)]
    df = spark.createDataFrame(rows + [("a", None)], "g string, v double")
    got = {(r.g, r.v): (r.n, r["rank"]) for r in ranking.avg_rank(df, "v", ["g"], parts=parts).collect()}
    for g in "ab":
        own = [v for q, v in rows if q == g]
        for v, r in zip(own, ranks(own)):
            assert got[g, v] == (own.count(v), r)
    total = sum(r.n * r["rank"] for r in ranking.avg_rank(df, "v", parts=parts).collect())
    assert total == 150 * 151 / 2


# --- metrics ----------------------------------------------------------------------

def test_evaluate_pairs(spark):
    draw = random.Random(4)
    rows = [(draw.choice("ab"), round(draw.random(), 1), round(draw.random(), 1)) for _ in range(120)]
    df = spark.createDataFrame(rows + [("a", None, 0.5), ("b", 0.5, None)], "g string, p double, t double")
    assert evaluation.pair_counts(df, "p", "t").head() == (122, 120, 2)
    assert evaluation.valid_pairs(df, "p", "t").count() == 120
    assert evaluation.failed_pairs(df, "p", "t").count() == 2

    def check(row, own):
        p, t = [x for _, x, _ in own], [y for _, _, y in own]
        assert row.n == len(own)
        assert row.mse == pytest.approx(sum((x - y) ** 2 for x, y in zip(p, t)) / len(p))
        assert row.mae == pytest.approx(sum(abs(x - y) for x, y in zip(p, t)) / len(p))
        assert row.pearson == pytest.approx(correlation(p, t))
        assert row.spearman == pytest.approx(correlation(ranks(p), ranks(t)))

    check(evaluation.evaluate_pairs(df, "p", "t").head(), rows)
    for row in evaluation.evaluate_pairs(df, "p", "t", ["g"]).collect():
        check(row, [r for r in rows if r[0] == row.g])
    by_group = {r.g: r.spearman for r in evaluation.spearman(df, "p", "t", ["g"]).collect()}
    assert set(by_group) == {"a", "b"}


def test_undefined_correlation(spark):
    constant = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0)], "p double, t double")
    row = evaluation.evaluate_pairs(constant, "p", "t").head()
    assert row.n == 3 and row.pearson is None and row.spearman is None
    single = evaluation.evaluate_pairs(constant.limit(1), "p", "t").head()
    assert single.n == 1 and single.pearson is None and single.spearman is None
    none = evaluation.evaluate_pairs(constant.filter("p > 9"), "p", "t").head()
    assert none.n == 0 and none.mse is None
    from dossier.functions.metrics import pearson
    assert constant.agg(pearson(F.col("p"), F.col("t")).alias("r")).head().r is None


def test_cosine_loss_and_mean_pool(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.5, 0.0)], "cos double, label double")
    row = evaluation.cosine_loss(df, "cos", "label").head()
    assert row.mse == 0.125 and row.cosine_loss == 0.25 and row.loss == 0.375
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [0.0, 5.0])], "id int, v array<float>")
    assert {r.id: r.pooled for r in evaluation.mean_pool(vectors, "id", "v").collect()} == {1: [2.0, 4.0], 2: [0.0, 5.0]}


# --- entities ---------------------------------------------------------------------

def chunks_by_rule(labels, mode):
    """Entities of one sequence, token by token."""
    found, before = [], None
    for i, label in enumerate(labels):
        if mode == "compat" and label[0] == "O":
            before = label
            continue
        alone = mode == "compat" and label[0] in "BSE"
        if found and before == label and not alone:
            found[-1] = (label, found[-1][1], i)
        else:
            found.append((label, i, i))
        before = label
    return set(found)


@pytest.mark.parametrize("mode", ["compat", "runs"])
@pytest.mark.parametrize("block", [1, 4, 1000])
def test_label_chunks(spark, mode, block):
    draw = random.Random(block)
    names = ["PHONE", "SKILL", "EMAIL", "OTHER", "gender"]
    sequences = {s: [n for n, k in ((draw.choice(names), draw.randint(1, 6)) for _ in range(8)) for _ in range(k)] for s in "xyz"}
    predicted = {s: [draw.choice(names) if draw.random() < 0.2 else n for n in v] for s, v in sequences.items()}
    rows = [(s, i, n, predicted[s][i]) for s, v in sequences.items() for i, n in enumerate(v)]
    df = spark.createDataFrame(rows, "seq string, pos int, gold string, pred string").repartition(3)
    want = {side: {(s, *c) for s in "xyz" for c in chunks_by_rule(src[s], mode)} for side, src in (("gold", sequences), ("pred", predicted))}
    got = {side: {(r.seq, r.type, r.start, r.end) for r in tagging.label_chunks(df, "seq", "pos", side, mode, block).collect()} for side in want}
    assert got == want

    both = len(want["gold"] & want["pred"])
    row = tagging.evaluate_tags(df, "seq", "pos", "gold", "pred", mode, block).head()
    assert (row.n_gold, row.n_pred, row.n_match) == (len(want["gold"]), len(want["pred"]), both)
    p, r = both / row.n_pred, both / row.n_gold
    assert row.precision == pytest.approx(p) and row.recall == pytest.approx(r) and row.f1 == pytest.approx(2 * p * r / (p + r))
    assert row.accuracy == pytest.approx(sum(g == q for _, _, g, q in rows) / len(rows))
    sides = [tagging.label_chunks(df, "seq", "pos", s, mode, block) for s in ("gold", "pred")]
    assert tagging.match_chunks(*sides, "seq").count() == both


def test_no_predicted_entity(spark):
    df = spark.createDataFrame([("s", 0, "PHONE", "OTHER"), ("s", 1, "PHONE", "OTHERS")], "seq string, pos int, gold string, pred string")
    row = tagging.entity_prf(df, "seq", "pos", "gold", "pred").head()
    assert (row.n_gold, row.n_pred, row.precision, row.recall, row.f1) == (1, 0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        tagging.entity_prf(df, "seq", "pos", "gold", "pred", "strict")


# --- sequences --------------------------------------------------------------------

def test_group_and_encode(spark):
    draw = random.Random(6)
    rows = [("hot" if draw.random() < 0.6 else f"p{draw.randrange(3)}", p, draw.choice("abc")) for p in draw.sample(range(10**6), 90)]
    df = spark.createDataFrame(rows, "page string, pos int, t string")
    grouped = grouping.group_tokens(df, "page", "pos", ["t"], 8).collect()
    for page, own in groupby(sorted(rows), key=lambda r: r[0]):
        tokens = [t for _, _, t in own]
        parts = sorted((r.chunk, r.n_tokens, r.t) for r in grouped if r.page == page)
        assert [x for _, _, part in parts for x in part] == tokens
        assert all(n == len(part) <= 8 for _, n, part in parts)
    encoded = {r.page: r for r in grouping.encode_pages(df, "page", "pos", {"t": F.lit("-")}, 8).collect()}
    for page, own in groupby(sorted(rows), key=lambda r: r[0]):
        tokens = [t for _, _, t in own]
        assert encoded[page].t == (tokens + ["-"] * 8)[:8]
        assert encoded[page].attention_mask == ([1] * len(tokens) + [0] * 8)[:8]


def test_join_page_dims(spark):
    tokens = spark.createDataFrame([("a", 1), ("b", 2)], "page_key string, t int")
    dims = spark.createDataFrame([("a", 10, 20)], "page_key string, w int, h int")
    assert grouping.join_page_dims(tokens, dims).collect() == [("a", 1, 10, 20)]


# --- samples ----------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 9, 10, 11, 25, 400])
def test_splits(spark, n):
    df = spark.range(n).select(F.col("id").alias("key"))
    train, val = sampling.split_exact(df, "key")
    t, v = {r.key for r in train.collect()}, {r.key for r in val.collect()}
    assert len(v) == math.ceil(n * 0.1) and not t & v and t | v == set(range(n))
    assert {r.key for r in sampling.split_flag(df.repartition(5), "key").filter("is_validation").collect()} == v
    assert sampling.holdout_sample(df, "key").count() == round(n * 0.1)


def test_one_bucket_split(spark, monkeypatch):
    """Also right when the cut falls into a bucket with many rows."""
    full = sampling._hashed
    monkeypatch.setattr(sampling, "_hashed", lambda df, key, *salt: full(df, key, *salt).withColumn("_bucket", F.col("_bucket") % 2))
    train, val = sampling.split_exact(spark.range(60).select(F.col("id").alias("key")), "key", 0.3)
    assert train.count() == 42 and val.count() == 18


def test_samples(spark):
    df = spark.range(200).select(F.col("id").alias("key"))
    positions = {r.key: r.position for r in sampling.shuffle_rows(df, "key", epoch=1).collect()}
    other = {r.key: r.position for r in sampling.shuffle_rows(df, "key", epoch=2).collect()}
    assert sorted(positions.values()) == list(range(200)) == sorted(other.values()) and positions != other
    assert [r.key for r in sampling.eval_limit(df.orderBy(F.rand(1)), "key", 3).collect()] == [0, 1, 2]
    sample = {r.key for r in sampling.sample_n(df, "key", 30).collect()}
    assert len(sample) == 30 and sample == {r.key for r in sampling.sample_n(df.repartition(7), "key", 30).collect()}
    assert sampling.sample_n(df, "key", 500).count() == 200


# --- recognised text --------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def noisy(draw, text, rate):
    out = []
    for ch in text:
        kind = draw.random()
        if kind < rate / 3:
            continue
        out.append(draw.choice("abé中 ") if kind < rate else ch)
        if kind > 1 - rate / 3:
            out.append("x")
    return "".join(out)


def test_edit_distance_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    pairs = [("", ""), ("", "abc"), ("abc", ""), ("é", "e"), ("中文", "中国"), ("a" * 300, "a" * 300), ("a" * 300, "b" * 280)]
    for n, rate in [(5, 0.5), (60, 0.3), (64, 0.1), (65, 0.9), (130, 0.2), (200, 0.02), (400, 0.3), (700, 0.5)]:
        text = "".join(draw.choice("abc dé中") for _ in range(n))
        pairs += [(text, noisy(draw, text, rate)), (noisy(draw, text, rate), text)]
    df = spark.createDataFrame(pairs, "a string, b string")
    want = [distance(a, b) for a, b in pairs]
    for limit in (ocr.SHORT_TEXT, 0):
        monkeypatch.setattr(ocr, "SHORT_TEXT", limit)
        assert [r.d for r in df.select(ocr.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()] == want
    assert spark.range(1).select(ocr.edit_distance(F.lit(None).cast("string"), F.lit("a")).alias("d")).head().d is None


def test_error_rates(value):
    assert value(ocr.cer, " abc ", "abd") == pytest.approx(1 / 3)
    assert value(ocr.cer, "abc", "") == 3.0
    assert value(ocr.cer, "", "abc") == 1.0
    assert value(ocr.wer_compat, "a  b\nc", "a b c") == 0.0
    assert value(ocr.wer_compat, "x", "word") == 4.0
    assert value(ocr.wer_compat, "", "") == 0.0


def test_assemble_and_summary(spark):
    files = spark.createDataFrame([("a1.pdf",), ("b02.pdf",), ("nodigits.pdf",), ("c9.pdf",), ("d1.pdf",)], "file string")
    truth = spark.createDataFrame([("1", "one two"), ("02", "x"), ("2", "wrong")], "id string, text string")
    assert {r.file for r in ocr.keep_with_id(files, truth).collect()} == {"a1.pdf", "b02.pdf", "d1.pdf"}
    joined = ocr.join_truth(files, truth)
    assert {(r.file, r.id, r.text) for r in joined.collect()} == {("a1.pdf", "1", "one two"), ("b02.pdf", "02", "x"), ("d1.pdf", "1", "one two")}
    lines = spark.createDataFrame(
        [("a1.pdf", 1, 0, " two ", 0.8), ("a1.pdf", 0, 1, "", 0.6), ("a1.pdf", 0, 0, "\tone", 0.7), ("b02.pdf", 0, 0, "y", 0.5)],
        "file string, page int, line int, text string, conf double",
    )
    texts = ocr.assemble_text(joined, lines)
    got = {r.file: (r.ocr_text, round(r.avg_conf, 6), r.n_lines) for r in texts.collect()}
    assert got == {"a1.pdf": ("one  two", 0.7, 3), "b02.pdf": ("y", 0.5, 1), "d1.pdf": ("", 0.0, 0)}
    errors = ocr.document_errors(texts)
    by_file = {r.file: (r.char_errors, r.word_errors) for r in errors.collect()}
    assert by_file == {"a1.pdf": (1, 0), "b02.pdf": (1, 1), "d1.pdf": (7, 7)}
    row = ocr.ocr_corpus_summary(errors).head()
    assert row.n_docs == 3 and row.cer == pytest.approx(9 / 15) and row.wer == pytest.approx(8 / 5)
    assert row.confidence == pytest.approx(1.2 / 3)
    assert ocr.format_summary(ocr.ocr_corpus_summary(errors)).head().cer == "60.00%"
    empty = ocr.ocr_corpus_summary(errors.filter("file = ''")).head()
    assert (empty.n_docs, empty.cer, empty.confidence) == (0, 0.0, 0.0)


# --- logs and collections ---------------------------------------------------------

def test_logs(spark):
    history = spark.createDataFrame([(0, 0.8), (1, 0.9), (2, 0.9), (3, None)], "epoch int, spearman double")
    assert logs.best_epoch(history, "spearman").head().epoch == 1
    assert logs.best_epoch(history, "spearman", "min").head().epoch == 0
    assert logs.best_epoch(history.filter("epoch = 3"), "spearman").count() == 0
    assert [r.epoch for r in logs.epoch_base1(history).collect()] == [1, 2, 3, 4]
    steps = spark.createDataFrame([(1, 2.0, None), (1, 4.0, None), (2, None, 1.0), (2, None, None)], "epoch int, loss double, eval_loss double")
    assert logs.log_rows(steps).count() == 3
    assert {r.epoch: r.mean_loss for r in logs.epoch_mean_loss(steps).collect()} == {1: 3.0, 2: None}
    sparse = logs.metric_layout(logs.union_sparse(
        steps.filter("loss is not null").select("epoch", F.col("loss").alias("train_loss")),
        steps.filter("eval_loss is not null").select("epoch", "eval_loss"),
    ))
    assert sparse.columns == list(logs.METRIC_COLUMNS) and sparse.count() == 3
    with pytest.raises(ValueError):
        logs.best_epoch(history, "spearman", "last")


def test_collections(spark):
    one, two = spark.range(3), spark.range(2)
    merged = collections.union_sources({"one": one, "two": two})
    counts = {r.source: r.n_records for r in collections.source_counts(merged).collect()}
    assert counts == {"one": 3, "two": 2, None: 5}
    src = spark.createDataFrame([("a",), ("b",)], "out_path string")
    done = spark.createDataFrame([("b",), ("b",)], "out_path string")
    assert [r.out_path for r in collections.pending_files(src, done).collect()] == ["a"]
    assert collections.drop_fields(spark.createDataFrame([(1, 2)], "id int, true_score int")).columns == ["id"]
