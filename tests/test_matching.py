"""Coarse retrieval, term weights, boosted trees, quarantine readers and batch models."""

import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from dossier.operators import boosting, inference, retrieval, term_weights
from dossier.session import written
from dossier.sources import quarantine


@pytest.mark.parametrize("normalize, sample, chunk, group", [(True, 4096, 4096, 2048), (False, 8, 64, 7)])
def test_top_k_against_all_products(spark, monkeypatch, normalize, sample, chunk, group):
    monkeypatch.setattr(retrieval, "SAMPLE", sample)
    monkeypatch.setattr(retrieval, "PIVOTS", 6)
    monkeypatch.setattr(retrieval, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(retrieval, "GROUP_TARGETS", group)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 12)) * 3
    x = centres[rng.integers(0, 8, 600)] + 0.3 * rng.standard_normal((600, 12))
    x[400:520] = x[3]  # a group of copies
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x.astype(np.float32))]
    odd = [(900, None, "a"), (901, [], "a"), (902, [float("nan")] * 12, "a"), (903, [1.0, None] * 6, "a"), (None, [1.0] * 12, "a"),
           (904, [1.0, 2.0], "a"), (905, [2.0, 4.0], "a"), (906, [0.0] * 12, "a")]
    df = spark.createDataFrame(rows + odd, "id long, vector array<float>, score string")
    targets = df.filter("id % 9 = 0 or id >= 900")
    best, work = retrieval.coarse_top_k(targets, df, 7, normalize=normalize)
    got = {}
    for r in best.orderBy("target", "rank").collect():
        got.setdefault(r["target"], []).append((r["rank"], r["id"], round(r["score"], 6)))
    known = {i: np.array(v, np.float64) for i, v, _ in rows}
    known |= {904: np.array([1.0, 2.0]), 905: np.array([2.0, 4.0])}
    if not normalize:
        known[906] = np.zeros(12)
    unit = {i: v / np.linalg.norm(v) if normalize else v for i, v in known.items()}
    for t in (i for i in unit if i % 9 == 0 or i >= 900):
        scored = sorted((-round(float(unit[t] @ v), 9), i) for i, v in unit.items() if len(v) == len(unit[t]))
        assert got.pop(t) == [(n, i, round(-s, 6)) for n, (s, i) in enumerate(scored[:7], 1)], t
    assert got == {}
    seen, skipped = work.head()
    assert skipped > 0 and (seen + skipped) > 0


def test_top_k_of_empty_tables(spark):
    none = spark.createDataFrame([], "id long, vector array<double>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], none.schema)
    assert retrieval.coarse_top_k(none, some, 3)[0].collect() == []
    assert retrieval.coarse_top_k(some, none, 3)[0].collect() == []
    assert [tuple(r) for r in retrieval.coarse_top_k(some, some, 3)[0].collect()] == [(1, 1, 1, 1.0)]


def test_idf_cosine(spark, monkeypatch):
    monkeypatch.setattr(term_weights, "FREQUENT", 30)
    rng = random.Random(6)
    words = ["the"] + [f"w{i}" for i in range(60)]
    docs = [(i, f"job{0 if i % 3 else i % 5}", " ".join(["the"] + rng.choices(words, k=rng.randrange(0, 12)))) for i in range(150)]
    docs += [(200, "job1", None), (201, None, "w1 w2"), (202, "nowhere", "w1"), (203, "job1", ""), (204, "job2", "The THE w9")]
    jobs = [(f"job{i}", " ".join(rng.choices(words, k=8))) for i in range(4)] + [("job4", None), (None, "w1")]
    df = spark.createDataFrame(docs, "doc_id long, job string, text string")
    frequencies = term_weights.document_frequencies(df)
    of = lambda text: set(re.findall(r"\w+", (text or "").lower()))
    number, counts = len(docs), {}
    for _, _, text in docs:
        for term in of(text):
            counts[term] = counts.get(term, 0) + 1
    idf = {t: math.log((number + 1) / (n + 1)) + 1 for t, n in counts.items()}
    assert {r["term"]: (r["df"], round(r["idf"], 9)) for r in frequencies.collect()} == {t: (counts[t], round(idf[t], 9)) for t in counts}
    found = term_weights.idf_cosine(df, spark.createDataFrame(jobs, "job string, text string"), frequencies, "doc_id", "job")
    got = {r["doc_id"]: round(r["idf_cosine"], 9) for r in found.collect()}
    texts = {job: of(text) & set(idf) for job, text in jobs if job}
    for doc_id, job, text in docs:
        a, b = of(text), texts.get(job, set())
        norm = math.sqrt(sum(idf[t] ** 2 for t in a)) * math.sqrt(sum(idf[t] ** 2 for t in b))
        want = sum(idf[t] ** 2 for t in a & b) / norm if norm else 0
        assert got[doc_id] == round(want, 9), doc_id
    assert len(got) == len(docs)


def test_idf_cosine_writes_shared_terms_only(spark, monkeypatch):
    rows = []

    def counted(df, name):
        out = written(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(term_weights, "written", counted)
    docs = [(i, f"job{i % 2}", " ".join(["both", "both"] + [f"w{i}x{k}" for k in range(50)])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, job string, text string")
    jobs = spark.createDataFrame([("job0", "both other"), ("job1", "Both")], "job string, text string")
    lists = df.withColumn("text", term_weights.terms_of(df["text"]))
    frequencies = term_weights.document_frequencies(lists)
    assert sorted(frequencies.collect()) == sorted(term_weights.document_frequencies(df).collect())
    found = [{r["doc_id"]: round(r["idf_cosine"], 9) for r in term_weights.idf_cosine(d, jobs, frequencies, "doc_id", "job").collect()}
             for d in (lists, df)]
    rare = math.log(41 / 2) + 1
    assert found[0] == found[1] == {i: round(1 / math.sqrt(1 + 50 * rare * rare), 9) for i in range(40)}
    assert max(rows) == 40  # one row per shared term of a text, not one per term


def test_boosted_iterations(spark):
    from pyspark.ml.linalg import Vectors
    rng = random.Random(9)
    rows = []
    for i in range(400):
        x = [rng.random() for _ in range(3)]
        rows.append((i, Vectors.dense(x), x[0] + 0.5 * (x[1] > 0.5) * x[2], i % 4 == 0))
    df = spark.createDataFrame(rows, ["id", "features", "label", "held"])
    train, held = df.filter("not held"), df.filter("held")
    model, trees, log = boosting.select_iteration(train, held, iterations=6, depth=2)
    each = log.orderBy("epoch").collect()
    spark_own = model.evaluateEachIteration(held, "squared")
    assert [round(r["mse"], 9) for r in each] == [round(v, 9) for v in spark_own]
    assert trees == min(range(len(each)), key=lambda i: round(each[i]["mse"], 12)) + 1 > 1
    scored = boosting.score_boosted(model, held, trees)
    assert scored.columns == [*held.columns, "predicted_score"]
    errors = [(r["predicted_score"] - r["label"]) ** 2 for r in scored.collect()]
    assert round(sum(errors) / len(errors), 9) == round(each[trees - 1]["mse"], 9)
    assert boosting.select_iteration(train, held.limit(0), iterations=2, depth=1)[1] == 2


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_quarantine_of_json_lines(spark, tmp_path):
    lines = ['{"a": 1, "t": "x"}', '{"a": 2, "t": "y"', "", '["a"]', '{"a": "no", "t": "z"}', '{"a": 3}', '{"a": 4, "t": null}', '{"a": null, "t": "w", "other": [1]}', "7", '{"a": 5, "t": "x"} and more']
    put(tmp_path / "in/one.jsonl", "\n".join(lines) + "\n")
    put(tmp_path / "in/two.jsonl", "\n".join(reversed(lines)))
    put(tmp_path / "in/none.jsonl", "")
    want = [("", 1), ("malformed JSON", 2), ("empty line", 3), ("no object", 4), ("wrong type", 5), ("no t", 6), ("no t", 7), ("", 8), ("no object", 9), ("malformed JSON", 10)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 60)
    try:
        good, bad = quarantine.read_json_lines(spark, str(tmp_path / "in"), "a bigint, t string", ["t"])
        got = [(os.path.basename(r["file"]), "", r["line"]) for r in good.collect()] + [(os.path.basename(r["file"]), r["reason"], r["line"]) for r in bad.collect()]
        records = {r["record"] for r in bad.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted([("one.jsonl", r, n) for r, n in want] + [("two.jsonl", r, 11 - n) for r, n in want])
    assert records == set(lines) - {lines[0], lines[7]} and sorted(good.columns) == ["a", "file", "line", "t"]


def test_quarantine_of_csv_rows(spark, tmp_path):
    put(tmp_path / "p.csv", 'text_a,label,text_b\n"x, ""q""\nnext",0.5,y\na,b\na,high,c\na,1,c,extra\nd,,e\n,2,f\n')
    good, bad = quarantine.read_csv_rows(spark, str(tmp_path / "p.csv"), "text_b string, text_a string, label double", ["label"])
    assert sorted((r["text_b"], r["text_a"] or "", r["label"]) for r in good.collect()) == [("f", "", 2.0), ("y", 'x, "q"\nnext', 0.5)]
    assert sorted(r["reason"] for r in bad.collect()) == ["no label", "wrong number of cells", "wrong number of cells", "wrong type"]
    assert all(r["record"] and r["line"] is None for r in bad.collect())
    with pytest.raises(ValueError):
        quarantine.read_csv_rows(spark, str(tmp_path / "p.csv"), "nothing string")


def test_quarantine_of_json_arrays(spark, tmp_path):
    put(tmp_path / "in/good.json", '[{"file_name": "f", "n": 1},\n {"file_name": "g", "n": "x"}, 5, {"n": 2}, {"file_name": "h"}]')
    put(tmp_path / "in/cut.json", '[{"file_name": "f"')
    put(tmp_path / "in/object.json", '{"file_name": "f"}')
    good, bad = quarantine.read_json_arrays(spark, str(tmp_path / "in"), "file_name string, n int", ["file_name"])
    assert sorted((r["file_name"], r["n"], r["line"]) for r in good.collect()) == [("f", 1, 1), ("h", None, 5)]
    assert sorted((os.path.basename(r["file"]), r["line"] or 0, r["reason"]) for r in bad.collect()) == [
        ("cut.json", 0, "malformed JSON"), ("good.json", 2, "wrong type"), ("good.json", 3, "no object"), ("good.json", 4, "no file_name"),
        ("object.json", 0, "malformed JSON")]


@pytest.mark.parametrize("number, failing", [(1000, {3}), (1000, {0, 999}), (64, set(range(64))), (777, set()), (1, {0}), (500, {7, 8, 9, 400})])
def test_failing_records_are_found_by_halves(number, failing):
    calls = []

    def answer(model, batch):
        calls.append(batch.num_rows)
        values = batch.column(0).to_pylist()
        if failing & set(values):
            raise ValueError("bad")
        return [v * model for v in values]

    batch = pa.RecordBatch.from_pydict({"x": list(range(number))})
    values, problems = inference.answers_of(answer, 2, batch, (ValueError,))
    assert values == [None if i in failing else 2 * i for i in range(number)]
    assert [i for i, p in enumerate(problems) if p] == sorted(failing) and all(p in (None, "ValueError: bad") for p in problems)
    assert len(calls) <= 1 + 2 * len(failing) * math.ceil(math.log2(max(2, number)))


def test_batches_single_failures_and_models_per_worker(spark):
    def answer(model, batch):
        return [KeyError("k") if x % 10 == 0 else x + 1 for x in batch.column(0).to_pylist()]

    def load():
        return os.getpid()

    df = spark.range(200).repartition(20)
    rows = inference.infer_batches(df, ["id"], load, answer, "bigint").collect()
    assert {r["id"]: (r["value"], r["error"]) for r in rows} == {i: (None, "KeyError: 'k'") if i % 10 == 0 else (i + 1, None) for i in range(200)}
    short = inference.infer_batches(spark.range(3), ["id"], load, lambda m, b: [1], "bigint")
    assert {r["error"] for r in short.collect()} <= {None, "TypeError: 1 results for 2 records", "TypeError: 1 results for 3 records"}
    assert inference.infer_batches(spark.range(0), ["id"], load, answer, "bigint").collect() == []


def test_scrubbed_values_map_alike_and_apart(spark):
    from pyspark.sql import functions as F

    from dossier.functions import privacy
    texts = ["a@b.org and A@B.ORG, c@b.org", "4111 1111 1111 1111 and 4111111111111111 and 4111-1111-1111-1112", "10.0.0.1 10.0.0.2 10.0.0.1",
             "call 555-123-4567 or 555 123 4567", "nothing here", "", "a@b.org"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    got = {r["i"]: r["t"] for r in df.select("i", privacy.scrub_values(F.col("t"), "k").alias("t")).collect()}
    mails = re.findall(r"user_[g-pa-f]{12}@example\.com", got[0])
    assert len(mails) == 3 and mails[0] == mails[1] != mails[2] and got[6] == mails[0]
    numbers = re.findall(r"#[0-9]{16}", got[1])
    assert len(numbers) == 3 and numbers[0] == numbers[1] != numbers[2]
    ips = got[2].split(" ")
    assert ips[0] == ips[2] != ips[1] and all(ip.startswith("2001:db8::") for ip in ips)
    phones = re.findall(r"555-[0-9]{16}", got[3])
    assert len(phones) == 2 and phones[0] == phones[1]
    assert (got[4], got[5], got[99]) == ("nothing here", "", None)
    other = df.select("i", privacy.scrub_values(F.col("t"), "another key").alias("t")).filter("i = 6").head()["t"]
    assert other != got[6]


@pytest.mark.parametrize("raw, want", [
    (b"", "empty"), (None, "empty"), (b"GIF89a", "unknown format"), (b"\x89PNG\r\n\x1a\n", "cut off"),
    (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (640).to_bytes(4) + (480).to_bytes(4), (640, 480)),
    (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + bytes(8), "no size"),
    (b"\xff\xd8\xff\xe1\0\x04ab\xff\xff\xff\xc0\0\x0b\x08" + (30).to_bytes(2) + (70).to_bytes(2) + b"\1", (70, 30)),
    (b"\xff\xd8\xff\xe1\0\x04ab\xff\xda\0\x04ab", "no frame"), (b"\xff\xd8\xff\xe1\0\x00ab", "broken segment"),
    (b"\xff\xd8\xff\xe1\0\x04abXY\0\0", "broken segment"), (b"\xff\xd8\xff\xe1\xff\xff", "cut off"), (b"\xff\xd8\xff\xc0\0\x0b\x08", "cut off"),
])
def test_image_sizes(raw, want):
    from dossier.sources.images import image_size
    if isinstance(want, str):
        with pytest.raises(ValueError, match=want):
            image_size(raw)
    else:
        assert image_size(raw) == want


def test_page_dims_of_files(spark, tmp_path):
    from dossier.sources.images import read_page_dims
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.PNG").write_bytes(b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + (5).to_bytes(4) + (6).to_bytes(4) + bytes(9))
    (tmp_path / "in/b.jpg").write_bytes(b"not an image")
    good, bad = read_page_dims(spark, {"one": str(tmp_path / "in")})
    assert [(os.path.basename(r["path"]), r["source"], r["width"], r["height"]) for r in good.collect()] == [("a.PNG", "one", 5, 6)]
    assert [(os.path.basename(r["path"]), r["reason"]) for r in bad.collect()] == [("b.jpg", "unknown format")]


def test_repeated_appends_change_nothing(spark, tmp_path):
    from dossier.sources import sinks, tables
    rows = spark.createDataFrame([(1.0, 5, 0.3), (2.0, 6, 0.2)], "epoch double, step bigint, train_loss double")
    for run in ("007", "b", "007"):
        sinks.append_metrics(rows if run == "b" else rows.limit(1), str(tmp_path / "log"), run)
    got = tables.read_metrics(spark, str(tmp_path / "log")).collect()
    assert sorted((r["run"], r["epoch"]) for r in got) == [("007", 1.0), ("b", 1.0), ("b", 2.0)]


def test_results_are_read_again_only_if_some_failed(spark, tmp_path, monkeypatch):
    from dossier.sources import sinks
    def never(*_):
        raise AssertionError("read again")

    rows = spark.createDataFrame([(1, 0.5, 0.5)], "id int, pred_score double, true_score double")
    monkeypatch.setattr(sinks, "failed_pairs", never)
    assert not sinks.write_results(rows, str(tmp_path / "r"), str(tmp_path / "f"))
    assert not sinks.write_results(rows.limit(0), str(tmp_path / "e"), str(tmp_path / "f"))
