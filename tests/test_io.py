import json
import os

import pytest
from pyspark.sql import functions as F

from dossier import session
from dossier.functions import text
from dossier.operators import grouping, inference
from dossier.sources import files, sinks, tables
from dossier.streaming.incremental import incremental_files


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def test_scan_files(spark, tmp_path):
    for name in ("a/x.PNG", "a/deep.er/y.jpeg", "a/z.gif", "b/w.Jpg", "b/noext"):
        put(tmp_path / name, b"123")
    found = files.scan_files(spark, {"one": str(tmp_path / "a"), "two": str(tmp_path / "b")})
    assert found.columns == ["path", "length", "source"]
    got = {(r.source, os.path.basename(r.path), r.length) for r in found.collect()}
    assert got == {("one", "x.PNG", 3), ("one", "y.jpeg", 3), ("two", "w.Jpg", 3)}
    assert "content" in files.scan_files(spark, {"one": str(tmp_path / "a")}, content=True).columns


def test_skip_existing_outputs(spark, tmp_path):
    from dossier.operators.collections import pending_files
    for name in ("in/x.png", "in/sub/y.JPG", "out/x_train.png"):
        put(tmp_path / name, b"1")
    base = f"file:{tmp_path}"
    src = files.scan_files(spark, {"s": f"{tmp_path}/in"}).withColumn(
        "out_path", text.out_path(F.col("path"), f"{base}/in", f"{base}/out")
    )
    done = files.scan_files(spark, {"s": f"{tmp_path}/out"}).withColumnRenamed("path", "out_path")
    assert [os.path.basename(r.out_path) for r in pending_files(src, done).collect()] == ["y_train.JPG"]


def test_scan_pdfs(spark, tmp_path):
    for name in ("1.pdf", "2.PDF", "sub/3.pdf"):
        put(tmp_path / name, b"1")
    assert [r.file for r in files.scan_pdfs(spark, str(tmp_path)).collect()] == ["1.pdf"]


def test_read_truth(spark, tmp_path):
    path = put(tmp_path / "t.csv", 'ID,Resume_str\n007,first\n8,"two\nlines, ""quoted"""\n7,last\n9,\n10,NA\n')
    got = {r.id: r.text for r in tables.read_truth(spark, path).collect()}
    assert got == {"7": "last", "8": 'two\nlines, "quoted"', "9": "nan", "10": "nan"}
    raw = {r.id for r in tables.read_truth(spark, path, numeric_ids=False).collect()}
    assert raw == {"007", "7", "8", "9", "10"}


def test_pairs(spark, tmp_path):
    path = put(tmp_path / "p.csv", 'text_a,text_b,label\n"a, ""b""","x\ny",0.5\nc,d,1\n')
    pairs = tables.read_pairs(spark, path)
    assert sorted(pairs.collect()) == [('a, "b"', "x\ny", 0.5), ("c", "d", 1.0)]
    out = str(tmp_path / "pred")
    sinks.write_predictions(pairs.withColumn("predicted_score", F.lit(0.25)), out)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
    assert back.columns == ["text_a", "text_b", "label", "predicted_score"]
    assert ('a, "b"', "x\ny", "0.5", "0.25") in [tuple(r) for r in back.collect()]


def test_labeled_tokens(spark, tmp_path):
    flat = [{"file_name": f"cv{i // 2}.pdf", "text": f"t{i}", "bbox": [[0, 1], [2, 1], [2, 3], [0, 3.5]], "label": "PHONE"} for i in range(4)]
    rows = tables.read_labeled_flat(spark, put(tmp_path / "f.json", json.dumps(flat)))
    grouped = grouping.group_tokens(
        rows.withColumn("page_key", text.page_key(F.col("file_name"))), "page_key", "pos", ["text"]
    )
    assert {r.page_key: r.text for r in grouped.collect()} == {"cv0_page0": ["t0", "t1"], "cv1_page0": ["t2", "t3"]}
    nested = [{"image": "a.png", "ocr_labeled": [{"text": "x", "bbox": [1, 2, 3, 4], "label": "SKILL"}, {"text": "y", "bbox": [1, 2, 3, 4], "label": "?"}]}]
    tokens = tables.read_labeled_nested(spark, put(tmp_path / "n.json", json.dumps(nested)))
    assert [(r.image, r.pos, r.text) for r in tokens.orderBy("pos").collect()] == [("a.png", 0, "x"), ("a.png", 1, "y")]


def test_hot_page_is_several_nested_records(spark, tmp_path, monkeypatch):
    from dossier.plans import round_trips

    monkeypatch.setattr(round_trips, "TOKENS_PER_FILE", 100)
    monkeypatch.setattr(round_trips, "work_dir", lambda *_: str(tmp_path / "nested"))
    tokens = spark.range(1050).select(
        F.when(F.col("id") % 20 != 0, "hot").otherwise("cold").alias("page_key"), F.col("id").alias("pos"), F.col("id").cast("string").alias("text"),
        F.array(F.array(F.col("id").cast("double"), F.lit(1.0))).alias("bbox"), F.lit("PHONE").alias("label"))
    monkeypatch.setattr(round_trips, "_event_tokens", lambda *_: tokens)
    got = {(r.image, r.pos): r.text for r in round_trips.labeled_nested(spark, "").collect()}
    hot = [str(i) for i in range(1050) if i % 20]
    assert got == {("hot", i): x for i, x in enumerate(hot)} | {("cold", i): str(20 * i) for i in range(53)}
    records = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "nested")).collect()]
    assert max(len(r["ocr_labeled"]) for r in records) == 100 and len(records) == 11


def test_read_instructions(spark, tmp_path):
    lines = [{"instruction": "读", "input": f"i{n}", "output": "o"} for n in range(50)] + [{"input": "only"}, {"output": None}]
    path = put(tmp_path / "i.jsonl", "\n".join(json.dumps(x, ensure_ascii=False) for x in lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        got = tables.read_instructions(spark, path).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.id for r in got] == list(range(52))
    assert [r.input for r in got] == [f"i{n}" for n in range(50)] + ["only", ""]
    assert got[50].instruction == "" and got[51].output == ""


def test_metric_logs(spark, tmp_path):
    path = put(tmp_path / "log.tsv", "Epoch\tVal\n1\t0.5\n2\t0.75\n")
    assert tables.read_metric_log(spark, path, "\t").dtypes == [("Epoch", "int"), ("Val", "double")]
    assert tables.read_metric_log(spark, path, "\t", "Epoch int, Val double").count() == 2
    out = str(tmp_path / "metrics")
    sinks.append_metrics(spark.createDataFrame([(1.0, 5, 0.3)], "epoch double, step bigint, train_loss double"), out)
    sinks.append_metrics(spark.createDataFrame([(1.0, 5, 0.2, 0.9)], "epoch double, step bigint, eval_loss double, f1 double"), out)
    rows = {(r.train_loss, r.eval_loss, r.f1) for r in spark.read.parquet(out).collect()}
    assert rows == {(0.3, None, None), (None, 0.2, 0.9)}


def test_sequences(spark, tmp_path):
    df = spark.createDataFrame([([1, 2], [1, 0])], "input_ids array<int>, attention_mask array<int>")
    sinks.write_sequences(df, str(tmp_path / "s"))
    assert tables.read_sequences(spark, str(tmp_path / "s")).collect() == df.collect()
    with pytest.raises(ValueError):
        sinks.write_sequences(df.filter("size(input_ids) > 9"), str(tmp_path / "none"))


def test_results(spark, tmp_path):
    rows = spark.createDataFrame([(1, "好", 0.5, 0.5), (2, "b", None, 0.5)], "id int, generated_output string, pred_score double, true_score double")
    assert sinks.write_results(rows, str(tmp_path / "r"), str(tmp_path / "f"))
    raw = "".join(p.read_text() for p in (tmp_path / "r").glob("*.json"))
    assert "好" in raw and '"pred_score":null' in raw
    assert [r.id for r in spark.read.json(str(tmp_path / "f")).collect()] == [2]
    assert not sinks.write_results(rows.filter("id = 1"), str(tmp_path / "r2"), str(tmp_path / "f2"))
    assert not (tmp_path / "f2").exists()


def test_report_round_trip(spark, tmp_path):
    rows = [(n, n / 10 if n else -1.0, f"line {n}\n- \"score\"\n") for n in range(12)]
    df = spark.createDataFrame(rows, "id bigint, score double, generated_output string").repartition(3)
    sinks.write_report(df, str(tmp_path / "rep"))
    parts = sorted((tmp_path / "rep").glob("part-*"))
    whole = "".join(p.read_text() for p in parts)
    assert whole.startswith("ID: 0\nScore: -1\n") and whole.index("ID: 3\n") < whole.index("ID: 11\n")
    back = tables.parse_report(spark, str(tmp_path / "rep")).orderBy("id").collect()
    assert [tuple(r) for r in back] == rows
    # also without the separator after the last block
    single = put(tmp_path / "single.txt", whole.rstrip("\n"))
    assert tables.parse_report(spark, single).count() == 12


def test_run_manifest(spark, tmp_path):
    sinks.write_run_manifest(spark, {"epochs": 20, "path": "/x", "rate": 0.1, "exts": ["a"]}, str(tmp_path / "m"))
    row = spark.read.json(str(tmp_path / "m")).head()
    assert row.epochs == 20 and row.path == "/x" and row.exts == '["a"]'
    assert len(row.created_at) == 19 and row.created_at[4] == "-"


def test_incremental_files(spark, tmp_path):
    src = tmp_path / "src"
    run = lambda: incremental_files(
        spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), "n bigint", lambda df: df.withColumn("twice", F.col("n") * 2)
    )
    spark.range(3).withColumnRenamed("id", "n").coalesce(1).write.mode("append").parquet(str(src))
    assert sorted(r.twice for r in run().collect()) == [0, 2, 4]
    spark.range(5, 6).withColumnRenamed("id", "n").coalesce(1).write.mode("append").parquet(str(src))
    assert sorted(r.twice for r in run().collect()) == [0, 2, 4, 10]
    assert sorted(r.twice for r in run().collect()) == [0, 2, 4, 10]


def test_work_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.work_dir(spark, "x").startswith(f"{base}/x-")
    assert session.work_dir(spark, "x") != session.work_dir(spark, "x")
    df = spark.range(3)
    assert sorted(session.written(df, "t").collect()) == sorted(df.collect())


def test_batch_infer(spark):
    def loader():
        return {"calls": 0}

    def invert(model, record):
        model["calls"] += 1
        return 1 / record["x"] + record["y"]

    df = spark.createDataFrame([(1, 2.0, 0.5), (2, 0.0, 1.0), (3, 4.0, 0.0)], "id int, x double, y double")
    done = inference.batch_infer(df, ["x", "y"], loader, invert, "double")
    good, bad = inference.split_errors(done)
    assert {r.id: r.value for r in good.collect()} == {1: 1.0, 3: 0.25}
    row = bad.head()
    assert row.id == 2 and row.value is None and row.error.startswith("ZeroDivisionError")


def test_score_records(spark):
    answers = {"good": "匹配度：0.8\n理由：强", "zero": "0.0 理由：缺乏经验", "none": "no idea"}
    records = spark.createDataFrame(
        [(0, "cv", "good", "0.7"), (1, "cv", "zero", "0.1"), (2, "cv", "none", "0.5"), (3, "cv", "fail", None)],
        "id int, instruction string, input string, output string",
    )

    def generate(model, prompt):
        word = prompt.split("岗位描述: ")[1].split("\n")[0]
        return "  " + model[word] + " "

    got = {r.id: r for r in inference.score_records(records, lambda: answers, generate).collect()}
    assert got[0].pred_score == 0.8 and got[0].true_score == 0.7 and got[0].reason_only == "理由：强"
    assert got[1].pred_score == 0.4 and got[1].generated_output.startswith("0.0 理由：有待提升经验 ")
    assert got[2].pred_score is None and got[2].generated_output == "no idea" and got[2].reason_only == ""
    assert got[3].pred_score is None and got[3].reference_output == ""


def test_echoed_prompt(spark):
    """An answer that repeats the prompt takes a number from it when it has none of its own."""
    record = spark.createDataFrame([(0, "cv", "job", "0.5")], "id int, instruction string, input string, output string")
    echo = lambda model, prompt: prompt
    assert inference.score_records(record, lambda: None, echo).head().pred_score == 1.0
    assert inference.score_records(record, lambda: None, echo, criteria=False).head().pred_score is None


def test_batch_infer_keeps_whole_numbers(spark):
    """Numbers beyond 2**53 stay exact beside nulls and failures; only the named columns reach Python."""
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big, "a"), (2, None, "b"), (3, big + 2, "c")], "k int, id bigint, t string").coalesce(1)

    def answer(model, record):
        assert set(record) == {"id", "t"}
        if record["t"] == "c":
            raise ValueError("c")
        return record["id"]

    done = inference.batch_infer(df, ["id", "t"], lambda: None, answer, "bigint", keep=["k", "id"])
    assert done.columns == ["k", "id", "value", "error"]
    rows = [tuple(r) for r in done.orderBy("k").collect()]
    assert rows == [(1, big, big, None), (2, None, None, None), (3, big + 2, None, "ValueError: c")]
    strict = inference.batch_infer(df, ["id", "t"], lambda: None, answer, "bigint", errors=(KeyError,))
    with pytest.raises(Exception, match="ValueError"):
        strict.collect()


def test_failed_write_leaves_sequences_alone(spark, tmp_path):
    df = spark.createDataFrame([([1, 2],)], "input_ids array<int>")
    sinks.write_sequences(df, str(tmp_path / "s"))
    with pytest.raises(ValueError):
        sinks.write_sequences(df.limit(0), str(tmp_path / "s"))
    assert tables.read_sequences(spark, str(tmp_path / "s")).count() == 1


def test_flat_tokens_of_several_files_are_in_file_order(spark, tmp_path):
    for name, n in (("a", 2), ("b", 50), ("c", 3)):
        rows = [{"file_name": name, "text": f"{name}{i}", "bbox": [], "label": "O"} for i in range(n)]
        put(tmp_path / f"{name}.json", json.dumps(rows))
    rows = tables.read_labeled_flat(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(55))
    assert [r.text for r in rows] == [f"{f}{i}" for f, n in (("a", 2), ("b", 50), ("c", 3)) for i in range(n)]


def test_remove_work(spark):
    table = session.written(spark.range(3), "trial")
    path = session._made[spark.sparkContext.applicationId][-1]
    assert table.count() == 3 and os.path.isdir(path)
    kept = session._made[spark.sparkContext.applicationId][:-1]
    session._made[spark.sparkContext.applicationId] = [path]
    try:
        assert session.remove_work(spark) == 1 and not os.path.exists(path)
    finally:
        session._made[spark.sparkContext.applicationId] = kept
