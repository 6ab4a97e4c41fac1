"""Plug-in models over partitions, and scoring of generated text."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from dossier.functions.text import (
    floor_zero_score,
    last_unit_number,
    py_strip,
    reason_tail,
    render_prompt,
    soften_reason,
)


#: Models by the call that uses them, so that a worker process loads each once however many tasks it runs.
_loaded: dict[str, Any] = {}


def loaded(name: str, loader: Callable[[], Any]) -> Any:
    """The worker process's own model."""
    if name not in _loaded:
        _loaded.clear()  # models of earlier calls are not needed again
        _loaded[name] = loader()
    return _loaded[name]


def answers_of(
    fn: Callable[[Any, pa.RecordBatch], Sequence], model: Any, batch: pa.RecordBatch, errors: tuple[type[Exception], ...]
) -> tuple[list, list[str | None]]:
    """Results and problems of all records of a batch, with as few calls as a failure allows.

    A call that fails is repeated on both halves of its records, until the failing records
    are alone: at most 1 + 2 b ceil(log2 n) calls for b failing ones among n. A result that is an exception stands for
    its record's failure and costs no further call.
    """
    values: list = [None] * batch.num_rows
    problems: list[str | None] = [None] * batch.num_rows
    open_ = [(0, batch.num_rows)] if batch.num_rows else []
    while open_:
        start, size = open_.pop()
        try:
            got = list(fn(model, batch.slice(start, size)))
            if len(got) != size:
                raise TypeError(f"{len(got)} results for {size} records")
        except errors as problem:
            if size == 1:
                problems[start] = f"{type(problem).__name__}: {problem}"
            else:
                open_ += [(start + size // 2, size - size // 2), (start, size // 2)]
            continue
        for i, value in enumerate(got, start):
            if isinstance(value, errors):
                problems[i] = f"{type(value).__name__}: {value}"
            else:
                values[i] = value
    return values, problems


def infer_batches(
    df: DataFrame,
    inputs: list[str],
    loader: Callable[[], Any],
    fn: Callable[[Any, pa.RecordBatch], Sequence],
    out_type: str = "string",
    out: str = "value",
    keep: list[str] | None = None,
    errors: tuple[type[Exception], ...] = (Exception,),
) -> DataFrame:
    """Run a model over whole batches of records and keep going when some fail.

    ``fn(model, batch)`` gets an Arrow batch of the ``inputs`` and returns one result per record. ``loader`` is called
    once per worker process. Adds ``out`` and ``error`` (null on success) to the columns ``keep`` (all by
    default); only these and the inputs reach Python. A failing batch is halved until its failing records
    are alone. Kept columns pass as they came; results are plain Python values. Exceptions other than ``errors``
    end the job. Batches follow ``spark.sql.execution.arrow.maxRecordsPerBatch``, so memory does not grow with the
    partition. An empty batch makes no call. Both callables are sent to the executors.
    """
    keep = df.columns if keep is None else list(keep)
    result = StructType.fromDDL(f"`{out}` {out_type}, `error` string")
    schema = StructType([df.schema[c] for c in keep] + result.fields)
    kind = to_arrow_type(result[out].dataType)
    name = uuid.uuid4().hex

    def run(batches):
        for batch in batches:
            values, problems = answers_of(fn, loaded(name, loader), batch.select(inputs), errors)
            columns = [*(batch.column(c) for c in keep), pa.array(values, kind), pa.array(problems, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, out, "error"])

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)


def batch_infer(
    df: DataFrame,
    inputs: list[str],
    loader: Callable[[], Any],
    fn: Callable[[Any, dict], Any],
    out_type: str = "string",
    out: str = "value",
    keep: list[str] | None = None,
    errors: tuple[type[Exception], ...] = (Exception,),
) -> DataFrame:
    """``infer_batches`` for a model that takes one record, a dict of the ``inputs``, at a time."""
    def each(model, batch):
        def one(record):
            try:
                return fn(model, record)
            except errors as problem:
                return problem

        return [one(record) for record in batch.to_pylist()]

    return infer_batches(df, inputs, loader, each, out_type, out, keep, errors)


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) records after ``batch_infer``.

    Each part runs the plan it is given; write the inference result first if both
    parts are needed from a costly model.
    """
    return df.filter(F.col("error").isNull()).drop("error"), df.filter(F.col("error").isNotNull())


def parse_scores(df: DataFrame, response: str = "response", reference: str = "output") -> DataFrame:
    """Scores, reworded text and reason from a raw response. All built-in expressions.

    A response without a score keeps its text; a zero score is lifted and its text
    softened if it is harsh.
    """
    raw = df.withColumn("generated_output", py_strip(F.col(response)))
    scored = raw.withColumn("_score", last_unit_number(F.col("generated_output"))).withColumn(
        "generated_output", soften_reason(F.col("_score"), F.col("generated_output"))
    )
    kept = [c for c in df.columns if c not in (response, reference)]
    return scored.select(
        *kept,
        "generated_output",
        F.col(reference).alias("reference_output"),
        floor_zero_score(F.col("_score")).alias("pred_score"),
        last_unit_number(F.col(reference)).alias("true_score"),
        reason_tail(F.col("generated_output")).alias("reason_only"),
    )


def score_records(
    df: DataFrame,
    loader: Callable[[], Any],
    generate: Callable[[Any, Any], Any],
    id_: str = "id",
    criteria: bool = True,
    batched: bool = False,
) -> DataFrame:
    """Instruction records to score results: prompt, model, parsing, adjustment.

    ``generate(model, prompt)`` returns the full response, with or without the prompt. With ``batched`` it
    gets a list of prompts and returns a list of responses.
    A record whose generation fails has null scores, so it counts as failed; ``error``
    says why.
    """
    prompts = df.select(
        id_, F.coalesce("output", F.lit("")).alias("output"),
        render_prompt(
            F.coalesce("instruction", F.lit("")), F.coalesce("input", F.lit("")), criteria
        ).alias("prompt"),
    )
    if batched:
        answered = infer_batches(
            prompts, ["prompt"], loader, lambda model, batch: generate(model, batch.column(0).to_pylist()), out="response",
            keep=[id_, "output"],
        )
    else:
        answered = batch_infer(
            prompts, ["prompt"], loader, lambda model, record: generate(model, record["prompt"]), out="response",
            keep=[id_, "output"],
        )
    return parse_scores(answered)
