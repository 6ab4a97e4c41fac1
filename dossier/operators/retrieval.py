"""Coarse retrieval: the N best candidates of each target by vector, exactly.

Candidates are dealt to blocks around pivots, and large blocks are cut into chunks of bounded size. A chunk
is one row: ids, vectors, their mean and radius. Targets go to all tasks in bounded groups. A
target's score with any vector of a chunk is at most its product with the mean plus its norm times
the radius; a chunk whose bound is below the target's running N-th best score is skipped. That score starts
from the exact N-th best among a bounded sample of the candidates, so most chunks are skipped from the start.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.session import written

#: Bounds: pivots, sample of candidates, rows of a chunk, targets in a group.
PIVOTS = 256
SAMPLE = 4096
CHUNK_ROWS = 4096
GROUP_TARGETS = 2048
#: Decimals of a score. Sums in another order differ beyond, so equal vectors tie.
PLACES = 9
_SLACK = 1e-9
_INDEX = "dim int, chunk string, n int, ids array<bigint>, vectors binary, mean array<double>, radius double"


def usable(vector: Column) -> Column:
    """Neither null nor empty, all values known and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def vectors_of(df: DataFrame, id_: str, vector: str, normalize: bool) -> DataFrame:
    """``id``, ``v`` (doubles) and ``dim`` of usable rows; with ``normalize`` of length 1, zero vectors dropped."""
    rows = df.filter(F.col(id_).isNotNull() & usable(F.col(vector))).select(
        F.col(id_).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"))
    if not normalize:
        return rows
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("_norm", norm).filter("_norm > 0").select("id", F.transform("v", lambda x: x / F.col("_norm")).alias("v"), "dim")


def _matrix(frame: pd.DataFrame, column: str = "v") -> np.ndarray:
    return np.stack(frame[column].to_numpy()) if len(frame) else np.empty((0, 0))


def sample_of(rows: DataFrame, most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension ids and vectors of at most ``most`` rows in the order of a digest, so retries agree."""
    digest = F.xxhash64("id", "v")
    place = F.row_number().over(Window.partitionBy("dim").orderBy(digest, "id"))
    frame = rows.withColumn("_place", place).filter(F.col("_place") <= most).select("id", "v", "dim").toPandas()
    return {int(dim): (part["id"].to_numpy(np.int64), _matrix(part)) for dim, part in frame.groupby("dim")}


def build_index(candidates: DataFrame, id_: str = "id", vector: str = "vector", normalize: bool = True) -> tuple[DataFrame, dict]:
    """Write the candidates as chunks. Returns the index and the sample that gives first scores.

    A chunk holds vectors of one pivot. Pivots with many vectors, a third of all or copies of one,
    are cut by a digest of the id into as many chunks as their count asks for.
    """
    rows = written(vectors_of(candidates, id_, vector, normalize), "vectors")
    sample = sample_of(rows, SAMPLE)
    pivots = {dim: v[:PIVOTS] for dim, (_, v) in sample.items()}

    def near(batches):
        for batch in batches:
            dims = batch.column(2).to_numpy()
            pivot = np.zeros(len(dims), np.int32)
            values, offsets = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = values[offsets[at][:, None] + np.arange(dim)]
                p = pivots[int(dim)]
                pivot[at] = np.argmin((p * p).sum(1) - 2 * (x @ p.T), axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], ["id", "v", "dim", "pivot"])

    dealt = written(rows.mapInArrow(near, "id long, v array<double>, dim int, pivot int"), "dealt")
    counts = dealt.groupBy("dim", "pivot").agg(F.count(F.lit(1)).alias("_n"))  # PIVOTS rows per dimension
    cut = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / (CHUNK_ROWS // 2)))
    keyed = dealt.join(F.broadcast(counts), ["dim", "pivot"]).select(
        "id", "v", "dim", F.concat_ws(":", "dim", "pivot", cut.cast("string")).alias("chunk"))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(frame)
        mean = x.mean(0)
        radius = float(np.sqrt(((x - mean) ** 2).sum(1).max()))
        return pd.DataFrame([[int(frame["dim"].iloc[0]), frame["chunk"].iloc[0], len(x), frame["id"].tolist(), x.tobytes(), mean.tolist(), radius]],
                            columns=["dim", "chunk", "n", "ids", "vectors", "mean", "radius"])

    return written(keyed.groupBy("chunk").applyInPandas(pack, _INDEX), "index"), sample


def _first_scores(targets: np.ndarray, sample: tuple[np.ndarray, np.ndarray] | None, k: int) -> np.ndarray:
    """Exact k-th best score among the sample, a lower bound of the k-th best of all."""
    if sample is None or len(sample[0]) < k:
        return np.full(len(targets), -np.inf)
    scores = targets @ sample[1].T
    return np.partition(scores, -k, axis=1)[:, -k] - _SLACK


def _search(index: DataFrame, dim: int, targets: pd.DataFrame, sample, k: int) -> DataFrame:
    """Best rows per target and task (target, id, score), and per task what was looked at (seen, skipped)."""
    queries = _matrix(targets)
    shared = index.sparkSession.sparkContext.broadcast((
        targets["id"].to_numpy(np.int64), queries, np.sqrt((queries * queries).sum(1)), _first_scores(queries, sample, k)))

    def run(batches):
        names, q, norms, first = shared.value
        least = first.copy()
        best = [(np.empty(0), np.empty(0, np.int64))] * len(names)
        seen = skipped = 0
        for batch in batches:
            for row in batch.to_pylist():
                mean = np.array(row["mean"])
                wanted = np.flatnonzero(q @ mean + norms * row["radius"] + _SLACK >= least)
                seen, skipped = seen + len(wanted), skipped + len(names) - len(wanted)
                if not len(wanted):
                    continue
                ids = np.array(row["ids"], np.int64)
                scores = np.round(q[wanted] @ np.frombuffer(row["vectors"]).reshape(-1, dim).T, PLACES)
                for t, s in zip(wanted, scores):
                    keep = np.flatnonzero(s >= least[t])
                    if not len(keep):
                        continue
                    s_all, i_all = np.concatenate((best[t][0], s[keep])), np.concatenate((best[t][1], ids[keep]))
                    order = np.lexsort((i_all, -s_all))[:k]
                    best[t] = s_all[order], i_all[order]
                    if len(order) == k:
                        least[t] = max(least[t], best[t][0][-1])
        found = [(int(names[t]), int(i), float(s), None, None) for t, (s_, i_) in enumerate(best) for s, i in zip(s_, i_)]
        found.append((None, None, None, seen, skipped))
        columns = list(zip(*found))
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["target", "id", "score", "seen", "skipped"])

    return index.filter(F.col("dim") == dim).select("ids", "vectors", "mean", "radius").mapInArrow(
        run, "target long, id long, score double, seen long, skipped long")


def coarse_top_k(
    targets: DataFrame, candidates: DataFrame, k: int, target: str = "id", candidate: str = "id", vector: str = "vector",
    normalize: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The ``k`` candidates with the highest cosine (inner product without ``normalize``) for each target.

    Returns (best, work): ``target``, ``rank``, ``id``, ``score`` (to ``PLACES`` decimals), equal scores by ascending
    id, and one row with the numbers of (target, chunk) pairs ``seen`` and ``skipped``. Rows without
    id and vectors that are null, empty, zero (if normalized) or not finite match nothing, and vectors match only those of
    their own length. Repeated ids are listed as often as they occur. Targets pass through the
    driver in groups of ``GROUP_TARGETS``; candidates are read once per group.
    """
    spark = candidates.sparkSession
    index, sample = build_index(candidates, candidate, vector, normalize)
    asked = written(vectors_of(targets, target, vector, normalize).orderBy("dim", "id"), "targets")
    parts = []

    def search(group: list) -> None:
        frame = pd.DataFrame(group, columns=["id", "v", "dim"])
        dim = int(frame["dim"].iloc[0])
        parts.append(written(_search(index, dim, frame.drop_duplicates("id"), sample.get(dim), k), "best"))

    group: list = []
    for row in asked.orderBy("dim", "id").toLocalIterator():
        if group and (len(group) >= GROUP_TARGETS or group[0][2] != row["dim"]):
            search(group)
            group = []
        group.append((row["id"], np.array(row["v"]), row["dim"]))
    if group:
        search(group)
    found = spark.createDataFrame([], "target long, id long, score double, seen long, skipped long")
    for part in parts:
        found = found.unionByName(part)
    order = Window.partitionBy("target").orderBy(F.desc("score"), "id")
    best = found.filter("target is not null").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    work = found.agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))
    return best.select("target", "rank", "id", "score"), work
