"""Helpers shared by the operators: shared-folder tables, files, word hashes, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.session import work_dir, written

__all__ = ["work_dir", "written", "table", "fresh", "write_file", "read_file", "shuffles_removed", "text_bytes", "words_of", "shingles", "perhaps_in", "components"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in df.columns:
        name += "_"
    return name


def write_file(path: str, payload: bytes) -> None:
    """Write one whole file in any store pyarrow can reach.

    A temporary name and a rename make a repeated task harmless: the last complete
    copy wins and readers never see half a file.
    """
    if "://" not in path and path.startswith("file:"):
        path = path[len("file:"):]
    store, plain = fs.FileSystem.from_uri(path)
    store.create_dir(plain.rsplit("/", 1)[0], recursive=True)
    trial = f"{plain.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"
    with store.open_output_stream(trial) as out:
        out.write(payload)
    try:
        store.move(trial, plain)
    except OSError:
        if store.get_file_info(plain).type != fs.FileType.File:
            raise
        store.delete_file(trial)  # a store that does not replace files has an equal one already


def read_file(path: str) -> pa.Buffer:
    """One whole file that ``write_file`` has written."""
    if "://" not in path and path.startswith("file:"):
        path = path[len("file:"):]
    store, plain = fs.FileSystem.from_uri(path)
    with store.open_input_file(plain) as source:
        return source.read_buffer()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query has shuffled goes from the disks when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_rng = np.random.default_rng(20240611)
#: One random odd 64-bit value per byte value, and the powers of a random odd base.
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (three xor-shift and multiply steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.multiply.accumulate(np.full(1 << 12, BASE, dtype=np.uint64))


def powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.full(max(n, 2 * len(_POWERS)), BASE, dtype=np.uint64))
    return _POWERS


def text_bytes(texts: pa.Array) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text as a view; null counts as empty."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        for value in chunk.cast(pa.large_binary()):
            raw = value.as_buffer()
            yield np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, which white space (space and 09 to 0D) separates."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~SPACE[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts = edge[inside[edge]]
    ends = edge[~inside[edge]]
    if inside[0]:
        starts = np.concatenate(([0], starts))
    if inside[-1]:
        ends = np.concatenate((ends, [len(raw)]))
    return starts, ends


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, from its bytes alone."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    place = np.arange(len(raw)) - np.repeat(
        np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(raw)]))))
    value = BYTE_CODE[raw]
    value[SPACE[raw]] = 0
    value *= powers(int(place.max()) + 1)[place]
    return mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64))


def shingles(raw: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased word shingles of one text.

    A text with fewer words than ``width`` has its whole word sequence as one shingle;
    a text without words has none.
    """
    raw = LOWER[raw]
    h = word_hashes(raw, *words_of(raw))
    if not len(h):
        return h
    width = min(width, len(h))
    total = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        total = mix(total * BASE + h[i:len(h) - width + 1 + i])
    return np.unique(total)


#: Bits of the map that ``perhaps_in`` broadcasts, as powers of two: at least, at most (16 MB), and wanted for a key.
BITS_LEAST, BITS_MOST, BITS_KEY = 21, 27, 16
PAGE = 32768


def perhaps_in(df: DataFrame, key: str, keys: DataFrame, out: str) -> DataFrame:
    """Add ``out``, which is false only where ``key`` is surely not in the table ``keys`` (its column of that name).

    Rows that are surely not there need no shuffle for a join; an exact join of the others has to follow. Each key
    sets one bit of a map in pages, which is broadcast. The map's size is bounded: with many more keys
    it rules out fewer rows. ``keys`` is read twice; write it first.
    """
    bits = 1 << min(BITS_MOST, max(BITS_LEAST, (BITS_KEY * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(bits))
    paged = keys.select(F.floor(place / PAGE).alias("_page"), (place % PAGE).alias("_bit")).repartition("_page")
    pages = paged.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.substring("_bits", F.floor(place % PAGE / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int"))
    found = df.withColumn("_page", F.floor(place / PAGE)).join(F.broadcast(pages), "_page", "left")
    return found.select(*df.columns, F.coalesce(bit == 1, F.lit(False)).alias(out))


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` has one smaller end ``v``, which is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
    return ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).filter("leaf > 1 or leaf + root > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges: one row (node, root) per node, root the smallest.

    Alternating stars: every node hands its larger neighbours its smallest neighbour,
    then its smaller ones. The edges shrink to one star per component in a number of
    rounds that grows with the logarithm of the longest path. The smallest neighbour is
    an aggregate (combined map-side) that is written before it is joined, so the adaptive
    skew join can split a hub. Each round's edges are written, which cuts the lineage; no round follows once they are stars.
    Null ends and loops are dropped; an isolated node is not listed.
    """
    edges = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    edges = written(edges, "edges")
    for _ in range(most_rounds):
        if _stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = (both.filter(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = written(large.filter("u > v").distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = large.join(least, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(joined.select("u", F.col("m").alias("v"))))
        edges = written(small.filter("u > v").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
