"""Importance resampling towards a target, with hashed word n-grams and a head-tail vocabulary.

Features of a text are its runs of one to three words; each falls into one of ``BUCKETS`` buckets by
the CRC-32 of its bytes. The head of the vocabulary is counted over all documents: words that make up at least one
``HEAD_WORDS``th of all words, and pairs that make up at least one ``HEAD_PAIRS``th of all pairs of words with a share of
one ``PAIR_WORDS``th or more, so there are never more than these numbers of them. For these
the state of the checksum after the word, and the state and bucket of the pair, go to all tasks. The state of a
longer run follows from the states of its parts, since a CRC is linear: the state of the left part is shifted by the
length of the right one (four table lookups) and added to the state of the right one. Words of the tail are
summed byte by byte, and runs with one take the same way, so all buckets are exact.

Both the documents and the target give exact bucket totals; a bucket's gain is the logarithm of its
smoothed share in the target against that in the documents, a document's weight the sum over its
features. Documents are drawn without replacement by adding a Gumbel variable, derived from the id, and
keeping the highest scores; ranks come from ranges of scores, of which only those above the cut are sorted.

Null and empty texts have no feature and weight 0. Documents with fewer than ``LEAST_WORDS`` words and
those without id are scored (the latter null) but not drawn. Repeated rows count as often as they occur; rows with equal
score and id rank in any order. An empty table gives an empty result, and an empty target leaves the priors
of the buckets. Further columns, also those named like results, are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.terms import Words, places, slices
from dossier.operators.skew import bucketed, running_before, split_points
from dossier.session import written

BUCKETS = 10_000
LEAST_WORDS = 20
#: Percent of the eligible documents that are drawn.
SHARE = 5
#: Bounds of what is broadcast: words, words of pairs, pairs, and bytes of a word of the head.
HEAD_WORDS = 32_768
PAIR_WORDS = 1_024
HEAD_PAIRS = 262_144
HEAD_BYTES = 64
#: Ranges of scores for each shuffle partition.
RANGES = 4

_POLYNOMIAL = 0xEDB88320
_START = 0xFFFFFFFF
_SHIFTS = 64


def _byte_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(_POLYNOMIAL), out >> 1).astype(np.uint32)
    return out


STEP = _byte_table()


def _shift_tables() -> np.ndarray:
    """[length, byte of the state, its value]: the state after ``length`` zero bytes, flat."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    rows = [state]
    for _ in range(_SHIFTS):
        state = (state >> 8) ^ STEP[state & 255]
        rows.append(state)
    return np.stack(rows).reshape(-1)


SHIFT = _shift_tables()


def shift(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """States after ``length`` zero bytes."""
    length = np.asarray(length, np.int64)
    while len(length) and int(length.max()) > _SHIFTS:
        now = np.minimum(length, _SHIFTS)
        state, length = shift(state, now), length - now
    at = length << 10
    state = state.astype(np.int64)
    return (SHIFT[at + (state & 255)] ^ SHIFT[at + 256 + (state >> 8 & 255)]
            ^ SHIFT[at + 512 + (state >> 16 & 255)] ^ SHIFT[at + 768 + (state >> 24)])


def sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """State of each word from zero, byte by byte for all words at once, the longest first."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(starts - ends, kind="stable")
    at, stop, state = starts[order], ends[order], out[order]
    lengths = stop - at
    alive = len(order)
    for i in range(int(lengths[0]) if alive else 0):
        alive = int(np.searchsorted(-lengths[:alive], -i, "left"))
        low = state[:alive]
        state[:alive] = (low >> 8) ^ STEP[(low ^ data[at[:alive] + i]) & 255]
    out[order] = state
    return out


#: State of a space from zero.
_SPACE = int(STEP[32])


class Head(NamedTuple):
    words: list[bytes]  # the most frequent first
    states: np.ndarray  # state from zero of each word
    width: int  # how many of them the pairs are made of
    pair_states: np.ndarray  # [first word, second word], flat; of frequent pairs
    pair_buckets: np.ndarray  # -1: no frequent pair


def bucket(state: np.ndarray) -> np.ndarray:
    return (state ^ np.uint32(_START)).astype(np.int64) % BUCKETS


def word_states(part: Words, head: Head) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: its place in the head or -1, its length, and its state from zero."""
    lengths = np.diff(part.ends, prepend=0)
    at = places(part.words, pa.array(head.words, pa.large_binary()))
    state = np.empty(len(at), np.uint32)
    known = at >= 0
    state[known] = head.states[at[known]]
    tail = np.flatnonzero(~known)
    state[tail] = sums(part.data, part.ends[tail] - lengths[tail], part.ends[tail])
    return at, lengths, state


def features(part: Words, head: Head) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every feature of a slice."""
    if not len(part.text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, lengths, raw = word_states(part, head)
    single = shift(np.full(len(raw), _START, np.uint32), lengths) ^ raw
    spaced = shift(np.full(len(raw), _SPACE, np.uint32), lengths) ^ raw  # a space, then the word, from zero
    two = np.flatnonzero(part.text[1:] == part.text[:-1])
    a, b = at[two], at[two + 1]
    frequent = (a >= 0) & (b >= 0) & (a < head.width) & (b < head.width)
    code = np.where(frequent, a.astype(np.int64) * head.width + b, 0)
    frequent[frequent] = head.pair_buckets[code[frequent]] >= 0
    pair, pair_bucket = np.empty(len(two), np.uint32), np.empty(len(two), np.int64)
    pair[frequent], pair_bucket[frequent] = head.pair_states[code[frequent]], head.pair_buckets[code[frequent]]
    rest = two[~frequent]
    pair[~frequent] = shift(single[rest], lengths[rest + 1] + 1) ^ spaced[rest + 1]
    pair_bucket[~frequent] = bucket(pair[~frequent])
    three = np.flatnonzero(part.text[two] == part.text[np.minimum(two + 2, len(part.text) - 1)])
    three = three[two[three] + 2 < len(part.text)]
    third = two[three] + 2
    triple = bucket(shift(pair[three], lengths[third] + 1) ^ spaced[third])
    return (np.concatenate((bucket(single), pair_bucket, triple)),
            np.concatenate((part.text, part.text[two], part.text[two[three]])))


def _texts(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.col(text).cast("string").alias("t"))


def _frequent(counted: DataFrame, most: int) -> tuple[list[tuple], int]:
    """Rows (key, n) with at least one ``most``th of all, which are ``most`` at the highest, the most frequent first; and the sum."""
    counted = written(counted, "counts")
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    rows = counted.filter(F.col("n") * most >= total).collect()
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (-r[1], r[0])), total


def head_of(documents: DataFrame, text: str = "text") -> Head:
    """Frequent words and pairs, counted over all documents; bounded by the constants above."""
    def count_words(batches):
        for batch in batches:
            for part in slices(batch.column(0)):
                short = part.words.filter(pa.array(np.diff(part.ends, prepend=0) <= HEAD_BYTES))
                counts = pc.value_counts(short)
                yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.binary()), counts.field("counts")], ["word", "n"])

    texts = _texts(documents, text)
    counted = texts.mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found, total = _frequent(counted, HEAD_WORDS)
    words = [bytes(word) for word, _ in found]
    width = sum(n * PAIR_WORDS >= total for _, n in found)
    shared = documents.sparkSession.sparkContext.broadcast(words[:width])

    def count_pairs(batches):
        listed, total = pa.array(shared.value, pa.large_binary()), np.zeros(width * width, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                at = places(part.words, listed).astype(np.int64)
                both = (part.text[1:] == part.text[:-1]) & (at[1:] >= 0) & (at[:-1] >= 0)
                total += np.bincount(at[:-1][both] * width + at[1:][both], minlength=width * width)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    pairs = []
    if width:
        counted = texts.mapInArrow(count_pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        pairs = [code for code, _ in _frequent(counted, HEAD_PAIRS)[0]]
    return build_head(words, width, np.array(pairs, np.int64))


def build_head(words: list[bytes], width: int, pairs: np.ndarray) -> Head:
    """Tables for frequent words, and for pairs given as first * width + second."""
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    states = sums(data, ends - lengths, ends)
    first, second = np.divmod(pairs, max(1, width))
    one = shift(np.full(len(pairs), _START, np.uint32), lengths[first]) ^ states[first]
    spaced = shift(np.full(len(pairs), _SPACE, np.uint32), lengths[second]) ^ states[second]
    pair_states, pair_buckets = np.zeros(width * width, np.uint32), np.full(width * width, -1, np.int32)
    pair_states[pairs] = shift(one, lengths[second] + 1) ^ spaced
    pair_buckets[pairs] = bucket(pair_states[pairs])
    return Head(words, states, width, pair_states, pair_buckets)


def bucket_totals(rows: DataFrame, head: Head, text: str = "text") -> np.ndarray:
    """Number of features in each bucket, over all texts; one row per bucket and task is shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(head)

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                total += np.bincount(features(part, shared.value)[0], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for row in _texts(rows, text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 ln of the smoothed share in the target against the one in the documents)."""
    above = (target + 1.0) * (raw.sum() + float(BUCKETS))
    below = (raw + 1.0) * (target.sum() + float(BUCKETS))
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


def weighed(documents: DataFrame, head: Head, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight."""
    shared = documents.sparkSession.sparkContext.broadcast((head, gain.astype(float)))

    def score(batches):
        tables, gain_ = shared.value
        for batch in batches:
            for part in slices(batch.column(1)):
                held, text_ = features(part, tables)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.texts), pa.array(np.bincount(part.text, minlength=part.texts)),
                    pa.array(np.bincount(text_, minlength=part.texts)),
                    pa.array(np.bincount(text_, weights=gain_[held], minlength=part.texts).astype(np.int64)),  # sums of integers below 2**53
                ], ["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long")


def with_noise(rows: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``score``: the weight and a Gumbel variable from a digest of the id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.ln(-F.ln(share))))


def drawn(rows: DataFrame, share: int = SHARE, least: int = LEAST_WORDS) -> DataFrame:
    """Add ``rank`` (1, 2, ...) for the highest scores among rows with enough words, ties to the smaller id.

    Scores are cut into ranges of about equal numbers, whose counts say which of them lie above the
    cut; only these are sorted, each for itself. ``rows`` is read several times, so write it first.
    """
    eligible = (F.col("n_words") >= least) & F.col("score").isNotNull()
    able = rows.filter(eligible).withColumn("_falling", -F.col("score"))
    parts = RANGES * max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    points = split_points(able, "_falling", parts)
    cut = lambda df: bucketed(df, "_falling", points, "_range").withColumn("_range", F.col("_range").cast("int"))
    counts = running_before(cut(able).groupBy("_range").agg(F.count(F.lit(1)).alias("_n")), "_range", "_n", "_before").collect()  # one row per range
    most = share * sum(r["_n"] for r in counts) // 100
    starts = {r["_range"]: r["_before"] for r in counts if r["_before"] < most}
    inside = (F.col("_range") <= F.lit(max(starts, default=-1)))
    order = Window.partitionBy("_range").orderBy(F.desc("score"), "doc_id")
    start = F.element_at(F.array(*[F.lit(starts.get(i, 0)).cast("long") for i in range(max(starts, default=0) + 1)]), F.col("_range") + 1)
    high = cut(able).filter(inside).withColumn("_rank", start + F.row_number().over(order))
    high = high.select(*rows.columns, F.when(F.col("_rank") <= most, F.col("_rank")).cast("long").alias("rank"))
    low = cut(able).filter(~inside).select(*rows.columns, F.lit(None).cast("long").alias("rank"))
    rest = rows.filter(~F.coalesce(eligible, F.lit(False))).select("*", F.lit(None).cast("long").alias("rank"))
    return high.unionByName(low).unionByName(rest)


def resample(documents: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", share: int = SHARE) -> DataFrame:
    """Every document: doc_id, n_words, n_features, weight, score, rank (null unless drawn)."""
    head = head_of(documents, text)
    gain = gains(bucket_totals(documents, head, text), bucket_totals(target, head, text))
    return drawn(written(with_noise(weighed(documents, head, gain, key, text)), "weighed"), share)

