"""Secret scan: fixed patterns, and character Markov models for what they miss.

Two first-order Markov models over the characters of tokens are trained from samples of all
texts. Random strings: the values that the fixed patterns find, mixed half and half with
even letters and digits. Ordinary identifiers: the words of all texts outside the pattern spans and
undecided stretches, and, from the same counts, how words are put together in names: joined by
separators or capitals, in capitals, with numbers (``NAMED`` of every word), with a few characters
of any kind (``RARE``), so that a letter unknown to the texts is no proof.

A run of token characters outside the spans is searched for the stretches whose log-likelihood
ratio, random against ordinary, gains more than ``MARGIN`` before it falls by as much. A stretch
is widened to whole letters and digits and reported as ``random``; a part of a path beside a key that
the models do not tell from it is covered too. Length and mix of characters do
not matter beyond that. Only the fixed forms of ``ORDINARY`` (UUIDs, which are identifiers by
their form) are not scored.

Offsets are code points, end exclusive. Null texts count as empty, repeated rows are scanned each and
count each in training, an empty table gives an empty one. Of further columns, one named like the
result is replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.common import text_bytes

#: The fixed patterns; on UTF-8 bytes they match as on characters, all sets being ASCII.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

KINDS = ("assign", "access", "hex", "random")
ALPHABET = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET)
CODE = np.full(256, SIZE, dtype=np.int64)
CODE[list(ALPHABET)] = np.arange(SIZE)
HEX = np.zeros(256, dtype=bool)
HEX[list(b"0123456789abcdef")] = True
ORDINARY = re.compile(rb"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
#: Stretches with a gain beyond this are random.
MARGIN = 20.0
#: How often words stand in names, for each of their places as a word of its own.
NAMED = 0.2
#: Share of characters of any kind in ordinary identifiers.
RARE = 0.01
ALNUM = np.zeros(SIZE + 1, dtype=bool)
ALNUM[:62] = True
LOWER, UPPER, DIGITS, JOINS = slice(0, 26), slice(26, 52), slice(52, 62), slice(62, SIZE)


def runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of true values, at least ``least`` long."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def base_spans(raw: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Byte spans of the fixed patterns: start, kind number, end, start of the value."""
    data, found = raw.tobytes(), []
    small = data.lower()
    if any(word in small for word in KEYWORDS):
        found += [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(data) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if b"AKIA" in data:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(data) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(s, 2, e, s) for s, e in runs(HEX[raw], HEX_LEAST)]
    return sorted(found)


def free_codes(raw: np.ndarray, spans: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Character codes of a text; ``SIZE`` for all that is no token character, lies in a span or has an ordinary form."""
    code = CODE[raw]
    for start, _, end, _ in spans:
        code[start:end] = SIZE
    if np.count_nonzero(raw == 45) >= 4:
        for m in ORDINARY.finditer(raw.tobytes()):
            code[m.start():m.end()] = SIZE
    return code


def pair_counts(raw: np.ndarray, spans: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Character pairs of one text, in random strings and elsewhere; code ``SIZE`` stands for the border of a run."""
    code, wide = CODE[raw], SIZE + 1
    inside = np.zeros(len(raw) + 1, dtype=bool)
    for _, _, end, value in spans:
        inside[value + 1:end] = True
    pair = np.concatenate(([SIZE], code)) * wide + np.concatenate((code, [SIZE]))
    random = np.bincount(pair[inside], minlength=wide * wide)
    code = free_codes(raw, spans)
    # Long mixed runs may be random or not: they are left to the models.
    mixed = ALNUM[code]
    for start, end in runs(mixed, 16):
        digits = np.count_nonzero(code[start:end] >= 52)
        if 0 < digits < end - start:
            code[start:end] = SIZE
    pair = np.concatenate(([SIZE], code)) * wide + np.concatenate((code, [SIZE]))
    return np.stack([random, np.bincount(pair, minlength=wide * wide)])


def train(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every character pair, from the counts over all texts.

    Each task sends one row per pair and class that occurs; the sums are at most
    2 * 68 * 68 rows.
    """
    wide = SIZE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, wide * wide), dtype=np.int64)
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                if len(raw):
                    total += pair_counts(raw, base_spans(raw))
        label, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(pair), pa.array(total[label, pair])], ["label", "pair", "n"])

    sums = df.select(text).mapInArrow(run, "label long, pair long, n long").groupBy("label", "pair").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, wide, wide))
    for row in sums.collect():
        counts[row["label"]].flat[row["pair"]] = row["n"]
    return ratio_of(counts[0, :SIZE, :SIZE], named(counts[1])[:SIZE, :SIZE])


def named(words: np.ndarray) -> np.ndarray:
    """Counts of ordinary identifiers: the words' own, and those of their joins in names."""
    first, last = words[SIZE, :SIZE].copy(), words[:SIZE, SIZE].copy()
    # Without texts every word begins and ends evenly with a small letter.
    first[LOWER] += 1
    last[LOWER] += 1
    total, joins = last.sum(), SIZE - 62
    out = words.copy()
    small = words[LOWER, LOWER]
    out[UPPER, UPPER] += NAMED * small
    out[UPPER, LOWER] += NAMED * small
    out[LOWER, UPPER] += NAMED * np.outer(last[LOWER], first[LOWER]) / total
    for side in (LOWER, UPPER):
        out[side, JOINS] += NAMED * last[LOWER][:, None] / joins
        out[JOINS, side] += NAMED * first[LOWER][None, :] / joins
        out[side, DIGITS] += NAMED * last[LOWER][:, None] / 30
        out[DIGITS, side] += NAMED * first[LOWER][None, :] / 30
    out[DIGITS, DIGITS] += NAMED * total / 100
    out[DIGITS, JOINS] += NAMED * total / (20 * joins)
    out[JOINS, DIGITS] += NAMED * total / (10 * joins)
    out[JOINS, JOINS] += NAMED * total * np.eye(joins)
    return out


def ratio_of(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios of the character pairs; both tables are smoothed towards their characters' shares."""
    chance = []
    for table in (random, ordinary):
        share = (table.sum(0) + 1) / (table.sum() + SIZE)
        chance.append((table + 20 * share) / (table.sum(1, keepdims=True) + 20))
    even = np.where(np.arange(SIZE) < 62, 0.98 / 62, 0.02 / (SIZE - 62))
    return np.log(0.5 * chance[0] + 0.5 * even) - np.log((1 - RARE) * chance[1] + RARE * even)


def random_spans(raw: np.ndarray, spans: list[tuple[int, int, int, int]], ratio: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Stretches outside the given spans that the random model explains better."""
    code = free_codes(raw, spans)
    if len(code) < 2:
        return []
    wide = np.zeros((SIZE + 1, SIZE + 1))
    wide[:SIZE, :SIZE] = ratio
    gain = wide[code[:-1], code[1:]]
    sums = np.concatenate(([0.0], np.cumsum(np.maximum(gain, 0))))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], code < SIZE, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    # A run without MARGIN of gains in all has no such stretch.
    able = sums[ends - 1] - sums[starts] > MARGIN
    found: list[tuple[int, int, int, int]] = []
    for start, end in zip(starts[able].tolist(), ends[able].tolist()):
        for low, high in stretches(gain[start:end - 1]):
            low, high = low + start, high + start + 1
            while low > start and ALNUM[code[low - 1]] and ALNUM[code[low]]:
                low -= 1
            while high < end and ALNUM[code[high]] and ALNUM[code[high - 1]]:
                high += 1
            if found and low <= found[-1][2]:
                low, high = found[-1][0], max(high, found[-1][2])
                found.pop()
            found.append((low, 3, high, low))
    return found


def stretches(gain: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that gain more than ``MARGIN`` before they fall by as much, each from its lowest to its highest sum, in one pass."""
    found = []
    total = best = 0.0
    begin = peak = 0
    for i, g in enumerate(gain.tolist()):
        total += g
        if total > best:
            best, peak = total, i + 1
        if total <= 0 or best - total > MARGIN:
            if best > MARGIN:
                found.append((begin, peak))
            total = best = 0.0
            begin = i + 1
    if best > MARGIN:
        found.append((begin, peak))
    return found


def _points(data: bytes, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in code points, by start and kind."""
    cuts = sorted({s[0] for s in spans} | {s[2] for s in spans})
    at, last, place = 0, 0, {}
    for cut in cuts:
        at += len(data[last:cut].decode())
        place[cut], last = at, cut
    return sorted((place[start], kind, place[end]) for start, kind, end, _ in spans)


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def scan(df: DataFrame, ratio: np.ndarray, text: str = "text", keep: list[str] | None = None, out: str = "secrets") -> DataFrame:
    """Columns ``keep`` (all by default) and the spans found, by start and kind."""
    keep = [c for c in df.columns if c != out] if keep is None else keep
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in text_bytes(batch.column(text)):
                spans = base_spans(raw)
                spans += random_spans(raw, spans, ratio)
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in _points(raw.tobytes(), spans)] if spans else [])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, kind)], [*keep, out])

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, SPAN)])
    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", secrets: str = "secrets", mark: str = "[SECRET]") -> DataFrame:
    """The text with every span replaced; overlapping spans become one mark."""
    step = F.aggregate(
        F.coalesce(F.col(secrets), F.array()),
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.struct(
            F.when(s["start"] >= a["at"], F.concat(
                a["done"], F.substring(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)))
            .otherwise(a["done"]).alias("done"),
            F.greatest(a["at"], s["end"]).alias("at")),
        lambda a: F.concat(a["done"], F.substring(F.col(text), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return df.withColumn(text, F.when(F.size(secrets) > 0, step).otherwise(F.col(text)))


def joined(secrets: str = "secrets", base_only: bool = False):
    """Spans as kind:start:end, comma-joined."""
    spans = F.col(secrets)
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"] != "random")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(kind: str, secrets: str = "secrets"):
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
