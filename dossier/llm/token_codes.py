"""Token-id files with directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds the lowest
chunk of every id; a bit of its continuation bitmap says whether the id goes on in the
next level, which holds only those ids. A rank directory gives the number of set bits
before every block of 512 places, so the place of an id in the next level is one
addition and one count of at most 512 bits. Any id is read by one step per level,
without decoding its neighbours.

A shard is one file: header, document ids and lengths, then per level the chunks, the
bitmap and the directory. Shards follow each other in ascending doc_id order. They are
written under a name that depends on the shard alone, and renamed when complete, so a
repeated task replaces a file by an equal one.

Null texts count as empty. A null doc_id sorts first and is kept. Repeated rows are
kept, each as a document of its own. An empty table has no files and an empty result. Further
columns are not read, whatever their names. Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dossier.llm.common import work_dir, write_file

MAGIC = b"DACIDS01"
CHUNK_BITS = 8
BLOCK = 512
CACHE_ROWS = 500_000
CHUNK_BYTES = 4 << 20
#: A shard is closed after this many ids, so files stay below about 40 MB.
SHARD_IDS = 16_000_000
#: Letters that have one small form and are never part of a combination, and marks that are no apostrophe.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00de\u00df-\u00f6\u00f8-\u00ff]+")
MARKS = '.,;:!?|#$%&*()"'
#: A word of such letters and marks.
SHAPE = "^(?P<core>" + LETTERS.pattern + ")(?P<mark>[" + re.escape(MARKS) + "]*)$"
#: Steps of a tokenizer file whose texts may be cut at white space, as such a file states them.
CUTTABLE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
_SPACE = re.compile(r"\s")
_ODD_SPACE = "[\x1c-\x1f]"
_bits_of = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint32)


def pack_codes(ids: np.ndarray) -> bytes:
    """Levels of a sequence of ids below 2**32."""
    rest = np.ascontiguousarray(ids, dtype=np.uint32)
    levels = []
    while True:
        chunk = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        more = rest >> np.uint32(CHUNK_BITS)
        on = more > 0
        bitmap = np.packbits(on, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (BLOCK // 8), np.uint8)])
        per_block = _bits_of[bitmap].reshape(-1, BLOCK // 8).sum(1)
        ranks = np.concatenate([[0], np.cumsum(per_block)]).astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + chunk.tobytes() + bitmap.tobytes() + ranks.tobytes())
        if not on.any():
            break
        rest = more[on]
    return struct.pack("<B", len(levels)) + b"".join(levels)


class Codes:
    """Reader of the levels; nothing is decoded until asked for."""

    def __init__(self, raw: memoryview | bytes):
        (count,) = struct.unpack_from("<B", raw, 0)
        at, self.levels = 1, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", raw, at)
            blocks = -(-n // BLOCK)
            chunk = np.frombuffer(raw, np.uint8, n, at + 8)
            bitmap = np.frombuffer(raw, np.uint8, blocks * (BLOCK // 8), at + 8 + n)
            ranks = np.frombuffer(raw, "<u4", blocks + 1, at + 8 + n + len(bitmap))
            at += 8 + n + len(bitmap) + 4 * (blocks + 1)
            self.levels.append((chunk, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, place: int) -> int:
        """Set bits before a place."""
        _, bitmap, ranks = self.levels[level]
        block = place // BLOCK
        first, byte = block * (BLOCK // 8), place // 8
        last = int(bitmap[byte]) & ((1 << place % 8) - 1) if place % 8 else 0
        return int(ranks[block]) + int(_bits_of[bitmap[first:byte]].sum()) + last.bit_count()

    def get(self, place: int) -> int:
        """One id."""
        value = 0
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            value |= int(chunk[place]) << (CHUNK_BITS * level)
            if not bitmap[place // 8] >> (place % 8) & 1:
                return value
            place = self._rank(level, place)
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """Ids of a range: each level contributes one contiguous range."""
        out = np.zeros(end - start, np.uint32)
        where = np.arange(end - start)
        for level, (chunk, bitmap, _) in enumerate(self.levels):
            out[where] |= chunk[start:end].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            if start == end or level + 1 == len(self.levels):
                break
            first = start // 8
            on = np.unpackbits(bitmap[first:-(-end // 8)], bitorder="little")[start - 8 * first:end - 8 * first]
            start = self._rank(level, start)
            where = where[on.astype(bool)]
            end = start + len(where)
        return out


def pack_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    docs = np.array([d or 0 for d in doc_ids], dtype="<i8")
    return b"".join([MAGIC, struct.pack("<Q", len(docs)), docs.tobytes(), known.tobytes(),
                     np.array(lengths, dtype="<u8").tobytes(), pack_codes(ids)])


class Shard:
    """Reader of one file."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token-id file")
        (n,) = struct.unpack_from("<Q", raw, 8)
        known = np.frombuffer(raw, np.uint8, n, 16 + 8 * n)
        docs = np.frombuffer(raw, "<i8", n, 16)
        self.doc_ids = [int(d) if k else None for d, k in zip(docs, known)]
        self.lengths = np.frombuffer(raw, "<u8", n, 16 + 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.codes = Codes(memoryview(raw)[16 + 17 * n:])

    def document(self, i: int) -> np.ndarray:
        return self.codes.slice(int(self.starts[i]), int(self.starts[i + 1]))


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of the values, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def cuts_at_spaces(config: dict) -> bool:
    """Whether a tokenizer file is of the kind whose texts may be cut at white space.

    Its steps must be the ones of ``CUTTABLE``, which drop white space, ignore case and never join letters with what
    follows them, and its added tokens must hold a character that is no letter, mark or white space.
    """
    model = config["model"]
    plain = model.get("type") == "BPE" and not model.get("dropout") and model.get("end_of_word_suffix") == "</w>"
    added = [t["content"] for t in config.get("added_tokens", [])]
    own = all(not _SPACE.search(t) and LETTERS.sub("", t).strip(MARKS) for t in added)
    return plain and own and {k: config.get(k) for k in CUTTABLE} == CUTTABLE


class PartTokenizer:
    """Ids by the tokenizers library, with the ids of parts of words remembered.

    Where the tokenizer file allows it (``cuts_at_spaces``), texts are cut at white space, and only the distinct words
    of a chunk of texts are looked at: one of common letters and trailing marks has the ids of its small letters and
    of its marks. New letter parts are encoded many at a time as one text, which the ids that end a word cut again.
    Texts with one of the four separators that Python and the library treat differently, and all texts of other
    tokenizer files, are encoded whole. When the cache is full, its older half goes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.cuts = cuts_at_spaces(config)
        if self.cuts:
            vocabulary = config["model"]["vocab"]
            self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
            self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.slots: dict[str, int] = {}
        self.ids, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and their number by text."""
        ids = [np.array(c.ids, np.uint32) for c in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(i) for i in ids], np.int64)

    def _letters(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts of letters, as one text."""
        ids = np.array(self.library.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):  # a letter without an id of its own
            return self._whole(parts)
        return ids, np.diff(ends, prepend=0)

    def _find(self, parts: list[str], letters: bool) -> np.ndarray:
        """The slot of each part; new ones are encoded."""
        new = [p for p in parts if p not in self.slots]
        ids, sizes = [self.ids], [np.diff(self.starts)]
        for at in range(0, len(new), 2048):
            some = new[at:at + 2048]
            found, counts = (self._letters if letters else self._whole)(some)
            self.slots.update(zip(some, range(len(self.slots), len(self.slots) + len(some))))
            ids.append(found), sizes.append(counts)
        if new:
            self.ids, self.starts = np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return np.fromiter(map(self.slots.__getitem__, parts), np.int64, len(parts))

    def _trim(self) -> None:
        cut = len(self.slots) // 2
        if len(self.slots) > CACHE_ROWS or len(self.ids) > 8 * CACHE_ROWS:
            self.slots = {part: slot - cut for part, slot in islice(self.slots.items(), cut, None)}
            self.ids, self.starts = self.ids[self.starts[cut]:].copy(), self.starts[cut:] - self.starts[cut]

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same as ``_whole`` by the words of the texts."""
        self._trim()
        lists = pc.utf8_split_whitespace(texts)
        coded = lists.values.dictionary_encode()
        distinct, at = coded.dictionary, coded.indices.to_numpy()
        shape = pc.extract_regex(distinct, SHAPE)
        cut = shape.is_valid().to_numpy(zero_copy_only=False)
        rest, marks = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        shape = shape.drop_null()
        for name, into in (("core", rest), ("mark", marks)):
            part = (pc.utf8_lower(shape.field(name)) if name == "core" else shape.field(name)).dictionary_encode()
            into[cut] = self._find(part.dictionary.to_pylist(), name == "core")[part.indices.to_numpy()]
        rest[~cut] = self._find(distinct.filter(pa.array(~cut)).to_pylist(), False)
        marks[~cut] = self._find([""], False)[0]
        both = np.stack([rest, marks], axis=1).ravel()
        sizes = np.diff(self.starts)[both]
        ids = _gather(self.ids, self.starts[both], sizes)
        sizes = sizes.reshape(-1, 2).sum(1)
        places, sizes = (np.cumsum(sizes) - sizes)[at], sizes[at]
        before = np.concatenate([[0], np.cumsum(sizes)])[lists.offsets.to_numpy()]
        return _gather(ids, places, sizes), np.diff(before)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, and their number by text. Null counts as empty."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _ODD_SPACE).to_pylist() if self.cuts else [True] * len(texts)
        found, at = [(np.empty(0, np.uint32), np.empty(0, np.int64))], 0
        for odd, rows in groupby(whole):
            some = texts.slice(at, sum(1 for _ in rows))
            at += len(some)
            found.append(self._whole(some.to_pylist()) if odd else self._cut(some))
        return np.concatenate([ids for ids, _ in found]), np.concatenate([sizes for _, sizes in found])


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES`` of text; one longer text is a range of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > CHUNK_BYTES:
            yield start, row
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


_tokenizers: dict[str, PartTokenizer] = {}


def tokenizer(path: str) -> PartTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = PartTokenizer(path)
    return _tokenizers[path]


def write_ids(df: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None,
              text: str = "text", key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Encode the texts, append ``end_id`` to each and write them as shards in key order.

    Returns the manifest, one small row per file: shard (number in key order), path,
    n_docs, n_tokens. The texts are dealt into key ranges once; ranges and files are
    numbered in key order. Reading the manifest again does not write again.
    """
    spark = df.sparkSession
    folder = folder or work_dir(spark, "ids")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        docs: list[int | None] = []
        lengths: list[int] = []
        pieces: list[np.ndarray] = []
        files = total = 0

        def close() -> pa.RecordBatch:
            nonlocal files, total
            path = f"{folder}/shard-{task:06d}-{files:06d}.dac"
            ids = np.concatenate(pieces)
            pieces.clear()
            write_file(path, pack_shard(docs, lengths, ids))
            row = pa.RecordBatch.from_pydict(
                {"shard": [task * 10**6 + files], "path": [path], "n_docs": [len(docs)], "n_tokens": [total]})
            docs.clear(), lengths.clear()
            files, total = files + 1, 0
            return row

        for batch in batches:
            for first, past in _chunks(batch.column(1)):
                ids, sizes = tokenizer(tokenizer_path).encode(batch.column(1).slice(first, past - first))
                docs.extend(batch.column(0).slice(first, past - first).to_pylist())
                lengths.extend((sizes + 1).tolist())
                pieces.append(np.insert(ids, np.cumsum(sizes), np.uint32(end_id)))
                total += len(pieces[-1])
                if total >= SHARD_IDS:
                    yield close()
        if docs:
            yield close()

    ranged = df.select(F.col(key).cast("long").alias(key), text).repartitionByRange(parts, key).sortWithinPartitions(key)
    done = ranged.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long")
    manifest = f"{folder}-manifest"
    done.write.parquet(manifest)
    return spark.read.schema(done.schema).parquet(manifest)


def read_ids(manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of the files: key, start (ids of all documents before), n_tokens, ids (packed).

    Only the totals of the files, a few numbers each, are added up in one place.
    """
    spark = manifest.sparkSession
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first"))
    paths = manifest.select("path").head(1)
    if not paths:
        return spark.createDataFrame([], f"{key} long, start long, n_tokens long, ids binary")
    folder = paths[0]["path"].rsplit("/", 1)[0]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.dac").load(folder)
    number = F.regexp_extract("path", r"shard-(\d+)-(\d+)\.dac$", 1).cast("long") * 10**6 + F.regexp_extract(
        "path", r"shard-(\d+)-(\d+)\.dac$", 2).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = Shard(content.as_py())
                for at in range(0, len(file.doc_ids), 256):
                    some = range(at, min(at + 256, len(file.doc_ids)))
                    # One read for the documents' whole range, which is then cut.
                    first = int(file.starts[at])
                    ids = file.codes.slice(first, int(file.starts[some.stop])).astype("<u4").tobytes()
                    cuts = ((file.starts[at:some.stop + 1] - first) * 4).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * len(some), pa.int64()), pa.array([file.doc_ids[i] for i in some], pa.int64()),
                         pa.array(file.starts[some.start:some.stop]), pa.array(file.lengths[some.start:some.stop]),
                         pa.array([ids[x:y] for x, y in zip(cuts, cuts[1:])], pa.binary())],
                        ["shard", key, "local", "n_tokens", "ids"])

    rows = files.select(number.alias("shard"), "content").mapInArrow(
        run, f"shard long, {key} long, local long, n_tokens long, ids binary")
    return rows.join(starts, "shard").select(key, (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids")


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
