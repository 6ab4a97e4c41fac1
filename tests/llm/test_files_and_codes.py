"""Token files, WARC bundles and piece codes: exact round trips and the libraries' results."""

import base64
import hashlib
import io
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from pyspark.sql import types as T
from tokenizers import Tokenizer

from dossier.llm import piece_codec, token_codes, warc_bundles

LETTERS = [*"abcdeEÉéñÑßÿ  \n\t'.,!?|#0123漢字\x00", "'s", "<|endoftext|>", "<s>", "́", "İ", "Σ", "\x1c", "\xa0", "▁▁", "🎉", "the", " The", "ing"]


def texts(seed, number, longest=50):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(longest))) for _ in range(number)]


EDGES = [None, "", " ", "\n\n", "x" * 5000, "word " * 20000, "same", "same"]


def test_codes_are_directly_addressable():
    rng = np.random.default_rng(1)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1], rng.integers(0, 49408, 3000), rng.integers(0, 200, 700), [7] * 1024):
        ids = np.array(ids, dtype=np.uint32)
        codes = token_codes.Codes(token_codes.pack_codes(ids))
        assert len(codes) == len(ids)
        assert [codes.get(i) for i in range(0, len(ids), 7)] == ids[::7].tolist()
        for start, end in ((0, len(ids)), (3, 3), (5, 600), (511, 513)):
            end = min(end, len(ids))
            start = min(start, end)
            assert codes.slice(start, end).tolist() == ids[start:end].tolist()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_tokenizer_cache_is_exact(name, monkeypatch):
    monkeypatch.setattr(token_codes, "CACHE_ROWS", 300)
    path = public_tokenizers.path(name)
    library, cached = Tokenizer.from_file(path), token_codes.PartTokenizer(path)
    assert cached.cuts == (name == "word_bpe_49k.json")
    words = ["Hello, World!", "  two  words ", 'don\'t "stop" (now).', "ÀÉÎ straße Æther", "x" * 200, "\x1cab c\x1f", "12,345.67", "<|endoftext|>", ".,;"]
    for seed in range(4):
        some = texts(seed, 200) + words + [None, ""]
        ids, sizes = cached.encode(pa.array(some))
        ends = np.cumsum(sizes)
        for text, end, size in zip(some, ends, sizes):
            assert ids[end - size:end].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert [len(x) for x in cached.encode(pa.array([], pa.string()))] == [0, 0]


def test_every_code_point_between_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    cached = token_codes.PartTokenizer(path)
    chars = [chr(c) for c in range(0x3100) if not 0xd800 <= c < 0xe000]
    for form in ("a%sb", "Ab.%s", "x %sy"):
        some = [form % c for c in chars]
        ids, sizes = cached.encode(pa.array(some))
        ends = np.cumsum(sizes)
        for text, end, size, want in zip(some, ends, sizes, cached.library.encode_batch_fast(some, add_special_tokens=False)):
            assert ids[end - size:end].tolist() == want.ids, text


def test_other_vocabulary_in_files(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    values = EDGES + texts(5, 20)
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    rows = token_codes.read_ids(token_codes.write_ids(df, path, end_id=2, parts=2)).collect()
    assert len(rows) == len(values)
    for row in rows:
        want = np.array([*library.encode(values[row["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert bytes(row["ids"]) == want.tobytes()


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_codes, "SHARD_IDS", 500)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    values = EDGES + texts(9, 60)
    rows = [(1000 - 7 * i, t, "x") for i, t in enumerate(values)] + [(None, "no key", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    manifest = token_codes.write_ids(df, path, end_id=2, parts=3)
    got = {r["doc_id"]: r for r in token_codes.read_ids(manifest).collect()}
    start = 0
    for key, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        row = got.pop(key)
        assert (row["start"], row["n_tokens"], bytes(row["ids"])) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert not got and manifest.agg({"n_tokens": "sum"}).head()[0] == start
    empty = token_codes.write_ids(spark.createDataFrame([], "doc_id long, text string"), path, end_id=2)
    assert token_codes.read_ids(empty).collect() == []


def test_token_file_query_has_crc(spark):
    from dossier.llm.queries import QUERIES
    rows = QUERIES["op3_token_codes"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for row in rows[::20]:
        ids = np.array([*library.encode(docs[row["doc_id"]], add_special_tokens=False).ids, 2], dtype="<u4")
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_bundle_is_seekable_and_plain_zstandard():
    writer = warc_bundles.BundleWriter()
    bodies = [bytes([65 + i % 26]) * (i * 997 % 90_000) for i in range(40)]
    names = []
    for i, body in enumerate(bodies):
        digest = warc_bundles.payload_digest(body)
        names.append(warc_bundles.record_id(i, digest))
        writer.add(names[-1], warc_bundles.make_record(i, f"http://x/\r\n{i}", body, digest, None))
    raw = writer.bytes()
    reader = warc_bundles.BundleReader(raw)
    assert len(reader.starts) > 2
    for i in (39, 0, 17, 17):
        record = reader.find(names[i])
        assert record["payload"] == bodies[i] and record["fields"]["X-Page-ID"] == str(i)
    assert reader.find("<urn:none>") is None
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain.count(b"WARC/1.1\r\n") == 40
    assert warc_bundles.BundleReader(warc_bundles.BundleWriter().bytes()).index == []


def test_bundles(spark, monkeypatch):
    monkeypatch.setattr(warc_bundles, "BUNDLE_BYTES", 20_000)
    rows = [(i, f"http://h/{i}", f"<p>{'é' * (i % 5)}</p>", 1) for i in range(40)]
    rows += [(100, None, None, 1), (101, "http://h/e", "", 1), (102, "u", "z" * 100_000, 1), (None, "u", "<p></p>", 1), (None, "u", "only", 1), (7, "http://h/7", "<p>éé</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, path int")
    folder = warc_bundles.write_bundles(df)
    got = warc_bundles.read_bundles(spark.read.parquet(f"{folder}-manifest"), folder).collect()
    last = {}
    for key, _, page, _ in rows:
        if key is not None:
            last[page or ""] = max(key, last.get(page or "", -1))
    want = []
    for key, url, page, _ in rows:
        data = (page or "").encode()
        answer = last.get(page or "")
        response = answer is None or key == answer
        want.append((key, url or "", len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                     "response" if response else "revisit", None if response else answer, data if response else None))
    assert sorted([tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got], key=str) == sorted(want, key=str)
    large = warc_bundles.write_bundles(df, least_bytes=10)
    kinds = {r["record_type"] for r in warc_bundles.read_bundles(spark.read.parquet(f"{large}-manifest"), large).collect() if r["payload_bytes"] < 10}
    assert kinds == {"response"}
    none = warc_bundles.write_bundles(df.limit(0))
    assert warc_bundles.read_bundles(spark.read.parquet(f"{none}-manifest"), none).collect() == []


@pytest.fixture(scope="module")
def pieces():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, piece_codec.PieceCodec(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_pieces_equal_the_library(pieces):
    _, codec, library = pieces
    for text in [*texts(5, 3000), *EDGES[1:], "  a  b ", "▁a▁ b", " \n x", "aaaaaaaaaaaaaaaaaaaa" * 20]:
        packed = codec.encode(text)
        ids = np.frombuffer(packed, "<u4").tolist()
        assert ids == [1, *library.encode(text), 2], text
        assert codec.decode(packed) == library.decode(ids), text


def test_compatibility_equals_merging(pieces):
    _, codec, _ = pieces
    rng = random.Random(2)
    ids = list(codec.ids.values())
    for _ in range(5000):
        a, b = rng.choice(ids[:3000]), rng.choice(ids[:3000])
        if codec.merged(codec.pieces[a]) == [codec.pieces[a]] and codec.merged(codec.pieces[b]) == [codec.pieces[b]]:
            assert codec.compatible(a, b) == (codec.merged(codec.pieces[a] + codec.pieces[b]) == [codec.pieces[a], codec.pieces[b]])


def test_piece_frames(spark, pieces):
    path, _, library = pieces
    df = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(EDGES)], "doc_id long, text string, ids binary")
    got = piece_codec.decode(piece_codec.encode(df, path), path).orderBy("doc_id").collect()
    assert got[0].asDict().keys() == {"doc_id", "ids", "decoded"}
    for row, text in zip(got, EDGES):
        assert np.frombuffer(row["ids"], "<u4").tolist() == [1, *library.encode(text or ""), 2]
        assert row["decoded"] == (text or "")
    assert piece_codec.encode(df.limit(0), path).collect() == []
    nulls = spark.createDataFrame([(None,)], "ids binary")
    assert piece_codec.decode(nulls, path).head()["decoded"] is None


MEMORY = """
import os, random
from pathlib import Path
import public_tokenizers
from dossier.llm import piece_codec

def used():
    return int(Path("/proc/self/statm").read_text().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

codec = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
rng, least, most = random.Random(3), used(), 0
for _ in range(200):
    codec.encode(" ".join("%x" % rng.getrandbits(40) for _ in range(1000)))
    most = max(most, used())
codec.forget()
print(most - least, used() - least)
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_piece_codec_returns_its_memory():
    done = subprocess.run([sys.executable, "-c", MEMORY], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    most, after = map(float, done.stdout.split())
    assert most < 80 and after < 12, done.stdout


def test_slices_are_bounded_by_rows_and_bytes():
    for values in ([], [None], ["é"], ["x" * (1 << 21)], ["x" * 400_000, None, "", "y" * 700_000, "z"] * 3, ["ab"] * 1200, [b"x" * 5000] * 700):
        column = pa.array(values, pa.binary() if values and isinstance(values[0], bytes) else pa.string())
        got = list(piece_codec.slices(column))
        assert [x for at, n in got for x in column.slice(at, n).to_pylist()] == values
        for at, n in got:
            assert n == 1 or 1 < n <= 512 and column.slice(at, n).nbytes <= (1 << 20) + 4 * (n + 1) + n


def test_words_are_kept_while_a_text_turns_the_cache_over(pieces, monkeypatch):
    path, _, library = pieces
    monkeypatch.setattr(piece_codec, "CACHE_ROWS", 50)
    codec, seen = piece_codec.PieceCodec(path), []
    segment = codec.segment
    monkeypatch.setattr(codec, "segment", lambda text: seen.append(text) or segment(text))
    text = " ".join([*(f"w{i}" for i in range(60)), *["again"] * 100])
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == [1, *library.encode(text), 2]
    assert seen.count("▁again") == 1


def test_new_words_of_a_slice_are_walked_together(pieces, monkeypatch):
    path, _, library = pieces
    codec, alone = piece_codec.PieceCodec(path), []
    segment = codec.segment
    monkeypatch.setattr(codec, "segment", lambda text: alone.append(text) or segment(text))
    rng = random.Random(8)
    slice_ = [" ".join("".join(rng.choices("aeinorstTh,.%", k=rng.randrange(1, 40))) + rng.choice(["", "\nThe"]) for _ in range(200)) for _ in range(20)]
    frames = []
    monkeypatch.setattr(piece_codec, "codec", lambda _: codec)

    class Frame:
        columns, schema = ["doc_id", "text"], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        select = lambda self, *_: self

        def mapInArrow(self, run, _):
            frames.extend(run(iter([pa.RecordBatch.from_pydict({"doc_id": [*range(20)], "text": slice_})])))

    piece_codec.encode(Frame(), path)
    assert not alone
    for packed, text in zip(frames[0].column("ids").to_pylist(), slice_):
        assert np.frombuffer(packed, "<u4").tolist() == [1, *library.encode(text), 2], text


@pytest.mark.parametrize("rows, pairs, words", [(98_304, 262_144, 32_768), (50, 97, 7)])
def test_slices_equal_the_library(pieces, monkeypatch, rows, pairs, words):
    path, _, library = pieces
    for name, value in (("CACHE_ROWS", rows), ("PAIR_ROWS", pairs), ("WALK_WORDS", words)):
        monkeypatch.setattr(piece_codec, name, value)
    codec = piece_codec.PieceCodec(path)
    rng = random.Random(9)
    many = [*texts(10, 600), *EDGES[1:], "  a  b ", "▁a▁ b", " \n x", "a" * 64, "a" * 65, "b\n" + "the" * 22, "\x00 \x00a a\x00",
            *("".join(rng.choices(sorted(codec.letters), k=rng.randrange(1, 90))) for _ in range(600))]
    for at in (0, 100, 700):
        for text, packed in zip(many[at:], codec.encode_all(many[at:])):
            assert np.frombuffer(packed, "<u4").tolist() == [1, *library.encode(text), 2], text
        codec.forget()
    assert codec.encode_all([]) == []


def test_compatibility_of_many_equals_merging(pieces):
    _, codec, _ = pieces
    rng = random.Random(11)
    ids = [i for _, (i, _) in codec.tree.items()]
    odd = [i for i in ids if codec.halves[i] is None]
    left, right = (np.array([*rng.choices(ids, k=4000), *rng.choices(odd or ids, k=50), *rng.choices(ids, k=50)]) for _ in range(2))
    walks = piece_codec.Walks(codec)
    for _ in range(2):  # new pairs, then remembered ones
        for a, b, fit in zip(left.tolist(), right.tolist(), walks.fits(left, right).tolist()):
            assert fit == (codec.merged(codec.pieces[a] + codec.pieces[b]) == [codec.pieces[a], codec.pieces[b]])
