"""SentencePiece encoding and decoding: exact merge order found by backtracking.

The vocabulary is a byte-pair model whose pieces carry merge priorities. Instead of
merging, the encoder walks the text from the left. An Aho-Corasick automaton gives all
pieces that match at a place; the longest is tried first. A piece may follow another
only if merging their joined characters gives back exactly these two pieces. The
encoding of every prefix is unique, so a place from which no piece fits is marked in a
bitfield and never visited again. A sequence whose neighbours are all compatible is the
one that merging would produce.

Pieces never contain a word mark after another character, so merges cannot cross the
border before a word mark. The text is cut there and the results per piece of text are
cached, in a bounded table. Characters without a piece become their UTF-8 bytes.

The new words of a slice of rows are walked together, in numpy arrays: each step tries one
piece in every word that is not yet done. Long words and those with characters without a
piece are walked alone.

A Python worker holds a vocabulary, these tables and the results of one slice of rows, whatever the size of the
texts' table. At the end of a task the tables are emptied and free memory goes back to the system.

Null texts count as empty. Empty texts have the begin and end ids only.
"""

from __future__ import annotations

import ctypes
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
#: Words, lines and pairs of pieces that are remembered. Workers that encode and decode 0.1 GB peak at 195 MB in all.
CACHE_ROWS = 98_304
PAIR_ROWS = 262_144
#: Characters of a word that is remembered or walked together with others, and words that are walked together.
WORD_CHARS = 64
WALK_WORDS = 32_768
#: Rows whose results go out together, and bytes of the values they are made from.
SLICE_ROWS = 512
SLICE_BYTES = 1 << 20


class Numbers:
    """A fixed table of whole numbers below 2**24 by keys below 2**39, for arrays of keys; -1 where a key has none."""

    def __init__(self, table: dict[int, int]):
        keys, values = (np.fromiter(x, np.int64, len(table)) for x in (table.keys(), table.values()))
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.rows = np.full(1 << bits, -1, np.int64)
        place = self.place(keys)
        while len(keys):
            free = self.rows[place] < 0
            self.rows[place[free]] = keys[free] << 24 | values[free]
            rest = self.rows[place] >> 24 != keys
            keys, values, place = keys[rest], values[rest], place[rest] + 1 & self.last

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        place = self.place(keys)
        rows = self.rows[place]
        other = rows >> 24 != keys
        left = np.flatnonzero(other & (rows >= 0))
        rows &= 0xFFFFFF
        rows[other] = -1
        while len(left):
            place[left] = at = place[left] + 1 & self.last
            there = self.rows[at]
            same = there >> 24 == keys[left]
            rows[left[same]] = there[same] & 0xFFFFFF
            left = left[~same & (there >= 0)]
        return rows


class Walks:
    """Walks of many words at once, with the pieces of one codec; all letters of the words need a piece."""

    def __init__(self, known: PieceCodec):
        self.known, self.size = known, len(known.pieces)
        letters = {c: n for n, c in enumerate(sorted(known.letters), 1)}
        self.letter = np.zeros(0x110000, np.min_scalar_type(len(letters)))
        self.letter[[*map(ord, letters)]] = [*letters.values()]
        self.width = len(letters) + 1
        self.level = np.array(known.level)
        self.usual = np.array([h is not None for h in known.halves])
        self.halves = np.array([h or (0, 0) for h in known.halves])
        # Steps from a beginning of pieces by a letter to a longer one, and the longest piece that a beginning starts with
        nodes, steps, longest = {"": 0}, {}, [-1]
        self.length, self.shorter = np.zeros(self.size, np.int64), np.full(self.size, -1, np.int64)
        for piece, (i, length) in sorted(known.tree.items(), key=lambda x: x[1][1]):
            node = 0
            for n in range(1, length + 1):
                child = nodes.setdefault(piece[:n], len(nodes))
                if child == len(longest):
                    longest.append(longest[node])
                    steps[node * self.width + letters[piece[n - 1]]] = child
                node = child
            self.length[i], self.shorter[i], longest[node] = length, longest[node], i
        self.longest, self.steps = np.array(longest), Numbers(steps)
        ids = known.ids
        pairs = ((ids.get(p[:n]), ids.get(p[n:]), level) for p, level in known.joined.items() for n in range(1, len(p)))
        self.joined = Numbers({a * self.size + b: level for a, b, level in pairs if a is not None and b is not None})
        self.forget()

    def forget(self) -> None:
        """Empty the table of pairs: of those that share a place the last one is kept."""
        self.pairs = np.full(0, -1, np.int64)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for arrays of pieces."""
        if not len(self.pairs):
            self.pairs = np.full(PAIR_ROWS, -1, np.int64)
        keys = left * self.size + right
        place = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % len(self.pairs)
        seen = self.pairs[place]
        fit, new = (seen & 1).astype(bool), np.flatnonzero(seen >> 1 != keys)
        if len(new):
            asked, at = np.unique(keys[new], return_inverse=True)
            a, b = asked // self.size, asked % self.size
            usual = self.usual[a] & self.usual[b]
            got = np.zeros(len(asked), bool)
            got[usual] = self.stay_apart(a[usual], b[usual])
            got[~usual] = [self.known.compatible(x, y) for x, y in zip(a[~usual].tolist(), b[~usual].tolist())]
            fit[new] = got[at]
            self.pairs[place[new]] = keys[new] << 1 | fit[new]
        return fit

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``stays_apart`` for arrays of pieces."""
        apart, row = np.zeros(len(left), bool), np.arange(len(left))
        before = np.full(len(left), 1 << 60)
        while len(row):
            crossing = self.joined.get(left * self.size + right)
            goes = (crossing < 0) | (crossing >= before)
            a, b = self.level[left], self.level[right]
            ends = goes & (a == 0) & (b == 0)
            apart[row[ends]] = True
            goes &= ~ends
            row, left, right, a, b = row[goes], left[goes], right[goes], a[goes], b[goes]
            first = a > b
            before = np.where(first, a, b + 1)
            left, right = np.where(first, self.halves[left, 1], left), np.where(first, right, self.halves[right, 0])
        return apart

    def match(self, letters: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The longest piece that begins at each place."""
        node, row, place = np.zeros(len(at), np.int64), np.arange(len(at)), at
        while len(row):
            child = self.steps.get(node[row] * self.width + letters[place])
            goes = child >= 0
            row, place = row[goes], place[goes] + 1
            node[row] = child[goes]
        return self.longest[node]

    def walk(self, words: list[str]) -> list[bytes]:
        """Packed ids of each word; None where a letter has no piece. No word may be empty."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        letters = self.letter[np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), "<u4")]
        letters[ends] = 0  # no piece goes on there
        good = np.add.reduceat((letters == 0).astype(np.int64), ends - sizes) == 1
        last, failed = np.full(len(letters), -1), np.zeros(len(letters), bool)  # the piece that ends before a place; places from which none fits
        pos = (ends - sizes)[good]
        piece = self.match(letters, pos)
        while len(pos):
            none = piece < 0
            if none.any():
                back = pos[none]
                failed[back] = True
                dropped = last[back]
                if (dropped < 0).any():
                    raise ValueError("a letter has no piece of its own")
                pos[none] = back - self.length[dropped]
                piece[none] = self.shorter[dropped]
                continue
            end, before = pos + self.length[piece], last[pos]
            fit = ~failed[end]
            ask = np.flatnonzero(fit & (before >= 0))
            fit[ask] = self.fits(before[ask], piece[ask])
            last[end[fit]] = piece[fit]
            piece[~fit] = self.shorter[piece[~fit]]
            pos[fit] = end[fit]
            rest = letters[pos] > 0
            on = np.flatnonzero(fit & rest)
            piece[on] = self.match(letters, pos[on])
            pos, piece = pos[rest], piece[rest]
        used, at = np.zeros(len(letters), bool), ends[good]
        while len(at):
            used[at] = True
            at = at - self.length[last[at]]
            at = at[last[at] >= 0]
        packed = last[used].astype("<u4").tobytes()
        cuts = (4 * np.cumsum(used)[ends]).tolist()
        return [packed[a:b] if b > a else None for a, b in zip([0, *cuts], cuts)]


class PieceCodec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, model_path: str):
        vocab = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = vocab.vocab_size()
        self.bos, self.eos = vocab.bos_id(), vocab.eos_id()
        self.pieces = [vocab.id_to_piece(i) for i in range(size)]
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.out = [b""] * size
        for i, piece in enumerate(self.pieces):
            if vocab.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.out[i] = bytes([value])
            elif not (vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_unused(i)):
                self.ids[piece] = i
                self.rank[piece] = vocab.get_score(i)
                self.out[i] = piece.replace(MARK, " ").encode()
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece holds a word mark after another character")
        self.letters = {c for piece in self.ids for c in piece}
        levels = {score: n for n, score in enumerate(sorted(set(self.rank.values()), reverse=True), 1)}
        self.level = [0] * size  # order of the merge that makes a piece; 0 for single characters
        self.halves: list[tuple[int, int] | None] = [None] * size  # the two pieces merged last; None if order is unusual
        self.tree = ahocorasick.Automaton()
        for piece, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            parts = self.merged(piece, stop=2)
            if len(piece) == 1:
                self.halves[i] = (i, i)
            elif self.merged(piece) != [piece]:
                continue
            else:
                self.level[i] = levels[self.rank[piece]]
                a, b = (self.ids.get(x) for x in parts)
                if a is not None and b is not None and self.halves[a] and self.halves[b]:
                    if max(self.level[a], self.level[b]) < self.level[i]:
                        self.halves[i] = (a, b)
            self.tree.add_word(piece, (i, len(piece)))
        self.tree.make_automaton()
        self.joined = {p: levels[s] for p, s in self.rank.items()}
        self.fits: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.lines: dict[str, bytes] = {}
        self.walks: Walks | None = None

    def merged(self, text: str, stop: int = 1) -> list[str]:
        """Merge characters by priority, the leftmost of equal ones first, down to ``stop`` parts."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank > best):
                    best, at = rank, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' characters gives back the two pieces."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if self.halves[left] and self.halves[right]:
                known = self.stays_apart(left, right)
            else:
                a, b = self.pieces[left], self.pieces[right]
                known = self.merged(a + b) == [a, b]
            if len(self.fits) >= PAIR_ROWS:
                self.fits.clear()
            self.fits[key] = known
        return known

    def stays_apart(self, left: int, right: int) -> bool:
        """Replay the merges of both pieces backwards, watching the two parts at the border.

        The border is crossed if, in some state, the parts on its sides have a merge that
        comes before the merge that the state's successor made. Of equal merges the one
        further left is made first.
        """
        pieces, level, halves, joined = self.pieces, self.level, self.halves, self.joined
        before = 1 << 60
        while True:
            crossing = joined.get(pieces[left] + pieces[right])
            if crossing is not None and crossing < before:
                return False
            if not level[left] and not level[right]:
                return True
            if level[left] > level[right]:
                before = level[left]
                left = halves[left][1]
            else:
                before = level[right] + 1
                right = halves[right][0]

    def walk(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces."""
        n = len(text)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, (piece, length) in self.tree.iter(text):
            matches[end + 1 - length].append((end + 1, piece))
        ids: list[int] = []
        places: list[tuple[int, int]] = []
        fits, failed, pos = self.fits, 0, 0
        options = matches[0] if n else []
        k = len(options)
        while pos < n:
            while k:
                k -= 1
                end, piece = options[k]
                if failed and failed >> end & 1:
                    continue
                if ids:
                    fit = fits.get(ids[-1] << 32 | piece)
                    if not (self.compatible(ids[-1], piece) if fit is None else fit):
                        continue
                ids.append(piece)
                places.append((pos, k))
                pos = end
                if pos < n:
                    options = matches[pos]
                    k = len(options)
                break
            else:
                failed |= 1 << pos
                ids.pop()
                pos, k = places.pop()
                options = matches[pos]
        return ids

    def segment(self, text: str) -> bytes:
        """Packed ids of a text; characters without a piece become bytes."""
        ids: list[int] = []
        if self.letters.issuperset(text):
            ids = self.walk(text)
        else:
            known = ""
            for c in text:
                if c in self.letters:
                    known += c
                    continue
                ids += self.walk(known)
                ids += [self.byte_ids[x] for x in c.encode()]
                known = ""
            ids += self.walk(known)
        return array("I", ids).tobytes()

    def remembered(self, word: str) -> bytes:
        """Ids of a mark and a word, through a cache of two generations; the older goes when the newer is full."""
        got = self.cache.get(word) or self.older.get(word) or self.segment(MARK + word)
        if len(word) <= WORD_CHARS:
            self.remember(word, got)
        return got

    def remember(self, word: str, got: bytes) -> None:
        if len(self.cache) >= CACHE_ROWS:
            self.older, self.cache = self.cache, {}
        self.cache[word] = got

    def packed(self, word: str) -> bytes:
        """Ids of a mark and a word. Where line ends have no piece, nothing merges across them."""
        if "\n" not in word or "\n" in self.letters:
            return self.remembered(word)
        first, *rest = word.split("\n")
        parts = [self.cache.get(first) or self.remembered(first)]
        for line in rest:
            got = self.lines.get(line)
            if got is None:
                got = self.segment("\n" + line)
                if len(line) <= WORD_CHARS:
                    self.remember_line(line, got)
            parts.append(got)
        return b"".join(parts)

    def remember_line(self, line: str, got: bytes) -> None:
        if len(self.lines) >= CACHE_ROWS:
            self.lines.clear()
        self.lines[line] = got

    @staticmethod
    def words(text: str) -> list[str]:
        """Parts of a text that begin at a mark, without it; marks before a mark begin the part."""
        if not text:
            return []
        words = text.replace(" ", MARK).split(MARK)
        if "" in words:
            words = [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + MARK.join(words))]
        return words

    def encode(self, text: str) -> bytes:
        """All ids of a text with begin and end, as little-endian unsigned 32-bit integers."""
        return self.whole(self.words(text))

    def whole(self, words: list[str]) -> bytes:
        get = self.cache.get
        return b"".join([array("I", [self.bos]).tobytes(), *[get(w) or self.packed(w) for w in words], array("I", [self.eos]).tobytes()])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` for the texts of a slice, whose new words are walked together."""
        rows = [self.words(text) for text in texts]
        known = self.cache
        self.learn({w for row in rows for w in row if w not in known})
        return [self.whole(row) for row in rows]

    def learn(self, words: set[str]) -> None:
        """Fill the caches with the words and lines that they do not hold, up to their bound; others are walked when they are met."""
        new, lines, cut = [], set(), "\n" not in self.letters
        for word in words:
            if cut and "\n" in word:
                word, *rest = word.split("\n")
                lines.update(x for x in rest if x and len(x) <= WORD_CHARS and x not in self.lines)
                if word in words or word in self.cache:
                    continue
            if len(word) <= WORD_CHARS:
                got = self.older.get(word)
                if got:
                    self.remember(word, got)
                else:
                    new.append(word)
        self.walks = self.walks or Walks(self)
        end = array("I", [self.byte_ids[10]]).tobytes()
        for parts, mark, first, remember in ((new, MARK, b"", self.remember), ([*lines], "", end, self.remember_line)):
            for at in range(0, min(len(parts), CACHE_ROWS), WALK_WORDS):
                block = parts[at:at + WALK_WORDS]
                for word, got in zip(block, self.walks.walk([mark + w for w in block])):
                    if got:
                        remember(word, first + got)

    def forget(self) -> None:
        """Empty the caches and give free memory back, which an idle worker would keep beside other stages' work."""
        self.fits, self.cache, self.older, self.lines = {}, {}, {}, {}
        if self.walks:
            self.walks.forget()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only; others have no such call
        if trim:
            trim(0)

    def decode(self, packed: bytes) -> str:
        """Text of packed ids: marks become spaces, the first one of the text is dropped."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        raw = b"".join(map(self.out.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_codecs: dict[str, PieceCodec] = {}


def codec(model_path: str) -> PieceCodec:
    """The codec of a file, built once per Python worker."""
    if model_path not in _codecs:
        _codecs[model_path] = PieceCodec(model_path)
    return _codecs[model_path]


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and length of runs of rows with ``SLICE_ROWS`` rows and ``SLICE_BYTES`` bytes at most; a longer value is alone."""
    start = held = 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if at > start and (at - start >= SLICE_ROWS or held + size > SLICE_BYTES):
            yield start, at - start
            start, held = at, 0
        held += size
    if start < len(column):
        yield start, len(column) - start


def _mapped(df: DataFrame, keep: list[str], source: str, model_path: str, outs: list[tuple[str, T.DataType, pa.DataType]], make) -> DataFrame:
    """Columns ``keep`` and the columns ``outs`` that ``make`` forms from the codec and the values of ``source`` in a slice."""

    def made(known: PieceCodec, part: pa.RecordBatch) -> pa.RecordBatch:
        values = make(known, part.column(source).to_pylist())
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(v, kind) for v, (_, _, kind) in zip(values, outs))],
                                          [*keep, *(name for name, _, _ in outs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(model_path)
        try:
            for batch in batches:
                for at, n in slices(batch.column(source)):
                    yield made(known, batch.slice(at, n))
                del batch
        finally:
            known.forget()

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(name, kind) for name, kind, _ in outs])
    return df.select(*dict.fromkeys([*keep, source])).mapInArrow(run, schema)


def round_trip(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: columns ``keep`` (all but the text by default), the packed ids and their text."""
    keep = [c for c in df.columns if c not in (text, ids, out)] if keep is None else keep

    def make(known: PieceCodec, values: list[str | None]) -> tuple[list[bytes], list[str]]:
        packed = known.encode_all([v or "" for v in values])
        return packed, [known.decode(p) for p in packed]

    return _mapped(df, keep, text, model_path, [(ids, T.BinaryType(), pa.binary()), (out, T.StringType(), pa.string())], make)


def encode(df: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, out: str = "ids") -> DataFrame:
    """Columns ``keep`` (all but the text by default) and the packed ids of each text."""
    keep = [c for c in df.columns if c != text and c != out] if keep is None else keep
    return _mapped(df, keep, text, model_path, [(out, T.BinaryType(), pa.binary())], lambda known, values: (known.encode_all([v or "" for v in values]),))


def decode(df: DataFrame, model_path: str, ids: str = "ids", keep: list[str] | None = None, out: str = "decoded") -> DataFrame:
    """Columns ``keep`` (all by default) and the text of the packed ids; null ids give null."""
    keep = [c for c in df.columns if c != out] if keep is None else keep
    return _mapped(df, keep, ids, model_path, [(out, T.StringType(), pa.string())], lambda known, values: ([None if p is None else known.decode(p) for p in values],))


def id_count(ids: str = "ids"):
    """Number of ids in a packed column."""
    return (F.octet_length(ids) / 4).cast("long")
