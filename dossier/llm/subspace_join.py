"""Cosine near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine at least c have squared distance at most 2 - 2c. A fixed random
rotation spreads the distance over all coordinates, which are split into blocks. In at
least one block the squared distance is at most the block's share of the budget, so the
union of one range join per block holds every link.

Range join in a block: pivots (a few rounds of k-means on a bounded sample) cut it into
cells, a vector lives in the cell of its nearest pivot. The border between two cells is a
hyperplane, and two vectors on its sides are at least as far apart as the sum of their
distances to it. So a pair of cells is compared from the border inwards, and only as
far as the sum stays within the block's radius.

The vectors are shuffled once per block, into chunk files in the order of the cells; a large cell is
many chunks. Tasks read two chunks at a time and compare them, so no vector is written more than once per block,
however many chunks it meets, and a block's files go before the next one's are written. Inside two cells the block
distances are a matrix product in single precision with a margin; candidates are tested by cosine in
double precision. A link counts only in the first block that is within its budget, so each
is counted once. Tasks emit one row per linked vector of two chunks (links, root of a local star), never
pairs.

Equal vectors are one class; its members link with each other and share all links.
Vectors that are null, zero, or hold null or non-finite components link with nothing.
Vectors of a length other than the most common one raise no error: lengths are joined apart.
A null id is kept; it has no links and no component. Repeated rows count as copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm.common import components, mix, perhaps_in, read_file, shuffles_removed, work_dir, write_file, written
from dossier.session import remove_work, work_mark

BLOCKS = 4
#: Vectors that pivots are fitted on, at least, and for each pivot; pivots in a block, at most.
SAMPLE, SAMPLE_EACH, PIVOTS = 4096, 4, 4096
#: Vectors in a chunk, at most; a task has about the pairs of a full chunk with this many vectors, or fewer.
LEFT_CHUNK, RIGHT_CHUNK = 131_072, 16_384
#: Bytes of a chunk, at most; vectors, at least, where fewer than CHUNKS chunks come out.
CHUNK_BYTES, LEAST_CHUNK, CHUNKS = 32 << 20, 1024, 16
TILE, SPACE, ROWS = 128, 1 << 19, 64
PAIRS = 50_000
ROUNDING = 1e-9
#: Pivots closer than this, and a cell with itself, have no border: all pairs are compared.
NO_BORDER = 1e-4
#: Relative error of one operation in single precision.
SINGLE = 2.0 ** -24


def units_of(x: np.ndarray) -> np.ndarray:
    """Double-precision unit vectors of rows that are finite and not zero."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    x /= np.sqrt((x * x).sum(1))[:, None]
    x += 0.0
    return x


def matrix(raw: pa.Array, kind: np.dtype) -> np.ndarray:
    """Rows of components from equally long bytes."""
    ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind).reshape(len(raw), -1)


def described(values: pa.ListArray, whole: bool) -> tuple[list[bytes | None], list[bytes | None]]:
    """A digest of the unit vector, and with ``whole`` the components' bytes as given, of each row; None for those that link with nothing."""
    digests: list[bytes | None] = [None] * len(values)
    raw: list[bytes | None] = [None] * len(values)
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    starts = values.offsets.to_numpy()[:-1]
    flat = values.values.to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        x = flat[starts[rows][:, None] + np.arange(size)]
        top = np.abs(x).max(1)
        usable = np.isfinite(top) & (top > 0)
        rows, x = rows[usable], x[usable]
        if len(rows):
            for row, unit in zip(rows.tolist(), units_of(x)):
                digests[row] = hashlib.sha1(unit).digest()[:16]
            for row, given in zip(rows.tolist() if whole else [], x):
                raw[row] = given.tobytes()
    return digests, raw


def nearly_units_of(x: np.ndarray) -> np.ndarray:
    """Single-precision unit vectors, within (size + 4) * SINGLE of each component's share."""
    if x.dtype == np.float32:
        squares = np.einsum("ij,ij->i", x, x)
        if ((squares > 1e-20) & (squares < 1e20)).all():
            return x / np.sqrt(squares)[:, None]
    return np.concatenate([units_of(x[at:at + 4096]).astype(np.float32) for at in range(0, len(x), 4096)])


def rotation(size: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(size).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def borders(size: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, size, min(BLOCKS, size) + 1).astype(int)
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def fit_pivots(sample: np.ndarray, number: int, rounds: int = 4) -> list[np.ndarray]:
    """Single-precision pivots of each block, from rotated sample vectors."""
    rng = np.random.default_rng(1)
    out = []
    for low, high in borders(sample.shape[1]):
        x = np.unique(sample[:, low:high], axis=0)
        pivots = x[rng.permutation(len(x))[:number]].astype(np.float32)
        for _ in range(rounds):
            near = nearest(x.astype(np.float32), pivots)
            sums = np.zeros(pivots.shape)
            np.add.at(sums, near, x)
            sizes = np.bincount(near, minlength=len(pivots))
            pivots[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
        out.append(np.unique(pivots, axis=0))
    return out


def nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The home cell of each row. One that rounding moves to a neighbour does no harm, as borders hold for any two cells."""
    half = (pivots * pivots).sum(1) / 2
    home = np.empty(len(x), np.int32)
    for at in range(0, len(x), TILE):
        home[at:at + TILE] = (half - x[at:at + TILE] @ pivots.T).argmin(1)
    return home


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


class Budget(NamedTuple):
    """What a range join in one block has to know."""

    block: int
    least: float
    turn: np.ndarray

    @property
    def share(self) -> tuple[int, int]:
        return borders(len(self.turn))[self.block]

    def most(self, block: int) -> float:
        low, high = borders(len(self.turn))[block]
        return (2 - 2 * self.least) * (high - low) / len(self.turn)

    @property
    def radius(self) -> float:
        """Of the block, with the error of both vectors' single-precision coordinates."""
        low, high = self.share
        return float(np.sqrt(self.most(self.block)) + 2 * (2 * len(self.turn) + 8) * SINGLE * np.sqrt(high - low)) + ROUNDING

    def counted(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs of linked unit vectors have this block as their first within its budget."""
        gap = (x @ self.turn - y @ self.turn) ** 2
        within = np.stack([gap[:, p:q].sum(1) <= self.most(k) + ROUNDING for k, (p, q) in enumerate(borders(len(self.turn)))], axis=1)
        return (within.argmax(1) == self.block) & within[:, self.block]

    def counted_all(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For rows of unit vectors, all with all: linked, and this block their first within its budget."""
        linked = x @ y.T >= self.least
        x, y = x @ self.turn, y @ self.turn
        for k, (p, q) in enumerate(borders(len(self.turn))[:self.block + 1]):
            within = _squares(x[:, p:q], y[:, p:q]) <= self.most(k) + ROUNDING
            linked &= within if k == self.block else ~within
        return linked


class Chunk:
    """Vectors in the order of their cells: ids, sizes of their classes, components as given, single-precision coordinates."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, cells: np.ndarray, raw: np.ndarray, budget: Budget):
        self.ids, self.weights, self.raw = ids, weights, raw
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        self.cells, self.bounds = cells[starts], np.append(starts, len(ids))
        self.place = np.repeat(np.arange(len(self.cells)), np.diff(self.bounds))
        self.units = nearly_units_of(raw)
        low, high = budget.share
        self.part = self.units @ budget.turn[:, low:high].astype(np.float32)
        half = (self.part * self.part).sum(1, dtype=np.float32)[:, None] / 2
        one = np.ones_like(half)
        #: The product of a left and a right row is minus half of their squared distance.
        self.left, self.right = np.hstack([self.part, -half, one]), np.hstack([self.part, one, -half])

    def depths(self, other: Chunk, pivots: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Distance of each vector (in a column) to the border between its own cell and each of the other chunk's; 0 where there is none."""
        half = (pivots * pivots).sum(1) / 2
        ahead = np.einsum("ij,ij->i", self.part, pivots[self.cells][self.place]) - half[self.cells][self.place]
        depth = pivots[other.cells] @ self.part.T
        np.subtract(ahead, depth, out=depth)
        depth += half[other.cells][:, None]
        for cell, (start, end) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            depth[:, start:end] /= apart[cell][:, None]
        return depth


class Stars:
    """Links of each vector of two chunks, and its root, the smallest id that it reaches by links inside them."""

    def __init__(self, left: Chunk, right: Chunk, budget: Budget, same: bool):
        self.left, self.right, self.budget, self.offset = left, right, budget, 0 if same else len(left.ids)
        self.ids = left.ids if same else np.concatenate([left.ids, right.ids])
        self.weights = left.weights if same else np.concatenate([left.weights, right.weights])
        self.links, self.label = np.zeros(len(self.ids)), np.arange(len(self.ids))
        self.likely: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.joins: list[tuple[np.ndarray, np.ndarray]] = []

    def maybe(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs close enough in the block: rows of the left and the right chunk."""
        self.likely.append((i, j))
        self.waiting += len(i)
        if self.waiting >= PAIRS:
            self.test()

    def test(self) -> None:
        every = [np.concatenate(x) for x in zip(*self.likely)] or [np.empty(0, np.int64)] * 2
        self.likely, self.waiting = [], 0
        size = len(self.budget.turn)
        for k in range(0, len(every[0]), PAIRS):
            i, j = (x[k:k + PAIRS] for x in every)
            near = np.einsum("ij,ij->i", self.left.units[i], self.right.units[j]) >= self.budget.least - 2 * (2 * size + 8) * SINGLE
            i, j = i[near], j[near]
            if not len(i):
                continue
            x, y = units_of(self.left.raw[i]), units_of(self.right.raw[j])
            linked = np.flatnonzero(np.einsum("ij,ij->i", x, y) >= self.budget.least)
            linked = linked[self.budget.counted(x[linked], y[linked])]
            self.add(i[linked], j[linked])

    def all_of(self, i: np.ndarray, j: np.ndarray, upper: bool) -> None:
        """All pairs of some rows of the left and the right chunk, where many are linked; with ``upper`` only of rows i below j."""
        linked = self.budget.counted_all(units_of(self.left.raw[i]), units_of(self.right.raw[j]))
        if upper:
            linked &= i[:, None] < j[None, :]
        at, to = np.nonzero(linked)
        self.add(i[at], j[to])

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        j = j + self.offset
        self.links += np.bincount(i, self.weights[j], len(self.ids)) + np.bincount(j, self.weights[i], len(self.ids))
        apart = self.label[i] != self.label[j]
        if apart.any():
            self.joins.append((i[apart], j[apart]))
            if sum(len(i) for i, _ in self.joins) >= PAIRS:
                self.unite()

    def unite(self) -> None:
        """One label for vectors that links connect: larger labels hang below smaller ones, and paths are halved."""
        if not self.joins:
            return
        i, j = (self.label[np.concatenate(x)] for x in zip(*self.joins))
        self.joins = []
        parent = np.arange(len(self.ids))
        while True:
            i, j = parent[i], parent[j]
            apart = i != j
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))
            while (parent[parent] != parent).any():
                parent = parent[parent]
        self.label = parent[self.label]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, links, root) of every linked vector."""
        self.test()
        self.unite()
        root = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(root, self.label, self.ids)
        on = self.links > 0
        return self.ids[on], self.links[on].astype(np.int64), root[self.label[on]]


def stars(left: Chunk, right: Chunk, pivots: np.ndarray, budget: Budget) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, links, root) of the linked vectors of two chunks, or of one with itself."""
    same = left is right
    out = Stars(left, right, budget, same)
    low, high = budget.share
    a, b = pivots[left.cells].astype(np.float64), pivots[right.cells].astype(np.float64)
    apart = np.sqrt(_squares(a, b))
    apart[apart < NO_BORDER] = np.inf
    radius = budget.radius + 8 * (high - low + 8) * SINGLE / apart
    x = left.depths(right, pivots, apart.astype(np.float32))
    y = x if same else right.depths(left, pivots, apart.T.astype(np.float32))
    x_least, y_least = np.minimum.reduceat(x, left.bounds[:-1], axis=1).T, np.minimum.reduceat(y, right.bounds[:-1], axis=1)
    meet = x_least.astype(np.float64) + y_least <= radius
    if same:
        meet = np.triu(meet)
    limit = np.float32(-budget.radius ** 2 / 2 - (high - low + 8) * 2 * SINGLE)
    tiles = _Tiles(out, limit)
    for p, q in zip(*np.nonzero(meet)):
        inside = same and p == q
        i, x_depth = _inwards(left, p, x[q], np.inf if inside else radius[p, q] - y_least[p, q])
        j, y_depth = _inwards(right, q, y[p], np.inf if inside else radius[p, q] - x_least[p, q])
        rows, columns = left.left.take(i, 0), right.right.take(j, 0)
        ends = np.searchsorted(y_depth, radius[p, q] - x_depth[::TILE], "right").tolist()
        for at, upto in zip(range(0, len(i), TILE), ends):
            for to in range(at if inside else 0, upto, SPACE // TILE):
                end = min(to + SPACE // TILE, upto)
                tiles.compare(rows[at:at + TILE], columns[to:end], i[at:at + TILE], j[to:end], inside)
    tiles.look()
    return out.rows()


class _Tiles:
    """Products of left and right rows, some tiles in a row, and the pairs among them that reach a limit."""

    def __init__(self, out: Stars, limit: np.float32):
        self.out, self.limit, self.used = out, limit, 0
        self.space = np.empty(SPACE, np.float32)
        self.held: list[tuple[int, np.ndarray, np.ndarray, bool]] = []

    def compare(self, rows: np.ndarray, columns: np.ndarray, i: np.ndarray, j: np.ndarray, inside: bool) -> None:
        m, n = len(rows), len(columns)
        if self.used + m * n > SPACE:
            self.look()
        np.matmul(rows, columns.T, out=self.space[self.used:self.used + m * n].reshape(m, n))
        self.held.append((self.used, i, j, inside))
        self.used += m * n

    def look(self) -> None:
        found = _places(self.space[:self.used], self.limit)
        if len(found):
            starts = [start for start, *_ in self.held]
            cuts = np.append(np.searchsorted(found, starts), len(found))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                start, i, j, inside = self.held[k]
                here = found[cuts[k]:cuts[k + 1]] - start
                if len(here) > max(len(i) * len(j) / 8, 1024):
                    self.out.all_of(i, j, inside)
                    continue
                s, t = i[here // len(j)], j[here % len(j)]
                if inside:
                    s, t = s[s < t], t[s < t]
                self.out.maybe(s, t)
        self.held, self.used = [], 0


def _places(values: np.ndarray, limit: np.float32) -> np.ndarray:
    """Where values reach the limit, in order; few do, so the maximum of each of many columns is looked at first."""
    width = len(values) // ROWS
    table, rest = values[:ROWS * width].reshape(ROWS, width), ROWS * width
    some = np.flatnonzero(table.max(0, initial=-np.inf) >= limit)
    row, at = np.nonzero(table[:, some] >= limit)
    return np.concatenate([row * width + some[at], rest + np.flatnonzero(values[rest:] >= limit)])


def _inwards(chunk: Chunk, cell: int, depth: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a cell that are no deeper than ``most``, from the border inwards, and their depths."""
    start, end = chunk.bounds[cell], chunk.bounds[cell + 1]
    depth = depth[start:end]
    rows = np.flatnonzero(depth <= most)
    depth = depth[rows]
    if most < np.inf:
        order = np.argsort(depth)
        rows, depth = rows[order], depth[order]
    return start + rows, depth


def similar(df: DataFrame, least: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    single = df.select(vector).dtypes[0][1] == "array<float>"
    source = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"))
    with shuffles_removed(df.sparkSession):
        return _similar(source, least, np.dtype(np.float32 if single else np.float64))


def _similar(source: DataFrame, least: float, kind: np.dtype) -> DataFrame:
    spark = source.sparkSession

    def describe(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                digests, raw = described(part.column(1), whole)
                columns = [part.column(0), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "digest", "raw"]) if whole else pa.RecordBatch.from_arrays(columns[:2], ["vec_id", "digest"])

    def rows(given: DataFrame) -> DataFrame:
        return given.filter("vec_id is not null").mapInArrow(lambda batches: describe(batches, True), "vec_id long, digest binary, raw binary").filter("digest is not null")

    kept = written(source.mapInArrow(lambda batches: describe(batches, False), "vec_id long, digest binary"), "digests")
    usable = kept.filter("vec_id is not null and digest is not null")
    classes = written(usable.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size")), "classes")
    several = classes.filter("size > 1").select("digest")
    points = rows(source)
    if several.isEmpty():
        points = points.select("vec_id", F.lit(1).cast("long").alias("size"), "raw")
    else:  # a vector without copies needs no shuffle to be found
        alone = perhaps_in(points, "digest", several, "copied").filter("not copied").select("vec_id", F.lit(1).cast("long").alias("size"), "raw")
        # classes of copies, and those that the map cannot tell from them: of their rows only the first are shuffled
        first = written(perhaps_in(classes.withColumnRenamed("id", "vec_id"), "digest", several, "copied").filter("copied").drop("copied"), "first")
        asked = rows(perhaps_in(source, "vec_id", first, "asked").filter("asked").drop("asked"))
        points = alone.unionByName(asked.join(first, ["digest", "vec_id"]).dropDuplicates(["digest", "vec_id"]).select("vec_id", "size", "raw"))
    points = written(points, "points")
    sizes = [r["n"] // kind.itemsize for r in points.groupBy(F.octet_length("raw").alias("n")).count().collect()]
    found = [part for size in sorted(sizes) for part in _joined(points.filter(F.octet_length("raw") == size * kind.itemsize), size, least, kind)]
    links = spark.createDataFrame([], "vec_id long, links long, root long")
    for part in found:
        links = links.unionByName(part)
    roots = components(links.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = written(links.groupBy("vec_id").agg(F.sum("links").alias("links")), "counts")
    table = written(
        classes.join(counts.withColumnRenamed("vec_id", "id"), "id", "left")
        .join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "id").alias("root")), "table")
    known = F.col("vec_id").isNotNull()
    out = kept.join(table, "digest", "left").select(
        "vec_id", F.when(known, F.col("n_links")).alias("n"), F.when(known, F.coalesce("root", "vec_id")).alias("component_id"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _joined(points: DataFrame, size: int, least: float, kind: np.dtype) -> list[DataFrame]:
    """(vec_id, links, root) rows of the linked vectors of one length, a table for each block."""
    spark = points.sparkSession
    total = points.count()
    turn = rotation(size)
    number = int(np.clip(np.ceil(total ** 0.75 / 110), 4, PIVOTS))
    wanted = max(SAMPLE, SAMPLE_EACH * number)
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 31))
    few = points.filter(place < int(min(1, 2 * wanted / total) * (1 << 31)))
    sample = few.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("raw").collect()
    if not sample:
        sample = points.limit(1).select("raw").collect()
    every_pivot = fit_pivots(units_of(np.stack([np.frombuffer(r["raw"], kind) for r in sample])) @ turn, number)
    parts = borders(size)
    chunk = max(1, min(LEFT_CHUNK, CHUNK_BYTES // (size * kind.itemsize), max(LEAST_CHUNK, -(-total // CHUNKS))))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(p), np.int64) for p in every_pivot]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                x = (units_of(matrix(batch.column(0).slice(at, 4096), kind)) @ turn).astype(np.float32)
                for count, pivots, (low, high) in zip(counts, every_pivot, parts):
                    count += np.bincount(nearest(x[:, low:high], pivots), minlength=len(pivots))
        for block, count in enumerate(counts):
            cell = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), block, np.int32)), pa.array(cell.astype(np.int32)), pa.array(count[cell])], ["block", "cell", "n"])

    # One row per cell: pivots bound their number.
    counts = points.select("raw").mapInArrow(tally, "block int, cell int, n long").groupBy("block", "cell").agg(F.sum("n").alias("n")).collect()
    out = []
    for block, pivots in enumerate(every_pivot):
        in_cell = np.zeros(len(pivots), np.int64)
        for r in counts:
            if r["block"] == block:
                in_cell[r["cell"]] = r["n"]
        mark = work_mark(spark)
        paths = _chunked(points, Budget(block, least, turn), pivots, in_cell, chunk, kind)
        found = written(_met(spark, paths, Budget(block, least, turn), pivots, chunk, kind), "found")
        out.append(found)
        remove_work(spark, mark, keep=1)
    return out


def layout(in_cell: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """The first chunk of each cell and how many it has of its own: cells in a row share a chunk, a larger one is cut."""
    first, own, at, filled = np.zeros(len(in_cell), np.int64), np.ones(len(in_cell), np.int64), 0, 0
    for cell, n in enumerate(in_cell.tolist()):
        if filled and filled + n > chunk:
            at, filled = at + 1, 0
        first[cell], own[cell] = at, max(1, -(-n // chunk))
        filled += n
        if filled > chunk:
            at, filled = at + int(own[cell]), 0
    return first, own


def _chunked(points: DataFrame, budget: Budget, pivots: np.ndarray, in_cell: np.ndarray, chunk: int, kind: np.dtype) -> list[str]:
    """Write the vectors as files of about ``chunk`` rows in the order of their cells. Returns the paths."""
    first, own = layout(in_cell, chunk)
    folder = work_dir(points.sparkSession, "chunks")
    low, high = budget.share
    turn, size = budget.turn[:, low:high], len(budget.turn)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = units_of(matrix(part.column(2), kind)) @ turn
                cell = nearest(x.astype(np.float32), pivots)
                to = first[cell] + (mix(part.column(0).to_numpy().astype(np.uint64)) % own[cell].astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(cell), *part.columns], ["chunk", "cell", "vec_id", "size", "raw"])

    def store(table: pa.Table) -> pa.Table:
        number = table.column("chunk")[0].as_py()
        order = np.argsort(table.column("cell").to_numpy(), kind="stable")
        raw = np.concatenate([matrix(part, kind) for part in table.column("raw").chunks])[order]
        columns = [pa.array(table.column(c).to_numpy()[order]) for c in ("vec_id", "size", "cell")]
        columns.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(size * kind.itemsize), len(raw), [None, pa.py_buffer(raw)]))
        batch = pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "cell", "raw"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, batch.schema) as writer:
            writer.write_batch(batch)
        write_file(f"{folder}/{number}.arrow", sink.getvalue())
        return pa.table({"chunk": pa.array([number], pa.int32())})

    placed = points.select("vec_id", "size", "raw").mapInArrow(place, "chunk int, cell int, vec_id long, size long, raw binary")
    made = placed.groupBy("chunk").applyInArrow(store, "chunk int").collect()
    return [f"{folder}/{k}.arrow" for k in sorted(r["chunk"] for r in made)]


def pairs_between(n: int, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Some of the pairs (i, j) of numbers below n, j from i on, in their order."""
    i, j = 0, begin
    while j >= n - i > 0:
        i, j = i + 1, j - (n - i)
    j += i
    for _ in range(begin, end):
        yield i, j
        i, j = (i, j + 1) if j + 1 < n else (i + 1, i + 1)


def _met(spark: SparkSession, paths: list[str], budget: Budget, pivots: np.ndarray, chunk: int, kind: np.dtype) -> DataFrame:
    """(vec_id, links, root) rows of all pairs of chunk files, some pairs in a row for each task."""
    count = len(paths) * (len(paths) + 1) // 2
    wanted = max(2 * spark.sparkContext.defaultParallelism, count * chunk * chunk // (LEFT_CHUNK * RIGHT_CHUNK))
    number = max(1, min(count, wanted))

    def load(path: str) -> Chunk:
        table = pa.ipc.open_file(read_file(path)).read_all().combine_chunks()
        raw = np.frombuffer(table.column("raw").chunk(0).buffers()[1], kind).reshape(len(table), -1)
        return Chunk(*(table.column(c).to_numpy() for c in ("vec_id", "size", "cell")), raw, budget)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column(0).to_pylist():
                at = -1
                for i, j in pairs_between(len(paths), task * count // number, (task + 1) * count // number):
                    if at != i:
                        at, left = i, load(paths[i])
                    got = stars(left, left if i == j else load(paths[j]), pivots, budget)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in got], ["vec_id", "links", "root"])

    return spark.range(0, number, 1, number).mapInArrow(meet, "vec_id long, links long, root long")
