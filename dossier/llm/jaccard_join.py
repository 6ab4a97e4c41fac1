"""Jaccard similarity join on word shingles with token-combination prefixes.

Tokens are hashed shingles. Two documents link if their sets' Jaccard similarity is at
least ``least`` of ``of`` (integers, so the test is exact). The result has one row per
document with the smallest key reachable by links.

1. Documents with equal sets are one class; its smallest key stands for it. Sets too
   small to differ from a linked one stop here.
2. Elimination: if x links with y, at most ``slack(x)`` of x's tokens are missing in y. So
   at most that many of its tokens in a fixed part of the hash space occur in no other set.
   Documents with more of them can have no link and drop out, before most tokens were
   ever shuffled. A map of bits holds most of their texts back from the join that follows.
3. The tokens left are ordered from rare to frequent. Rare ones (at most ``RARE`` documents)
   are indexed singly. For frequent classes the prefix is extended and k-token
   combinations are indexed: a class that gives n tokens to the prefix guards against
   n - k + 1 missing ones, and the prefix ends when the guards exceed the slack. Linked
   documents then share a single token or a combination. Combinations are formed inside
   subdivisions of a class, whose number follows the size of the set; sets near a border
   of sizes are indexed for both sides.
4. Documents that share an index entry belong to the same candidate group. Inside a
   group, size bands and chunks of bounded size meet pairwise, only where sizes allow a
   link, each pair of chunks in one group of rows. The exact test is a product of
   incidence matrices. A chunk pair emits no pairs but the links' spanning stars.
5. Connected components of the stars are the classes' components.

No step drops or caps rows. Hot tokens, groups and sets only pass aggregates that combine
before the shuffle, and joins of two shuffled tables that the adaptive skew join can split.
64-bit hashes stand for shingles; a collision inside one pair of documents is the only
way to a wrong count.

Null and empty texts have no tokens and link with nothing. Rows without key are dropped.
Repeated rows are repeated in the result. Of a key with several texts, the text with the
smallest set key is compared for the key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import BASE, components, mix, perhaps_in, shingles, text_bytes, written

#: Tokens in at most so many documents are indexed singly, others in pairs.
RARE = 64
#: Frequent classes: (at most so many documents, tokens in a combination); None has no limit.
CLASSES = ((RARE, 1), (None, 2))
#: A set of so many tokens gets one subdivision of a frequent class per power of two.
SUBDIVIDE = 64
#: Bounds of a chunk that meets others: documents and tokens.
CHUNK_DOCS = 256
CHUNK_TOKENS = 60_000
COLUMNS = 8192


def slack(n: int, least: int, of: int) -> int:
    """Most tokens of a set of n that a linked set may lack."""
    return n - -(-n * least // of)


def token_sets(df: DataFrame, key: str, text: str, width: int, share: int | None = None, only: str | None = None) -> DataFrame:
    """doc_id, n, a 128-bit key of the set, and its tokens (those below 1/``share`` of the hash space if given).

    ``only`` names a column with the set key that a row must have to stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = np.uint64(2**64 // share) if share and share > 1 else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingles(raw, width) for raw in text_bytes(part.column(1))]
                pairs = [(int(np.bitwise_xor.reduce(s)) << 64 | int(np.add.reduce(mix(s * BASE)))) if len(s) else 0 for s in sets]
                keys = [f"{len(s):x}-{k:032x}" for s, k in zip(sets, pairs)]
                kept = sets if limit is None else [s[:np.searchsorted(s, limit)] for s in sets]
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.string()),
                     pa.array([s.view(np.int64) for s in kept], pa.list_(pa.int64()))],
                    ["doc_id", "n", "set_key", "tokens"])
                if only:
                    out = out.filter(pa.array([k == w for k, w in zip(keys, part.column(2).to_pylist())]))
                yield out

    columns = [F.col(key).cast("long").alias("doc_id"), F.col(text), *([F.col(only)] if only else [])]
    return df.select(*columns).mapInArrow(run, "doc_id long, n long, set_key string, tokens array<long>")


def signatures(pairs: list[tuple[int, int]], alone: int, n: int, least: int, of: int,
               classes=CLASSES) -> set[int]:
    """Index entries of one set: ``pairs`` are (documents, token) of the tokens that others have too.

    ``alone`` tokens occur nowhere else; being the rarest they come first and use up slack.
    """
    need = slack(n, least, of) + 1 - alone
    if need <= 0:
        return set()
    pairs = sorted(pairs)
    found: set[int] = set()
    parts = {1 << max(1, size // SUBDIVIDE).bit_length() - 1 for size in (n, n * least // of, -(-n * least // of))}
    for m in parts:
        guard, held = 0, {}
        for count, token in pairs:
            level = next(i for i, (most, _) in enumerate(classes) if most is None or count <= most)
            k = classes[level][1]
            group = held.setdefault((level, k, (token & (2**64 - 1)) % m if k > 1 else 0), [])
            group.append(token)
            guard += len(group) >= k
            if guard >= need:
                break
        for (level, k, _), tokens in held.items():
            if k == 1:
                found.update(tokens)
            else:
                for some in combinations(sorted(tokens), k):
                    h = level
                    for token in some:
                        h = (h * 0x9E3779B97F4A7C15 + token) & (2**64 - 1)
                        h ^= h >> 29
                    found.add(h - 2**64 if h >= 2**63 else h)
    return found


def _index(ranked: DataFrame, least: int, of: int) -> DataFrame:
    """(entry, doc_id) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                entries, docs = [], []
                for doc, n, ranked_tokens in zip(part["doc_id"], part["n"], part["ranked"]):
                    pairs = {(r["df"], r["token"]) for r in ranked_tokens}  # of a repeated row the tokens come twice
                    got = signatures(list(pairs), n - len(pairs), n, least, of)
                    entries += got
                    docs += [doc] * len(got)
                yield pa.RecordBatch.from_arrays([pa.array(entries, pa.int64()), pa.array(docs, pa.int64())], ["entry", "doc_id"])

    return ranked.select("doc_id", "n", "ranked").mapInArrow(run, "entry long, doc_id long")


def stars(ids: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, least: int, of: int) -> list[tuple[int, int]]:
    """Links between the rows where ``left`` is true and the others (or among themselves if all are), as stars."""
    tokens, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(counts > 1) - 1
    shared = counts[inverse] > 1
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared]
    column = column[inverse[shared]]
    a = np.flatnonzero(left)
    b = np.flatnonzero(~left) if not left.all() else a
    common = np.zeros((len(a), len(b)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        low, high = np.searchsorted(column, [first, first + COLUMNS])
        m = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        m[row[low:high], column[low:high] - first] = 1
        common += m[a] @ m[b].T
    common = np.rint(common).astype(np.int64)
    linked = of * common >= least * (sizes[a][:, None] + sizes[b][None, :] - common)
    root = {int(i): int(i) for i in range(len(sets))}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(linked)):
        x, y = find(int(a[i])), find(int(b[j]))
        if x != y:
            x, y = sorted((x, y), key=lambda z: ids[z])
            root[y] = x
    return [(int(ids[i]), int(ids[find(i)])) for i in range(len(sets)) if find(i) != i]


def _verified(members: DataFrame, sets: DataFrame, least: int, of: int) -> DataFrame:
    """Star edges of all links inside candidate groups. ``members``: grp, doc_id, n."""
    step = 1.0001 * log(of / least)  # linked sizes differ by less than one step
    banded = written(members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")), "banded")
    counts = banded.groupBy("grp", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK_DOCS), F.ceil(F.sum("n") / CHUNK_TOKENS)).cast("int").alias("chunks"))
    counts = written(counts, "bands")
    above = counts.select("grp", (F.col("band") - 1).alias("band"), F.col("chunks").alias("up"))
    below = counts.select("grp", (F.col("band") + 1).alias("band"), F.col("chunks").alias("down"))
    sized = written(counts.join(above, ["grp", "band"], "left").join(below, ["grp", "band"], "left")
                    .select("grp", "band", "chunks", F.coalesce("up", F.lit(0)).alias("up"), F.coalesce("down", F.lit(0)).alias("down")), "sized")
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    # The pairs of chunks a document takes part in: its own band's, the next one's, the last one's.
    pairs = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda t: F.struct(
            F.col("band").alias("b1"), F.least(t, F.col("c")).alias("c1"), F.col("band").alias("b2"), F.greatest(t, F.col("c")).alias("c2"))),
        F.when(F.col("up") > 0, F.transform(F.sequence(F.lit(0), F.col("up") - 1), lambda t: F.struct(
            F.col("band").alias("b1"), F.col("c").alias("c1"), (F.col("band") + 1).alias("b2"), t.alias("c2")))).otherwise(F.array()),
        F.when(F.col("down") > 0, F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda t: F.struct(
            (F.col("band") - 1).alias("b1"), t.alias("c1"), F.col("band").alias("b2"), F.col("c").alias("c2")))).otherwise(F.array()))
    placed = banded.join(sized, ["grp", "band"]).withColumn("c", own)
    placed = placed.select("grp", "doc_id", "n", "band", "c", F.explode(pairs).alias("meet")).withColumn(
        "left", (F.col("band") == F.col("meet.b1")) & (F.col("c") == F.col("meet.c1")))
    placed = written(placed.select("doc_id", "n", "grp", "meet.b1", "meet.c1", "meet.b2", "meet.c2", "left"), "placed")
    full = placed.join(sets.select("doc_id", "tokens"), "doc_id").select("grp", "b1", "c1", "b2", "c2", "doc_id", "n", "left", "tokens")

    def run(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("doc_id").to_pylist(), dtype=np.int64)
        sizes = np.array(table.column("n").to_pylist(), dtype=np.int64)
        left = np.array(table.column("left").to_pylist(), dtype=bool)
        edges: list[tuple[int, int]] = []
        if len(ids) > 1 and left.any():
            tokens = [t.values.to_numpy(zero_copy_only=False) for chunk in table.column("tokens").chunks for t in chunk]
            edges = stars(ids, sizes, tokens, left, least, of)
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return full.groupBy("grp", "b1", "c1", "b2", "c2").applyInArrow(run, "a long, b long")


def similar(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, least: int = 80, of: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id (smallest key with an equal set)."""
    share = -(-of // (2 * (of - least)))  # a part of the hash space that holds about twice the slack
    source = df.select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_t")).filter("_k is not null")
    # One scan gives all documents' set keys and the tokens in the fixed part of the hash space.
    probe = written(token_sets(source, "_k", "_t", width, share), "probe")
    smallest = -(-least // (of - least))  # a set that links with a different one has so many tokens at least
    classes = written(probe.filter("n > 0").groupBy("set_key", "n").agg(F.min("doc_id").alias("class_id")), "classes")

    # 2. elimination: a token of one set alone is missing in every other; too many of them leave no link
    set_id = F.xxhash64("set_key").alias("set_id")
    owners = probe.filter(F.col("n") >= smallest).select(set_id, F.explode("tokens").alias("token"))
    owners = owners.groupBy("token").agg(F.min("set_id").alias("set_id"), F.max("set_id").alias("other"))
    single = written(owners.filter("set_id = other").groupBy("set_id").agg(F.count(F.lit(1)).alias("single")), "single")
    spare = F.col("n") - F.ceil(F.col("n") * least / of)
    alive = written(
        classes.filter(F.col("n") >= smallest).withColumn("set_id", F.xxhash64("set_key")).join(single, "set_id", "left")
        .filter(F.coalesce("single", F.lit(0)) <= spare)
        .groupBy(F.col("class_id").alias("_k")).agg(F.min("set_key").alias("_set")), "alive")

    # 3. index of the documents left
    texts = perhaps_in(source, "_k", alive, "_may").filter("_may").drop("_may").join(alive, "_k")
    sets = written(token_sets(texts, "_k", "_t", width, only="_set").select("doc_id", "n", "tokens"), "sets")
    spread = sets.select("doc_id", "n", F.explode("tokens").alias("token"))
    counts = written(spread.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "counts")
    ranked = spread.join(counts, "token").groupBy("doc_id", "n").agg(F.collect_list(F.struct("df", "token")).alias("ranked"))
    index = written(_index(ranked, least, of), "index")
    hubs = written(index.groupBy("entry").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).filter("hub < last").select("entry", "hub"), "hubs")
    candidates = written(index.join(hubs, "entry").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).filter("a <> b").distinct(), "candidates")

    # 4. exact test inside candidate groups, 5. components of the links
    groups = components(candidates)
    members = sets.select("doc_id", "n").distinct().join(groups.select(F.col("node").alias("doc_id"), F.col("root").alias("grp")), "doc_id")
    linked = components(written(_verified(members, sets, least, of), "links"))

    final = written(classes.join(linked.select(F.col("node").alias("class_id"), "root"), "class_id", "left")
                    .select("set_key", "class_id", F.coalesce("root", "class_id").alias("component_id")), "final")
    return probe.select("doc_id", "n", "set_key").join(final, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("class_id", "doc_id").alias("class_id"))
