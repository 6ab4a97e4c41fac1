"""Ranked lexical search: accumulators of short lists inside a document-at-a-time search of long ones.

The queries are the items; in blocks of at most ``BLOCK_TERMS`` terms their vocabulary goes to all
tasks. One pass over the whole texts writes, for each document, its number of terms and its
occurrences of query terms; the numbers of documents and terms and the document frequencies are
aggregates of that. The second pass reads these rows and makes an inverted index of each batch
of documents: one list per term. Per item the lists of a batch are parted by length.

* The short ones are taken term at a time: their scores are added up in one array of accumulators, whose
  filled places, in ascending order and with the largest sum as a bound, become one list among the others.
* The long ones are searched a document at a time, a range of documents by another, with that list as one of the
  iterators. As soon as ten documents are known, lists whose bounds together stay below the tenth score
  cannot bring in a document: only documents of the remaining lists are candidates. A range whose
  bounds cannot reach the tenth score is skipped, and a candidate is given up as soon as what it has and the
  bounds of the lists not yet looked at fall short.

Bounds are the exact maxima of the batch, and equal scores are kept, so the result is the exact ranking.
Every task hands on its best rows per item; a limit per item before and after the shuffle gives the result.

Null texts and texts without terms match nothing. Rows of one item id are one item with the terms of
all of them; a null item id is an item of its own. Repeated documents count and are listed as often as
they occur; a document without id is listed with a null id, behind equals. An empty table of either kind
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.terms import places, slices
from dossier.session import written

BEST = 10
#: Terms (an item's terms counted per item) whose search is one pass over the documents.
BLOCK_TERMS = 1_000_000
#: A list is long if it holds more than this share of a batch's documents.
LONG_SHARE = 1 / 16
#: Documents in a range of the document-at-a-time search.
RANGE = 512
SCALE = 1_000_000_000
_NO_ID = np.iinfo(np.int64).max


def item_terms(text: str | None) -> list[bytes]:
    """Distinct terms of one item's text."""
    return sorted({w for part in slices(pa.array([text], pa.string())) for w in part.words.to_pylist()})


def query_blocks(items: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of bounded size; one partition of them at a time is on the driver."""
    rows = items.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).repartitionByRange("k").sortWithinPartitions("k")
    block: list[tuple[int | None, set[bytes]]] = []
    size = 0
    for row in rows.toLocalIterator():
        if not block or block[-1][0] != row["k"]:
            if size >= BLOCK_TERMS:
                yield [(k, sorted(t)) for k, t in block]
                block, size = [], 0
            block.append((row["k"], set()))
        terms = item_terms(row["t"])
        block[-1][1].update(terms)
        size += len(terms)
    if block:
        yield [(k, sorted(t)) for k, t in block]


def occurrences(documents: DataFrame, vocabulary: list[bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with a term: doc_id, n (all its terms), terms (places of known ones) and tfs."""
    known = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        listed = pa.array(known.value, pa.large_binary())
        for batch in batches:
            for part in slices(batch.column(1)):
                n = np.bincount(part.text, minlength=part.texts)
                at = places(part.words, listed)
                code = part.text[at >= 0].astype(np.int64) * max(1, len(listed)) + at[at >= 0]
                code, tfs = np.unique(code, return_counts=True)
                doc, term = code // max(1, len(listed)), code % max(1, len(listed))
                offsets = pa.array(np.searchsorted(doc, np.arange(part.texts + 1)), pa.int32())
                rows = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.texts), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])
                yield rows.filter(pa.array(n > 0))

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) as integers."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def best_of_batch(lists: list[tuple[int, int, int]], docs: np.ndarray, gains: np.ndarray, n_docs: int, best: list[tuple[int, int]],
                  ids: np.ndarray, most: int = BEST, long_share: float = LONG_SHARE, width: int = RANGE) -> int:
    """Bring the documents of one batch into ``best``, a heap of (score, -id). Returns how many were scored in full.

    ``lists`` has (start, end, weight) into ``docs`` (places in the batch, ascending) and ``gains``.
    """
    long, sums = [], None
    for start, end, w in lists:
        if end - start > long_share * n_docs:
            long.append((start, end, w, w * int(gains[start:end].max())))
        else:  # term at a time
            if sums is None:
                sums = np.zeros(n_docs, np.int64)
            sums[docs[start:end]] += w * gains[start:end]
    long.sort(key=lambda x: x[3])
    bounds = np.cumsum([x[3] for x in long], dtype=np.int64)
    iterators = []  # (documents, scores) in ascending order of documents
    if sums is not None:
        filled = np.flatnonzero(sums)
        iterators.append((filled, sums[filled]))
    iterators += [(docs[s:e], w * gains[s:e]) for s, e, w, _ in reversed(long)]  # by falling bound
    scored = 0
    for low in range(0, n_docs, width):
        part = []
        for places_, scores in iterators:
            a, b = np.searchsorted(places_, (low, low + width))
            part.append((places_[a:b] - low, scores[a:b]))
        least = best[0][0] if len(best) >= most else 1
        # Lists from the lowest bound on that together stay below the least score bring in no document.
        idle = min(int(np.searchsorted(bounds, least, "left")), len(part))
        wanted = part[: len(part) - idle]
        if not wanted or sum(int(s.max()) for _, s in part if len(s)) < least:
            continue
        score, held = np.zeros(width, np.int64), np.zeros(width, bool)
        for at, s in wanted:
            score[at] += s
            held[at] = True
        candidates = np.flatnonzero(held)
        total = score[candidates]
        for k in range(len(wanted), len(part)):
            kept = total + bounds[len(part) - k - 1] >= least
            candidates, total = candidates[kept], total[kept]
            if not len(candidates):
                break
            more = np.zeros(width, np.int64)
            more[part[k][0]] = part[k][1]
            total = total + more[candidates]
        scored += len(candidates)
        for at in np.flatnonzero(total >= least):
            entry = (int(total[at]), -int(ids[low + candidates[at]]))
            if entry[0] <= 0:
                continue
            if len(best) < most:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return scored


def ranked_block(documents: DataFrame, items: list[tuple[int | None, list[bytes]]], key: str, text: str, most: int) -> DataFrame:
    """Best rows per item and task: item_id, doc_id, score."""
    spark = documents.sparkSession
    vocabulary = sorted({t for _, terms in items for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    found = written(occurrences(documents, vocabulary, key, text), "occurrences")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).head()
    counts = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()  # one per query term
    df = np.zeros(len(vocabulary), np.int64)
    for row in counts:
        df[row["term"]] = row["df"]
    asked = spark.sparkContext.broadcast([(k, np.array([place[t] for t in terms], np.int64)) for k, terms in items])
    weight = spark.sparkContext.broadcast(weights(n_docs, df))

    def search(batches):
        best: list[list[tuple[int, int]]] = [[] for _ in asked.value]
        w = weight.value
        for batch in batches:
            n = batch.column(1).to_numpy()
            ids = batch.column(0).fill_null(_NO_ID).to_numpy()
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            offsets, term = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            tf = batch.column(3).values.to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(n)), np.diff(offsets))
            term, tf = term[offsets[0]:offsets[-1]], tf[offsets[0]:offsets[-1]]
            gain = (SCALE * tf) // (1000 * tf + 8 * m[doc])
            order = np.argsort(term, kind="stable")  # documents stay in order
            term, doc, gain = term[order], doc[order], gain[order]
            start = np.searchsorted(term, np.arange(len(w) + 1))
            for heap, (_, terms) in zip(best, asked.value):
                here = terms[(start[terms + 1] > start[terms]) & (w[terms] > 0)]
                lists = [(int(start[t]), int(start[t + 1]), int(w[t])) for t in here]
                if lists:
                    best_of_batch(lists, doc, gain, len(n), heap, ids, most)
        rows = [(k, None if d == -_NO_ID else -d, s) for heap, (k, _) in zip(best, asked.value) for s, d in heap]
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("item_id", "doc_id", "score"), r)) for r in rows],
                                             pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]))

    return found.select("doc_id", "n", "terms", "tfs").mapInArrow(search, "item_id long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", most: int = BEST) -> DataFrame:
    """The ``most`` best documents of each item: item_id, rank, doc_id, score."""
    blocks = [written(ranked_block(documents, block, key, text, most), "best") for block in query_blocks(items, item, text)]
    if not blocks:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = blocks[0]
    for block in blocks[1:]:
        found = found.unionByName(block)
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
            .select("item_id", "rank", "doc_id", "score"))
