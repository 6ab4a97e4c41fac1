"""Document fingerprints by weighted sign votes, and search by permuted block tables.

Built-in functions only. The terms of a text are the pairs of neighbouring words (lower-cased runs of
letters and digits); a text of one word has that word. A term weighs one to three votes, more the
longer its words are, since long ones say more about a text. Each occurrence votes with its weight
for every set bit of the term's hash and against every other; a bit of the fingerprint is set if the
votes for it prevail.

Votes are counted in two steps, both combined inside tasks. For each ``CHUNK`` terms of a text eight
counters share a long, which ``CHUNK`` times the highest weight cannot fill; the chunks of a text are then added
up with two counters of 32 bits to a long. No text is ever one array of hashes in a shuffle.

Fingerprints within a Hamming radius agree on at least ``extra`` of ``radius + extra`` blocks of
bits. ``near`` keeps one table for each choice of ``extra`` blocks, permuted so that these
blocks are the key, and joins on the keys; the distance is tested after that and each pair counts
in the first table that holds it.

Null and empty texts and texts without words have the fingerprint of zeros, which is as near to
itself as equal texts are. Ties of votes leave a bit unset. Repeated rows stay repeated and get equal
fingerprints; further columns, also those with names used here, are carried through or ignored.
An empty table gives an empty table.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.operators.skew import bucketed, known, split_points
from dossier.session import written

BITS = 128
RADIUS = 3
#: Terms for which eight counters share a long; with at most three votes each, no counter passes 127.
CHUNK = 42
EXTRA = 2
#: Ranges of ids for each shuffle partition, so that hashing them to partitions keeps these even.
RANGES = 8
_EIGHT = 0x0101_0101_0101_0101
_TWO = 0xFF_0000_00FF
_LOW = 0xFFFF_FFFF
_WORDS = [f"_w{i}" for i in range(BITS // 64)]


def terms(text: Column) -> Column:
    """Hash of every term occurrence of a text, with the term's weight in the lowest two bits."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def term(letters: Column, *parts: Column) -> Column:
        votes_ = F.when(letters <= 6, F.lit(1)).when(letters <= 12, F.lit(2)).otherwise(F.lit(3)).cast("long")
        return F.xxhash64(*parts).bitwiseAND(F.lit(-4).cast("long")).bitwiseOR(votes_)

    def of(w: Column) -> Column:
        pairs = F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w)), lambda a, b: term(F.length(a) + F.length(b), a, b))
        return F.when(F.size(w) > 1, pairs).otherwise(F.transform(w, lambda a: term(F.length(a), a)))

    return F.flatten(F.transform(F.array(words), of))  # the words are named once, so they are made once


def votes(rows: DataFrame, by: list[str], listed: Column) -> DataFrame:
    """One row per group: the fingerprint of its terms as longs ``_w0``, ``_w1``, ... of 64 bits each."""
    each = rows.select(*by, F.posexplode_outer(listed).alias("_at", "_term"))
    chunks = each.select(
        *by, F.floor(F.col("_at") / CHUNK).alias("_chunk"), F.coalesce(F.col("_term").bitwiseAND(F.lit(3)), F.lit(0)).alias("_v"),
        *[F.xxhash64(F.lit(i), "_term").alias(f"_h{i}") for i in range(len(_WORDS))])
    spread = lambda i, k: F.shiftright(F.col(f"_h{i}"), k).bitwiseAND(F.lit(_EIGHT))
    chunks = chunks.groupBy(*by, "_chunk").agg(
        F.sum("_v").alias("_all"), *[F.sum(F.col("_v") * spread(i, k)).alias(f"_c{i}_{k}") for i in range(len(_WORDS)) for k in range(8)])
    two = lambda i, k, j: F.shiftright(F.col(f"_c{i}_{k}"), 8 * j).bitwiseAND(F.lit(_TWO))
    counted = chunks.groupBy(*by).agg(
        F.sum("_all").alias("_all"),
        *[F.sum(two(i, k, j)).alias(f"_s{i}_{8 * j + k}") for i in range(len(_WORDS)) for j in range(4) for k in range(8)])

    def word(i: int) -> Column:
        set_ = lambda count: F.when(count * 2 > F.col("_all"), F.lit(1)).otherwise(F.lit(0)).cast("long")
        bits = F.transform(F.array(*[F.col(f"_s{i}_{k}") for k in range(32)]), lambda s, k: F.call_function(
            "shiftleft", F.shiftleft(set_(F.shiftrightunsigned(s, 32)), 32).bitwiseOR(set_(s.bitwiseAND(F.lit(_LOW)))), k))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return counted.select(*by, *[word(i).alias(name) for i, name in enumerate(_WORDS)])


def shown(words: list[Column]) -> Column:
    """Fingerprint as lower-case hex digits."""
    return F.concat(*[F.lpad(F.lower(F.hex(w)), 16, "0") for w in words])


def read(fingerprint: Column) -> list[Column]:
    """The longs behind the hex digits."""
    half = lambda at: F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("long")
    return [F.shiftleft(half(1 + 16 * i), 32).bitwiseOR(half(9 + 16 * i)) for i in range(len(_WORDS))]


def distance(a: list[Column], b: list[Column]) -> Column:
    """Number of different bits."""
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / BITS


def in_order(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in ascending order of their ids, each with the text of the one after it.

    Columns: ``_range`` and ``_place`` (which identify a row), ``_copy``, ``doc_id``, ``t``, ``next``.
    Ids are cut into ranges of about equal numbers, several for each partition, and texts are
    shuffled once. A range also holds a copy of the first document of the range after it
    (``_copy``; the last range that of the very first), so every document meets its next one.
    Rows of one id follow each other by text. Rows without id have no place in the order and drop out.
    """
    parts = RANGES * max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = known(documents.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("t")), ["doc_id"])
    points = split_points(rows.select("doc_id"), "doc_id", max(8, parts))
    cut = bucketed(rows, "doc_id", points, "_range").withColumn("_range", F.col("_range").cast("int"))
    across = Window.orderBy("_range")
    firsts = cut.groupBy("_range").agg(F.min("doc_id").alias("_first"))
    # At most one row per range: fewer than RANGES for each shuffle partition.
    firsts = written(firsts.select("_first", F.coalesce(F.lag("_range").over(across), F.max("_range").over(
        across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before")), "range-starts")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy"))
    copied = F.struct(F.col("_before").alias("r"), F.lit(True).alias("copy"))
    placed = (cut.join(F.broadcast(firsts), cut["doc_id"] == firsts["_first"], "left")
              .select("doc_id", "t", F.explode(F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, copied))).alias("_at")))
    order = Window.partitionBy("_range").orderBy("_copy", "doc_id", "t")
    placed = placed.select(F.col("_at.r").alias("_range"), F.col("_at.copy").alias("_copy"), "doc_id", "t")
    return placed.select("*", F.row_number().over(order).alias("_place"), F.lead("t").over(order).alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by the first characters of the following text."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def drift(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each document, of the document with its last quarter overwritten, and their likeness.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Rows without id have no next document: they get a fingerprint, and null in the other columns
    that need one.
    """
    rows = in_order(documents, key, text).withColumn("_edited", F.when(~F.col("_copy"), edited(F.col("t"), F.col("next"))))
    facts = ["_range", "_place", "_copy", "doc_id", "n_chars", "sha"]
    both = rows.select("_range", "_place", "_copy", "doc_id", F.length("t").cast("long").alias("n_chars"),
                       F.sha2(F.encode("_edited", "UTF-8"), 256).alias("sha"),
                       F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("t").alias("t")),
                                         F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("t")))).alias("x"))
    kinds = both.filter("x.kind = 0 or not _copy").select(*facts, F.col("x.kind").alias("_kind"), "x.t")
    marks = votes(kinds, [*facts, "_kind"], terms(F.col("t")))
    pick = lambda kind: F.max(F.when(F.col("_kind") == kind, F.struct(*_WORDS)))
    wide = marks.groupBy(*facts).agg(pick(0).alias("_own"), pick(1).alias("_new"))
    order = Window.partitionBy("_range").orderBy("_copy", "doc_id", "_place")
    wide = wide.withColumn("_next", F.lead("_own").over(order)).filter(~F.col("_copy"))
    longs = lambda name: [F.col(f"{name}.{w}") for w in _WORDS]
    out = wide.select("doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
                      shown(longs("_own")).alias("fingerprint"), shown(longs("_new")).alias("edited_fingerprint"),
                      likeness(longs("_own"), longs("_new")).alias("near_edited"), likeness(longs("_own"), longs("_next")).alias("near_next"))
    nameless = fingerprints(documents.filter(F.col(key).isNull()), key, text)
    null = lambda kind: F.lit(None).cast(kind)
    return out.unionByName(nameless.select("doc_id", "n_chars", null("string").alias("edited_sha256"), "fingerprint",
                                           null("string").alias("edited_fingerprint"), null("double").alias("near_edited"), null("double").alias("near_next")))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, fingerprint."""
    by = ["doc_id", "n_chars", "_row"]
    listed = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("_row"), F.col(text).alias("t"))
    marks = votes(listed, by, terms(F.col("t")))
    return marks.select("doc_id", "n_chars", shown([F.col(w) for w in _WORDS]).alias("fingerprint"))


def blocks(radius: int, extra: int = EXTRA) -> list[list[int]]:
    """Masks (one per long) of ``radius + extra`` blocks of neighbouring bits that are about equally long."""
    number = radius + extra
    cuts = [round(BITS * i / number) for i in range(number + 1)]
    masks = []
    for low, high in zip(cuts, cuts[1:]):
        whole = (1 << high) - (1 << low)
        masks.append([(whole >> 64 * i) & (2**64 - 1) for i in range(len(_WORDS))])
    return masks


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def tables(radius: int = RADIUS, extra: int = EXTRA) -> list[list[int]]:
    """Masks of the key of each permuted table: every choice of ``extra`` blocks."""
    parts = blocks(radius, extra)
    return [[reduce(lambda a, b: a | b, (parts[c][i] for c in chosen)) for i in range(len(_WORDS))]
            for chosen in combinations(range(radius + extra), extra)]


def near(marks: DataFrame, radius: int = RADIUS, extra: int = EXTRA, queries: DataFrame | None = None) -> DataFrame:
    """All pairs of different fingerprints within ``radius``: a, b, distance.

    Fingerprints stand for all documents that share them, so copies make no pairs. Without
    ``queries`` each pair is listed once (a < b); with them a is a fingerprint of the queries.
    Tables of keys are written, and hot keys are split by the adaptive skew join.
    """
    masks = tables(radius, extra)
    assert len(masks) == math.comb(radius + extra, extra)

    def keyed(rows: DataFrame, name: str) -> DataFrame:
        distinct = rows.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct()
        longs = read(F.col(name))
        keys = F.array(*[F.struct(F.lit(t).alias("table"), *[w.bitwiseAND(_signed(m)).alias(f"k{i}") for i, (w, m) in enumerate(zip(longs, mask))])
                         for t, mask in enumerate(masks)])
        return written(distinct.select(name, F.explode(keys).alias("k")).select(name, "k.*"), "tables")

    key = ["table", *[f"k{i}" for i in range(len(_WORDS))]]
    right = keyed(marks, "b")
    left = right.withColumnRenamed("b", "a") if queries is None else keyed(queries, "a")
    order = F.col("a") < F.col("b") if queries is None else F.col("a") != F.col("b")
    difference = [x.bitwiseXOR(y) for x, y in zip(read(F.col("a")), read(F.col("b")))]
    agree = lambda mask: reduce(lambda p, q: p & q, [d.bitwiseAND(_signed(m)) == 0 for d, m in zip(difference, mask)])
    first = reduce(lambda rest, t: F.when(agree(masks[t]), F.lit(t)).otherwise(rest), reversed(range(len(masks))), F.lit(len(masks)))
    return (left.join(right, key).filter(order).withColumn("distance", distance(read(F.col("a")), read(F.col("b"))))
            .filter((F.col("distance") <= radius) & (F.col("table") == first)).select("a", "b", "distance"))


def near_counts(marks: DataFrame, radius: int = RADIUS, extra: int = EXTRA) -> DataFrame:
    """One row per fingerprint with company: fingerprint, n_near, the other documents within ``radius``, copies included."""
    sizes = written(marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")), "sizes")
    pairs = written(near(sizes, radius, extra), "near")
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(sizes.withColumnRenamed("fingerprint", "b"), "b").select(F.col("a").alias("fingerprint"), "n")
    copies = sizes.filter("n > 1").select("fingerprint", (F.col("n") - 1).alias("n"))
    return others.unionByName(copies).groupBy("fingerprint").agg(F.sum("n").alias("n_near"))
