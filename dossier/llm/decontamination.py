"""Benchmark decontamination by template windows, with built-in functions only.

White space is collapsed, and texts become templates: numbers, names (words that begin with a large and a small
letter) and units are replaced by typed placeholders, letters are lowered, punctuation goes. The first word of a sentence
may be a name or not, so windows with such words have two templates, with and without a slot for them. All windows
of ``WINDOW`` template words of the texts are hash-joined with those of the benchmark
items, so a question with other numbers and names still matches. The slots of windows
that continue each other are compared with one assignment: the most frequent text value of
each item value. Two item values may share a text value by chance; only those that both
recur in the run must stay apart. A text is contaminated if all slots but one, or the share
``FIT`` of them, keep to the assignment, or a window repeats the item's own values.

A template window needs at least half its words outside slots, a template shorter than a window
``LEAST`` words. Whatever these rules drop is matched by its own lower-cased words: every window
has a second hash, of the words with their values, joined in the same join. Items shorter than a
window are matched as a whole; those of fewer than ``EXACT_LEAST`` words, which occur in any text
by chance, where they are a whole line. Characters of scripts without spaces are words of their
own; of an item that consists mostly of them, twice as many count as a window, as ``LEAST`` and as
``EXACT_LEAST``. Items with equal words are one item, the smallest
id. Null and empty texts and items match nothing; a null doc_id is kept in the result
when its text matches, as one more document. Repeated rows of a doc_id count as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.common import fresh, written

WINDOW = 8
LEAST = 5
EXACT_LEAST = 3
FIT = 2 / 3
#: So many windows of the benchmark, three numbers each, are sent to all tasks.
BROADCAST_WINDOWS = 1 << 18
#: Characters of scripts that are written without spaces (Thai, Lao, Burmese, Khmer, kana, Han).
UNSPACED = "[\u0e00-\U0003ffff&&[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]]"
#: Units of measure, as they follow a number.
UNITS = ("kilometers kilometres meters metres centimeters millimeters miles feet foot inches inch yards km cm mm kg kilograms grams mg lb lbs "
         "pounds tons tonnes liters litres ml gallons hours hour hrs minutes minute min seconds second sec days day weeks week months month years "
         "year dollars dollar cents cent euros euro percent degrees mph kmh kwh watts volts hz ghz mhz gb mb kb usd eur").split()


def marked_words(text: Column) -> Column:
    """Words with slots marked: 01, the type (D, N, U, or M for a large first letter at the start of a sentence), and the value.

    Each pattern begins with what is rare in a text, and passes are left out for texts that they cannot change.
    """
    text = F.coalesce(text, F.lit(""))
    t = F.when(F.octet_length(text) == F.length(text), text).otherwise(F.regexp_replace(text, "(" + UNSPACED + ")", " $1 "))
    gap = r"\s\p{Z}\x01\x02\x85"
    t = F.regexp_replace(t, f"(?: (?=[{gap}])|[{gap}&&[^ ]])[{gap}]*", " ")
    t = F.regexp_replace(t, r"(?=\p{Lu}\p{Ll})(?<=[\p{L}\p{N},;] )", "\x01N")
    t = F.regexp_replace(t, r'(?=\p{Lu}\p{Ll})(?<![^ \p{Ps}\p{Pi}"*_>])', "\x01M")
    t = F.lower(F.regexp_replace(t, r"(?=\p{N})(?<![\x01\p{L}\p{N}])", "\x01D"))
    # Named once, as the condition would make it anew otherwise.
    t = F.transform(F.array(t), lambda t: F.when(F.contains(t, F.lit("\x01d")), F.regexp_replace(
        t, r"(\x01d[\p{N}.,:/-]*) ?(" + "|".join(UNITS) + r")(?![\p{L}\p{N}])", "$1 \x01u$2")).otherwise(t))[0]
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}\s\x01]+", ""), r"\s(?=\s)", ""))
    return F.array_remove(F.split(t, " "), "")


def _value(word: Column) -> Column:
    return F.regexp_replace(word, "\x01.", "")


def template(words: Column, first: bool = False) -> Column:
    """The words with the values of slots removed; with ``first``, words at the start of a sentence are slots too."""
    return F.transform(words, lambda w: F.when(w.startswith("\x01m"), F.lit("\x01n") if first else _value(w))
                       .when(w.startswith("\x01"), F.substring(w, 1, 2)).otherwise(w))


def plain(words: Column) -> Column:
    """The words without marks, slots with their values."""
    return F.transform(words, lambda w: F.when(w.startswith("\x01"), _value(w)).otherwise(w))


def word_hash(word: Column) -> Column:
    """A hash of 59 bits, so that those of a window add up without overflow."""
    return F.shiftrightunsigned(F.xxhash64(word), 5)


def window_sums(hashes: Column, width: int) -> Column:
    """Sum of the word hashes of every window: sums of 1, 2, 4, ... neighbours, put together by the bits of the width.

    The order of words does not count here; the words themselves are compared after the join.
    """
    def added(a: Column, b: Column, shift: int) -> Column:
        size = F.size(b) - shift
        return F.when(size > 0, F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(shift + 1), size), lambda x, y: x + y)).otherwise(
            F.array().cast("array<bigint>"))

    def bound(array: Column, use) -> Column:
        return F.flatten(F.transform(F.array(array), use))  # names the array, so it is made once

    def step(power: Column, length: int, total: Column | None, done: int) -> Column:
        if width & length:
            total, done = (power, length) if total is None else (added(total, power, done), done + length)
        if done == width:
            return total
        return bound(added(power, power, length), lambda doubled: step(doubled, 2 * length, total, done))

    return bound(hashes, lambda h: step(h, 1, None, 0))


def hashed_words(words: Column) -> dict[str, Column]:
    """Word hashes of the words themselves (x), of the template (t) and of the one with slots at the start of sentences (f).

    A text without a slot of the first kind has t equal to x; t is null then, and so is f in a text without any slot.
    """
    mark = lambda w: w.startswith("\x01")
    first = lambda w: w.startswith("\x01m")
    slot = lambda w: word_hash(F.substring(w, 1, 2))
    value = lambda w: word_hash(_value(w))
    start = F.lit("\x01n")
    return {
        "x": F.transform(words, lambda w: F.when(mark(w), value(w)).otherwise(word_hash(w))),
        "t": F.when(F.exists(words, lambda w: mark(w) & ~first(w)), F.transform(
            words, lambda w: F.when(mark(w), F.when(first(w), value(w)).otherwise(slot(w))).otherwise(word_hash(w)))),
        "f": F.when(F.exists(words, mark), F.transform(
            words, lambda w: F.when(mark(w), F.when(first(w), word_hash(start)).otherwise(slot(w))).otherwise(word_hash(w))))}


def any_window_sums(hashes: Column, width: Column) -> Column:
    """The same for a width from a column, window by window."""
    last = F.size(hashes) - width + 1
    summed = F.transform(F.sequence(F.lit(1), last), lambda i: F.aggregate(F.slice(hashes, i, width), F.lit(0).cast("bigint"), lambda a, b: a + b))
    return F.when(last >= 1, summed).otherwise(F.array().cast("array<bigint>"))


def all_hashes(width: int | Column) -> Column:
    """Per window its hashes from the columns x, t and f; t is null where it equals x, f where it equals t or x."""
    sums = window_sums if isinstance(width, int) else any_window_sums
    x = sums(F.col("x"), width)
    none = F.transform("x", lambda h: F.lit(None).cast("bigint"))
    t = F.when(F.col("t").isNull(), none).otherwise(sums(F.col("t"), width))
    f = F.when(F.col("f").isNull(), none).otherwise(sums(F.col("f"), width))
    both = F.zip_with(x, t, lambda x, t: F.struct(x.alias("x"), F.when(t != x, t).alias("t")))
    return F.filter(F.zip_with(both, f, lambda b, f: F.struct(
        b["x"].alias("x"), b["t"].alias("t"), F.when(f != F.coalesce(b["t"], b["x"]), f).alias("f"))), lambda w: w["x"].isNotNull())


def benchmark_items(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """One row per item: item_id, words (marked), scale (2 for scripts without spaces, else 1)."""
    words = items.select(F.col(key).cast("long").alias("item_id"), marked_words(F.col(text)).alias("words"))
    words = words.groupBy("words").agg(F.min("item_id").alias("item_id")).filter(F.size("words") > 0)
    single = F.size(F.filter("words", lambda w: w.rlike("^" + UNSPACED + "$")))
    return words.select("item_id", "words", F.when(single * 2 > F.size("words"), 2).otherwise(1).alias("scale"))


def benchmark_windows(words: DataFrame) -> DataFrame:
    """One row per window hash and item: item_id, words (marked), j, width, window."""
    words = words.filter(F.size("words") >= EXACT_LEAST * F.col("scale")).withColumns({
        "width": F.least(F.size("words"), WINDOW * F.col("scale")), **hashed_words(F.col("words"))})
    rows = words.select("item_id", "words", "width", "scale", F.posexplode(all_hashes(F.col("width"))).alias("j", "w"))
    part = F.slice("words", F.col("j") + 1, F.col("width"))
    first = F.size(F.filter(part, lambda w: w.startswith("\x01m")))
    every = F.size(F.filter(part, lambda w: w.startswith("\x01")))
    # A window without slots has one hash, which is exact.
    kept = lambda slots: (slots == 0) | ((slots * 2 <= F.col("width")) & (F.size("words") >= LEAST * F.col("scale")))
    return rows.select("item_id", "words", "width", "j", F.explode(F.array(
        F.when(kept(every - first), F.col("w.t")), F.when(kept(every), F.col("w.f")), F.col("w.x"))).alias("window")).filter("window is not null")


def line_matches(source: DataFrame, short: DataFrame) -> DataFrame:
    """Items of too few words that are a whole line of a text; columns as ``matches``."""
    text = F.array_join(plain(F.col("words")), " ")
    lines = source.select("doc_id", F.posexplode(F.split("t", "[\n\x0b\f\r\x85\u2028\u2029]+")).alias("at", "line"))
    lines = lines.select("doc_id", "at", marked_words(F.col("line")).alias("words")).filter(F.size("words") < EXACT_LEAST * 2)
    short = short.select("item_id", text.alias("line"))
    return (lines.select("doc_id", "at", text.alias("line")).join(short, "line")
            .groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("windows"), F.lit(True).alias("same_values")))


def unfit(slots: Column) -> Column:
    """How many slots (at, a of the text, b of the item) break the best assignment."""
    def number(kept: Column) -> Column:
        return F.size(F.filter(slots, kept))

    pairs = F.array_distinct(F.transform(slots, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"))))
    counted = F.transform(pairs, lambda p: F.struct(
        p["a"].alias("a"), p["b"].alias("b"), number(lambda s: (s["a"] == p["a"]) & (s["b"] == p["b"])).alias("n"),
        number(lambda s: s["b"] == p["b"]).alias("recurs")))

    def beyond_best(rows: Column, by: str) -> Column:
        """Slots in rows, less those of the most frequent pair of each value."""
        best = F.transform(F.array_distinct(F.transform(rows, lambda r: r[by])),
                           lambda v: F.array_max(F.transform(F.filter(rows, lambda r: r[by] == v), lambda r: r["n"])))
        total = lambda ns: F.aggregate(ns, F.lit(0), lambda x, n: x + n)
        return total(F.transform(rows, lambda r: r["n"])) - total(best)

    return beyond_best(counted, "b") + beyond_best(F.filter(counted, lambda r: (r["recurs"] > 1)), "a")


def matches(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, windows, same_values.

    The benchmark's windows are written and counted. Up to ``BROADCAST_WINDOWS`` go to all tasks, and a
    hit takes its words along, so texts are read once and not shuffled. More are joined by shuffling
    hashes, and the texts with a hit are read again for their words.
    """
    words = written(benchmark_items(items), "bench-items")
    bench = written(benchmark_windows(words), "bench")
    short = words.filter(F.size("words") < EXACT_LEAST * F.col("scale"))
    widths = sorted(r["width"] for r in bench.select("width").distinct().collect())  # at most 2 * WINDOW values
    few = bench.count() <= BROADCAST_WINDOWS
    source = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("t"))
    marked = source.select("doc_id", marked_words(F.col("t")).alias("words"))
    carried = ["words"] if few else []
    hashed = marked.select("doc_id", *carried, *[h.alias(name) for name, h in hashed_words(F.col("words")).items()])
    windows = F.array().cast("array<struct<width:int,window:array<struct<x:bigint,t:bigint,f:bigint>>>>")
    if widths:
        windows = F.array(*[F.struct(F.lit(w).alias("width"), all_hashes(w).alias("window")) for w in widths])
    exploded = (hashed.select("doc_id", *carried, F.explode(windows).alias("w"))
                .select("doc_id", *carried, F.col("w.width").alias("width"), F.posexplode("w.window").alias("i", "w"))
                .select("doc_id", *carried, "width", "i", F.explode(F.array("w.x", "w.t", "w.f")).alias("window")).filter("window is not null"))
    part = lambda name, at: F.slice(F.col(name), F.col(at) + 1, F.col("width"))
    keys = bench.select("window", "width", "item_id", "j")
    if few:
        found = exploded.join(F.broadcast(keys), ["window", "width"]).select("doc_id", "item_id", "width", "i", "j", part("words", "i").alias("a"))
        hits = written(found.distinct(), "hits")
    else:
        found = written(exploded.join(keys, ["window", "width"]).select("doc_id", "item_id", "width", "i", "j").distinct(), "hits")
        ids = found.select(F.col("doc_id").alias("_d")).distinct()
        texts = marked.join(ids, F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi").withColumnRenamed("doc_id", "_d")
        hits = (texts.join(found, F.col("doc_id").eqNullSafe(F.col("_d"))).filter(F.col("i") + F.col("width") <= F.size("words"))
                .select("doc_id", "item_id", "width", "i", "j", part("words", "i").alias("a")))

    item_words = written(bench.select("item_id", F.col("words").alias("item_words")).distinct(), "items")
    both = (
        hits.join(item_words, "item_id")
        .select("doc_id", "item_id", "i", "j", "a", part("item_words", "j").alias("b"))
        .withColumn("same", plain(F.col("a")) == plain(F.col("b")))
        .filter((template(F.col("a")) == template(F.col("b"))) | (template(F.col("a"), True) == template(F.col("b"), True)) | F.col("same")))
    named = lambda w: F.regexp_replace(w, "^\x01m", "\x01n")
    slots = F.filter(
        F.transform(F.arrays_zip("a", "b"), lambda p, k: F.struct((F.col("j") + k).alias("at"), named(p["a"]).alias("a"), named(p["b"]).alias("b"),
                                                                      (p["a"].startswith("\x01m") & (p["a"] == p["b"])).alias("word"))),
        lambda p: p["a"].startswith("\x01") & p["b"].startswith("\x01") & ~p["word"])
    # Windows on one diagonal continue each other, so their slots must fit together.
    runs = (
        both.withColumn("slots", slots)
        .groupBy("doc_id", "item_id", (F.col("i") - F.col("j")).alias("shift")).agg(
            F.countDistinct("i").alias("windows"), F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"),
            F.max("same").alias("equal"), F.min("same").alias("same_values")))
    fitting = F.size("slots") - unfit(F.col("slots"))
    consistent = (fitting >= F.size("slots") - 1) | (fitting >= FIT * F.size("slots"))
    found = (
        runs.filter(consistent | F.col("equal"))
        .groupBy("doc_id", "item_id").agg(F.sum("windows").alias("windows"), F.min("same_values").alias("same_values")))
    return found if short.isEmpty() else found.unionByName(line_matches(source, short))


def clean(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without a match, all columns. A document without key cannot be named, so it stays."""
    leak = fresh(documents, "leak")
    found = written(matches(documents, items, key, text).select(F.col("doc_id").alias(leak)).distinct(), "leaks")
    return documents.join(found, F.col(key) == F.col(leak), "left_anti")
