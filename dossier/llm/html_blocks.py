"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: text between block-level tags, with the path of open
tags. Every block becomes a vector: hashed signs of its tag path (tags, classes, ids,
roles), the mean of its words' hashed vectors, and a few sizes. A bidirectional LSTM in
numpy reads the blocks of a page in both directions, so each label depends on the whole
document. Blocks labelled as article text are joined by line ends.

The labeller is trained on a bounded sample of pages (``SAMPLE_PAGES``, in the order of a
hash of the key). Their labels come from semantic containers, once known: text inside
``article`` or ``main`` counts, unless it lies in navigation, headers, footers, asides,
forms, or containers named like notices, adverts, sidebars or comments. The labels come from
these tags, the vectors must not: on training pages they give way to neutral containers or
disappear, names of other containers are taken away or replaced by unknown ones, so that the order of blocks,
their words, links, sizes and neighbours have to decide. So that it sees
other containers, training pages get further ones with words of the page inside.

Scripts, styles, templates, fields of forms, comments and the head are no blocks. Character references
are decoded, white space inside a block becomes one space. Null and empty pages give
empty text, an empty table an empty one. Repeated pages are read each, very long ones in batches of their own;
blocks at 0.5 count as article. Of further columns, one named like the result is replaced by it.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.common import mix, word_hashes, words_of

SAMPLE_PAGES = 240
#: Training pages with more blocks are left out.
LONGEST = 160
PATH_SIZE, WORD_SIZE, HIDDEN = 48, 16, 16
INPUT = PATH_SIZE + WORD_SIZE + 4
EPOCHS = 14

TOKEN = re.compile(
    r"<(?P<raw>script|style|title|textarea|iframe)\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S | re.I)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: Elements whose text is never shown.
HIDDEN_TEXT = {"script", "style", "template", "title", "textarea", "iframe", "select", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
             "time tt u var br wbr img".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
               "main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}}
P_ONLY, NONE = {"p"}, frozenset()
SCOPE = {"ul", "ol", "dl", "table", "body", "article", "section", "div", "main", "aside", "nav", "header", "footer", "form", "blockquote"}
#: Containers that never hold article text, and words that name them.
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
BOILER_WORD = re.compile(
    r"(?:^|[-_ ])(?:ad|ads|advert\w*|banner|breadcrumb\w*|comment\w*|consent|cookie\w*|footer|header|menu|modal|nav\w*|newsletter|notice\w*|"
    r"popup|promo\w*|related|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[-_ ])", re.I)


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Leaf blocks in page order: path of (tag and names), text, characters inside links."""
    found: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    links = hidden = anchors = at = 0

    def flush() -> None:
        nonlocal links
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                found.append((tuple([sign for name, sign in stack if name not in INLINE]), joined, links))
            text.clear()
            links = 0

    def add(piece: str) -> None:
        nonlocal links
        if not hidden:
            if "&" in piece:
                piece = html.unescape(piece)
            text.append(piece)
            if anchors:
                links += len(piece.strip())

    def pop_to(place: int) -> None:
        nonlocal hidden, anchors
        while len(stack) > place:
            name = stack.pop()[0]
            hidden -= name in HIDDEN_TEXT
            anchors -= name == "a"

    for m in TOKEN.finditer(page):
        start = m.start()
        if start > at:
            add(page[at:start])
        at = m.end()
        _, data, ending, name, rest = m.groups()
        if name is None:
            if data:
                add(data)
            continue
        name = name.lower()
        block = name not in INLINE
        if block:
            flush()
        if ending:
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == name:
                    pop_to(place)
                    break
                if not block and stack[place][0] not in INLINE:
                    break
            continue
        if block and stack:
            closed = P_ONLY if name in CLOSES_P else SAME.get(name, NONE)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closed:
                    pop_to(i)
                    break
                if stack[i][0] in SCOPE:
                    break
            if name == "body" and (heads := [i for i, s in enumerate(stack) if s[0] == "head"]):
                pop_to(heads[0])
        elif name == "br":
            add(" ")
        if name in VOID or rest.endswith("/"):
            continue
        names = " ".join([a or b or c for a, b, c in MARKS.findall(rest)]).lower() if rest else ""
        stack.append((name, f"{name} {names}" if names else name))
        hidden += name in HIDDEN_TEXT
        anchors += name == "a"
    if at < len(page):
        add(page[at:])
    flush()
    return [b for b in found if "head" not in b[0]]


def weak_label(path: tuple[str, ...]) -> int:
    """1 inside an article container and outside all others that are known."""
    tags = [sign.split(" ")[0] for sign in path]
    if not any(t in ("article", "main") for t in tags) or any(t in BOILER_TAGS for t in tags):
        return 0
    return int(not any(BOILER_WORD.search(word) for sign in path for word in sign.split(" ")[1:]))


_signs: dict[str, np.ndarray] = {}


def _sign(key: str, size: int) -> np.ndarray:
    """A fixed vector of plus and minus one for a name."""
    got = _signs.get(key)
    if got is None:
        seed = zlib.crc32(key.encode())
        got = np.random.default_rng(seed).choice([-1.0, 1.0], size).astype(np.float32)
        if len(_signs) > 20_000:
            _signs.clear()
        _signs[key] = got
    return got


_paths: dict[tuple[str, ...], np.ndarray] = {}


def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Sum of the signs of all tags and names on the path; names are also cut at their hyphens."""
    got = _paths.get(path)
    if got is None:
        got = np.zeros(PATH_SIZE, dtype=np.float32)
        for sign in path:
            tag, *names = sign.split(" ")
            if tag not in ("html", "body"):
                got += _sign("<" + tag, PATH_SIZE)
            for part in {p for name in names for p in [name, *re.split("[-_]", name)] if p}:
                got += _sign("." + part, PATH_SIZE)
        got = got / 2
        if len(_paths) > 20_000:
            _paths.clear()
        _paths[path] = got
    return got


_shift = np.arange(WORD_SIZE, dtype=np.uint64)


def vectors(found: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
    """One input row per block."""
    out = np.zeros((len(found), INPUT), dtype=np.float32)
    if not found:
        return out
    raw = np.frombuffer("\n".join(t for _, t, _ in found).encode(), np.uint8)
    starts, ends = words_of(raw)
    h = mix(word_hashes(raw, starts, ends))
    signs = ((h[:, None] >> _shift) & np.uint64(1)).astype(np.float32) * 2 - 1
    counts = np.array([t.count(" ") + 1 for _, t, _ in found])
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    if counts.sum() == len(h):
        out[:, PATH_SIZE:PATH_SIZE + WORD_SIZE] = np.add.reduceat(signs, first, axis=0) / counts[:, None]
    for i, (path, text, links) in enumerate(found):
        out[i, :PATH_SIZE] = _path_vector(path)
        size = len(text)
        out[i, -4:] = (np.log1p(size) / 5, min(1.0, links / size), np.log1p(counts[i]) / 4, text[-1] in ".!?\"")
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Two LSTMs, forwards and backwards, and a logistic output on both states."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"x{side}": draw(INPUT, 4 * HIDDEN), f"h{side}": draw(HIDDEN, 4 * HIDDEN), f"c{side}": np.zeros(4 * HIDDEN, np.float32)}
            self.p[f"c{side}"][HIDDEN:2 * HIDDEN] = 1

    def _run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool):
        steps, n, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        states, saved = np.zeros((steps, n, HIDDEN), np.float32), []
        inputs = x @ self.p["x" + side] + self.p["c" + side]
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = inputs[t] + h @ self.p["h" + side]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new_c = (f * c + i * g) * m
            tc = np.tanh(new_c)
            if keep:
                saved.append((t, h, c, i, f, o, g, tc, m))
            h, c = o * tc * m, new_c
            states[t] = h
        return states, saved

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, mask, s, False)[0] for s in "fb"], axis=2)
        return _sigmoid(both @ self.p["out"] + self.p["bias"])[:, :, 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {s: self._run(x, mask, s, True) for s in "fb"}
        both = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)
        error = (_sigmoid(both @ self.p["out"] + self.p["bias"]) - y[:, :, None]) * mask[:, :, None] / mask.sum()
        grad = {"out": np.einsum("tnh,tno->ho", both, error), "bias": error.sum((0, 1))}
        back = error @ self.p["out"].T
        for side, part in (("f", back[:, :, :HIDDEN]), ("b", back[:, :, HIDDEN:])):
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            gh = np.zeros_like(self.p["h" + side])
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h, c, i, f, o, g, tc, m in reversed(runs[side][1]):
                dh = (dh + part[t]) * m
                dcc = (dc + dh * o * (1 - tc * tc)) * m
                dz = np.concatenate([dcc * g * i * (1 - i), dcc * c * f * (1 - f), dh * tc * o * (1 - o), dcc * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh, dc = dz @ self.p["h" + side].T, dcc * f
            grad |= {"x" + side: np.einsum("tni,tnz->iz", x, dz_all, optimize=True), "h" + side: gh, "c" + side: dz_all.sum((0, 1))}
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 3) -> None:
        """Adam over batches of pages."""
        rng = np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(EPOCHS):
            # Pages of similar length share a batch; the batches come in any order.
            order = np.argsort([len(x) * rng.uniform(0.8, 1.25) for x, _ in pages])
            for at in rng.permutation(range(0, len(order), 16)):
                x, mask, y = padded([pages[i] for i in order[at:at + 16]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.p[k] -= 0.01 * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)


def padded(pages: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(x) for x, _ in pages)
    x = np.zeros((steps, len(pages), INPUT), np.float32)
    mask, y = np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for i, (rows, labels) in enumerate(pages):
        x[:len(rows), i], mask[:len(rows), i] = rows, 1
        if labels is not None:
            y[:len(rows), i] = labels
    return x, mask, y


#: Containers that training pages get besides their own.
EXTRA_INSIDE = ["aside", "form", "div.advert", "div.ad", "div.related", "div.share-buttons", "section.comments", "div.newsletter-signup",
                "ul.comment-list", "div.promo", "figure.ad-slot", "noscript"]
EXTRA_OUTSIDE = ["header", "footer", "aside.sidebar", "div.cookie-notice", "nav.breadcrumb", "div.sidebar", "section#comments", "div.banner",
                 "div.comments", "form.search", "div.notice", "div.menu", "div#footer", "div#header", "aside.related", "div.widget",
                 "ol.comment-list", "div.subscribe", "div.popup", "div.social", "noscript", "nav", "div.ad", "nav ul"]
LEAVES = ["p", "ul li", "ol li", "h2", "h3", "blockquote p", "div p", "table tr td", "section p", "pre", "figure figcaption", "dl dd", "div"]
SHELLS = ["article", "main", "main article", "div.page article", "div#content article.post", "main section", "div.wrapper main.content article",
          "body2 article.entry", "div", "div div", "", "section", "table tr td", "div section", "div div div"]
#: Names of containers that say nothing.
NEUTRAL = ["div", "div", "section", "td", "center"]


def masked(path: tuple[str, ...], tag: str, name: str) -> tuple[str, ...]:
    """The path with ``tag`` instead of ``article`` and ``main``, or without them, and with a name that says nothing."""
    out = []
    for sign in path:
        if sign.split(" ")[0] in ("article", "main"):
            if tag:
                out.append(f"{tag} {name}" if name else tag)
        else:
            out.append(sign)
    return tuple(out)


def training_pages(pages: list[str], seed: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and weak labels of the pages, each also with further containers and another shell."""
    rng = np.random.default_rng(seed)
    sign = lambda s: s.replace(".", " ").replace("#", " ")
    out = []
    for page in pages:
        own = blocks(page)
        if not own:
            continue
        labels = [weak_label(p) for p, _, _ in own]
        if any(labels):
            truth_own = np.array(labels, np.float32)
            out.append((vectors(own), truth_own))
            for name in ("", f"x{rng.integers(1000)}"):
                tag = [*NEUTRAL, ""][rng.integers(len(NEUTRAL) + 1)]
                out.append((vectors([(masked(p, tag, name), t, n) for p, t, n in own]), truth_own))
        body = [b for b, y in zip(own, labels) if y] or own
        for _ in range(2):
            shell = tuple(sign(s) for s in SHELLS[rng.integers(len(SHELLS))].split())
            mixed: list[tuple[tuple[str, ...], str, int]] = []
            truth: list[int] = []

            def extra(kinds: list[str], inside: tuple[str, ...]) -> None:
                kind = sign(kinds[rng.integers(len(kinds))])
                for _ in range(rng.integers(1, 5)):
                    words = body[rng.integers(len(body))][1].split(" ")
                    some = " ".join(words[:rng.integers(1, 40)])
                    leaf = ["p", "li", "div", "h3", "label"][rng.integers(5)]
                    mixed.append(((*inside, kind, leaf), some, len(some) if rng.random() < 0.5 else 0))
                    truth.append(0)

            for _ in range(rng.integers(0, 4)):
                extra(EXTRA_OUTSIDE, ("html", "body", *shell[:-1]) if rng.random() < 0.2 else ("html", "body"))
            for path, text, links in body:
                leaf = LEAVES[rng.integers(len(LEAVES))] if rng.random() < 0.3 else path[-1] if path else "p"
                mixed.append((("html", "body", *shell, *leaf.split(" ")), text, links))
                truth.append(1)
                if rng.random() < 0.15:
                    extra(EXTRA_INSIDE, ("html", "body", *shell))
            for _ in range(rng.integers(0, 4)):
                extra(EXTRA_OUTSIDE, ("html", "body"))
            out.append((vectors(mixed), np.array(truth, np.float32)))
    return [(x, y) for x, y in out if len(x) <= LONGEST]


def fit(pages: DataFrame, key: str = "page_id", payload: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """Train on a bounded sample of pages: ids are chosen first, then their pages are read."""
    ids = pages.select(F.col(key).alias("k")).filter("k is not null").distinct().orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(sample_pages)
    rows = pages.select(F.col(key).alias("k"), F.col(payload).alias("p")).join(F.broadcast(ids), "k").filter("p is not null")
    sample = sorted((r["k"], r["p"]) for r in rows.toLocalIterator())[:2 * sample_pages]
    model = Labeller()
    data = training_pages([p for _, p in sample])
    if data:
        model.train(data)
    return model


def label(pages: list[str], model: Labeller) -> list[list[tuple[str, float]]]:
    """Texts and scores of all blocks, pages of similar length together."""
    found = [blocks(p) for p in pages]
    out: list[list[tuple[str, float]]] = [[] for _ in pages]
    order = sorted((i for i in range(len(found)) if found[i]), key=lambda i: len(found[i]))
    at = 0
    while at < len(order):
        size = max(1, min(64, 20_000 // len(found[order[min(at + 63, len(order) - 1)]])))
        some = order[at:at + size]
        at += size
        x, mask, _ = padded([(vectors(found[i]), None) for i in some])
        scores = model.scores(x, mask)
        for column, i in enumerate(some):
            out[i] = [(b[1], float(s)) for b, s in zip(found[i], scores[:, column])]
    return out


def extract(df: DataFrame, model: Labeller, payload: str = "html", keep: list[str] | None = None, out: str = "text") -> DataFrame:
    """Columns ``keep`` (all but the page by default) and the main text."""
    keep = [c for c in df.columns if c not in (payload, out)] if keep is None else keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = label([p or "" for p in part.column(payload).to_pylist()], model)
                texts = ["\n".join(t for t, s in row if s >= 0.5) for row in rows]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, out])

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])
    return df.select(*dict.fromkeys([*keep, payload])).mapInArrow(run, schema)
