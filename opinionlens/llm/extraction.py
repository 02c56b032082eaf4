"""Main text of web pages by a recurrent labeller of text blocks.

A page is read into its sequence of leaf blocks, each with the tags, classes and ids
above it. A bidirectional LSTM sees for every block a vector of hashed path words, a
vector of hashed words of its text and a few numbers, and labels each block with the
whole page in view. It runs in numpy, many pages at a time.

The labeller is trained on the driver on a bounded sample of pages (``SAMPLE_PAGES``,
those whose hashed address is smallest). Real pages have no labels of blocks, so the
texts of the sample are laid out anew in page templates for which it is known what is
article and what is not; sampled pages with an ``article`` or ``main`` element are used
as they are, too.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from opinionlens.llm.common import add_from_text

# Bounds of what the labeller learns from: pages, their characters, templates and blocks of an example.
SAMPLE_PAGES = 200
SAMPLE_CHARACTERS = 100_000
TEMPLATE_PAGES = 900
EXAMPLE_BLOCKS = 120
PATH_SIZE, WORD_SIZE, NUMBERS, HIDDEN = 256, 32, 6, 16
PAGES_AT_ONCE = 128

# Elements whose content is never text of a page.
HIDDEN_ELEMENTS = frozenset(
    "head script style noscript template iframe object svg canvas form select textarea option".split()
)
MAIN_ELEMENTS = frozenset(["article", "main"])
# What may stand in a head. Anything else, text as well, ends a head that is still open.
HEAD_ELEMENTS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
RAW_ELEMENTS = ("script", "style", "noscript", "template", "iframe", "textarea", "title")
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer h1 h2 h3"
    " h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul"
    " video audio".split()
)
EMPTY_ELEMENTS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An opening element ends an open one of these kinds: a paragraph ends at any block.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Quotes open a value only behind a name and a sign of equality; elsewhere they are part of a name.
_VALUE = r"""\s*=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)?"""
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|=?[^\s/>=]+(?:{_VALUE})?|=)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:[\s/]+|(=?[^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>"'][^\s>]*))?)?|=)""", re.S)
_NAMING = frozenset(["class", "id", "role"])
_NAME_PART = re.compile(r"[a-z]+")


def _names(attributes: str) -> list[str]:
    found = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in _NAMING:
            found += [f".{w}" for w in _NAME_PART.findall("".join(values).lower())]
    return found


def read_blocks(html: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """The leaf blocks of a page in order: words of the path above, and the text.

    Inline elements and line breaks do not end a block. Character references are decoded
    and white space becomes one space. Broken markup is read as far as it goes. What stands
    in a form is hidden, but not an article that a form around the page holds.
    """
    # Open elements: name, words of the path down to them, what hides them.
    stack: list[tuple[str, tuple[str, ...], str]] = [("", (), "")]
    text: list[str] = []
    path: tuple[str, ...] = ()

    def flush() -> str:
        joined = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        return joined

    def close(level: int) -> None:
        del stack[level:]

    at, size = 0, len(html)
    while at <= size:
        found = _MARKUP.search(html, at)
        piece = html[at : found.start() if found else size]
        if stack[-1][0] == "head" and entities.unescape(piece).strip():
            close(len(stack) - 1)
        if piece and not stack[-1][2]:
            text.append(piece)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        block, ending = name in BLOCK_ELEMENTS, bool(found[1])
        if not ending and stack[-1][0] == "head":
            if name == "title":
                end = re.compile(r"</title\b", re.I).search(html, at)
                at = end.start() if end else size
            elif name not in HEAD_ELEMENTS:
                close(len(stack) - 1)
        if name == "head" and not ending and stack[-1][0] not in ("", "html"):
            continue
        if name == "br" or not block and name not in HIDDEN_ELEMENTS:
            if name in ("br", "wbr") or name == "img":
                text.append(" ")
            continue
        path = stack[-1][1]
        if block or not stack[-1][2]:
            joined = flush()
            if joined:
                yield path, joined
        if ending:
            for level in range(len(stack) - 1, 0, -1):
                if stack[level][0] == name:
                    close(level)
                    break
            continue
        if block:
            for level in range(len(stack) - 1, 0, -1):
                open_name = stack[level][0]
                if open_name == "p" or open_name in ENDS.get(name, ()):
                    close(level)
                elif open_name in ("ul", "ol", "dl", "table", "div", "article", "section"):
                    break
        if name in EMPTY_ELEMENTS:
            continue
        words = (name, *_names(found[3]))
        hidden = "" if stack[-1][2] == "form" and name in MAIN_ELEMENTS else stack[-1][2]
        stack.append((name, stack[-1][1] + words, hidden or (name if name in HIDDEN_ELEMENTS else "")))
        if name in RAW_ELEMENTS:
            end = re.compile(rf"</{name}\b", re.I).search(html, at)
            at = end.start() if end else size
    joined = flush()
    if joined and not stack[-1][2]:
        yield stack[-1][1], joined


# --- vectors ------------------------------------------------------------------


def _place(word: str, size: int) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % size


class Vectors:
    """Input vectors of blocks; hashes of path words and text words are remembered."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 20_000:
                self.paths.clear()
            row = np.zeros(PATH_SIZE, np.float32)
            row[[_place(w, PATH_SIZE) for w in path]] = 1
            self.paths[path] = row
        return self.paths[path]

    def of(self, page: Sequence[tuple[tuple[str, ...], str]]) -> np.ndarray:
        found = np.zeros((len(page), PATH_SIZE + WORD_SIZE + NUMBERS), np.float32)
        if len(self.words) > 200_000:
            self.words.clear()
        known = self.words
        for i, (path, text) in enumerate(page):
            words = text.split()
            for w in words:
                if w not in known:
                    known[w] = _place(w, WORD_SIZE)
            found[i, :PATH_SIZE] = self._path(path)
            counts = np.bincount([known[w] for w in words], minlength=WORD_SIZE)
            found[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = counts / max(1, len(words))
            size = len(text)
            found[i, -NUMBERS:] = (
                np.log1p(len(words)) / 5, np.log1p(size) / 8, text[-1] in ".!?:;",
                i / len(page), (len(page) - i) / len(page), len(path) / 20,
            )
        return found


# --- the network --------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Weights of a bidirectional LSTM with one output per block."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        rng, size = np.random.default_rng(seed), PATH_SIZE + WORD_SIZE + NUMBERS
        weights = {"out": rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32), "bias": np.zeros(1, np.float32)}
        for side in "lr":
            weights[f"in_{side}"] = rng.normal(0, 0.15, (size, 4 * HIDDEN)).astype(np.float32)
            weights[f"rec_{side}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            weights[f"add_{side}"] = np.repeat(np.float32([0, 1, 0, 0]), HIDDEN)
        return cls(weights)

    def _run(self, x: np.ndarray, there: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states over time; ``x`` is (time, pages, inputs), ``there`` marks blocks."""
        steps, pages = there.shape
        gates_in = x @ self.weights[f"in_{side}"] + self.weights[f"add_{side}"]
        hidden, cell = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        states, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps) if side == "l" else range(steps - 1, -1, -1):
            gates = gates_in[t] + hidden @ self.weights[f"rec_{side}"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            fresh = f * cell + i * g
            mark = there[t][:, None]
            kept.append((t, hidden, cell, i, f, o, g, np.tanh(fresh), mark))
            cell = np.where(mark, fresh, cell)
            hidden = np.where(mark, o * np.tanh(fresh), hidden)
            states[t] = hidden
        return states, kept

    def scores(self, x: np.ndarray, there: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, there, side)[0] for side in "lr"], axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def gradients(self, x: np.ndarray, there: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        runs = {side: self._run(x, there, side) for side in "lr"}
        both = np.concatenate([runs[side][0] for side in "lr"], axis=2)
        error = (_sigmoid(both @ self.weights["out"] + self.weights["bias"]) - wanted) * weight / max(1, weight.sum())
        found = {"out": np.einsum("tp,tph->h", error, both), "bias": np.array([error.sum()])}
        for k, side in enumerate("lr"):
            back = error[:, :, None] * self.weights["out"][k * HIDDEN : (k + 1) * HIDDEN]
            rec = self.weights[f"rec_{side}"]
            d_hidden, d_cell = np.zeros_like(back[0]), np.zeros_like(back[0])
            d_gates = np.zeros((*there.shape, 4 * HIDDEN), np.float32)
            d_rec = np.zeros_like(rec)
            for t, hidden, cell, i, f, o, g, squashed, mark in reversed(runs[side][1]):
                up = d_hidden + back[t] * mark
                d_state = np.where(mark, d_cell + up * o * (1 - squashed**2), 0)
                parts = (d_state * g * i * (1 - i), d_state * cell * f * (1 - f), up * squashed * o * (1 - o), d_state * i * (1 - g**2))
                d_gates[t] = np.concatenate(parts, axis=1) * mark
                d_rec += hidden.T @ d_gates[t]
                d_hidden = np.where(mark, d_gates[t] @ rec.T, d_hidden)
                d_cell = np.where(mark, d_state * f, d_cell)
            flat = d_gates.reshape(-1, 4 * HIDDEN)
            found |= {f"in_{side}": x.reshape(-1, x.shape[2]).T @ flat, f"rec_{side}": d_rec, f"add_{side}": flat.sum(0)}
        return found

    def label(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text. Pages of similar length run together."""
        answers: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        start = 0
        while start < len(order):
            # As many pages as PAGES_AT_ONCE, fewer if the longest of them is very long.
            end = start + PAGES_AT_ONCE
            while end > start + 1 and len(pages[order[min(end, len(order)) - 1]]) * (end - start) > 64 * PAGES_AT_ONCE:
                end = (start + end + 1) // 2
            chosen = order[start:end]
            x, there = _padded([pages[i] for i in chosen])
            scores = self.scores(x, there)
            for k, i in enumerate(chosen):
                answers[i] = scores[: len(pages[i]), k] > 0
            start = end
        return answers


def _padded(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), pages[0].shape[1]), np.float32)
    there = np.zeros((steps, len(pages)), bool)
    for k, page in enumerate(pages):
        x[: len(page), k], there[: len(page), k] = page, True
    return x, there


# --- training -----------------------------------------------------------------

MARK = "\ue000"  # put before the main texts of a template page
_MAIN = ["article", "main", "div.content", "div.post", "div.article", "div.entry-content", "div.story", "section.article", "div#content", "div.main", "div.post-body", "main.content", "section.content", "article.post", "div#main", "div.text", "div.article-body", "div.page-content"]
_ASIDES = {
    "menu": ["nav", "div.nav", "div.menu", "ul.menu", "div.navbar", "nav.navigation", "div.breadcrumb", "div#menu", "div.topbar", "ul.breadcrumbs", "div.links", "div.pagination"],
    "frame": ["header", "footer", "div.header", "div.footer", "div#header", "div#footer", "div.copyright", "header.site-header", "footer.site-footer", "div.masthead", "div.bottom"],
    "side": ["aside", "div.sidebar", "div#sidebar", "aside.sidebar", "div.related", "div.widget", "div.share", "div.social", "div.recommended", "section.related", "div.newsletter", "div.teaser", "div.tags"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.banner", "div.sponsored", "div.promo", "aside.ad", "section.advertisement", "div.promotion", "div#ad"],
    "notice": ["div.cookie", "div.notice", "div.consent", "div.cookie-banner", "div.alert", "div.popup", "div#cookie-notice", "div.modal", "div.disclaimer", "div.subscribe", "div.gdpr"],
    "comment": ["div.comments", "section.comments", "div#comments", "ol.comment-list", "div.comment", "section#comments", "div.responses", "div.replies", "div.discussion"],
}


def _element(spec: str, content: str) -> str:
    name = re.split(r"[.#]", spec)[0]
    kind = f' class="{spec.split(".", 1)[1]}"' if "." in spec else f' id="{spec.split("#", 1)[1]}"' if "#" in spec else ""
    return f"<{name}{kind}>{content}</{name}>"


def _template_page(rng: random.Random, texts: Sequence[str]) -> str:
    def text(most: int = 400) -> str:
        words = rng.choice(texts).split()
        return entities.escape(" ".join(words[: rng.randint(1, max(2, min(most, len(words))))]))

    def paragraphs(mark: str, n: int) -> str:
        return "".join(f"<p>{mark}{text()}</p>" for _ in range(n))

    def boilerplate(kind: str) -> str:
        spec = rng.choice(_ASIDES[kind])
        if kind == "menu" or kind != "comment" and rng.random() < 0.2:
            inner = "".join(f'<li><a href="/x">{text(3)}</a></li>' for _ in range(rng.randint(1, 9)))
            return _element(spec, inner if spec[:2] == "ul" else f"<ul>{inner}</ul>")
        if kind == "comment":
            return _element(spec, "".join(rng.choice(["<p>{}</p>", "<div><p>{}</p></div>", "<li>{}</li>"]).format(text()) for _ in range(rng.randint(1, 6))))
        inner = rng.choice(["{}", "<p>{}</p>", "<div>{}</div>", "<h3>{}</h3><p>{}</p>", "&copy; x &middot; {}"])
        return _element(spec, inner.format(text(60), text(200)))

    body = [boilerplate(k) for k in ("menu", "frame", "advert", "notice", "side") if rng.random() < 0.5]
    rng.shuffle(body)
    main = f"<{(h := rng.choice(['h1', 'h2']))}>{MARK}{text(14)}</{h}>" if rng.random() < 0.85 else ""
    for _ in range(rng.randint(1, 6)):
        main += paragraphs(MARK, rng.randint(1, 4))
        dice = rng.random()
        if dice < 0.12:
            main += boilerplate(rng.choice(["advert", "side", "notice"]))
        elif dice < 0.2:
            main += f"<h2>{MARK}{text(8)}</h2>"
        elif dice < 0.27:
            main += "<ul>" + "".join(f"<li>{MARK}{text(20)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        elif dice < 0.32:
            main += f"<blockquote>{MARK}{text()}</blockquote>"
    if rng.random() < 0.2:
        main += boilerplate("comment")
    spec = rng.choice(_MAIN[:2] if rng.random() < 0.4 else _MAIN)
    main = _element(spec, main)
    if rng.random() < 0.25:
        main = _element(rng.choice(["main", "div", "div.wrapper", "div.container"]), main)
    after = [boilerplate(k) for k in ("comment", "side", "frame", "advert", "notice", "menu") if rng.random() < 0.4]
    rng.shuffle(after)
    inside = "".join([*body, main, *after])
    if rng.random() < 0.3:
        inside = _element(rng.choice(["div", "div.wrapper", "div.container", "div#page"]), inside)
    return f"<html><body>{inside}</body></html>"


_OTHER_WORDS = frozenset(
    ["nav", "header", "footer", "aside", "menu"] + [w if w in ("nav",) else f".{w}" for specs in _ASIDES.values() for s in specs for w in _NAME_PART.findall(s.split(".")[-1].split("#")[-1]) if "." in s or "#" in s]
) - {".site", ".list", ".section", ".text", ".links"}


def train(pages: Sequence[str], seed: int = 5, steps: int = 160, batch: int = 24, template_pages: int = TEMPLATE_PAGES) -> Labeller:
    """Fit a labeller on the texts of some pages, laid out in templates, and on the pages."""
    rng, vectors = random.Random(seed), Vectors()
    read = [list(read_blocks(p)) for p in pages]
    texts = [text for page in read for _, text in page] or ["some words to begin with."]
    examples: list[tuple[np.ndarray, np.ndarray]] = []
    for page in read:
        wanted = [("article" in path or "main" in path) and not _OTHER_WORDS.intersection(path) for path, _ in page]
        if any(wanted):
            examples.append((vectors.of(page), np.array(wanted, np.float32)))
    for _ in range(template_pages):
        page = list(read_blocks(_template_page(rng, texts)))
        wanted = np.array([text.startswith(MARK) for _, text in page], np.float32)
        examples.append((vectors.of([(path, text.lstrip(MARK) or "-") for path, text in page]), wanted))
    examples = [e for e in examples if len(e[0]) <= EXAMPLE_BLOCKS]
    labeller = Labeller.fresh(seed)
    moment = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in labeller.weights.items()}
    for step in range(1, steps + 1):
        chosen = rng.sample(examples, min(batch, len(examples)))
        x, there = _padded([v for v, _ in chosen])
        wanted = np.zeros(there.shape, np.float32)
        for k, (_, y) in enumerate(chosen):
            wanted[: len(y), k] = y
        for name, slope in labeller.gradients(x, there, wanted, there.astype(np.float32)).items():
            slope = np.clip(slope, -1, 1).astype(np.float32)
            mean, square = moment[name]
            mean[:], square[:] = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
            rate = 0.02 * min(1, 2 * (1 - step / (steps + 1)))
            labeller.weights[name] -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return labeller


# --- Spark --------------------------------------------------------------------


def sample_pages(pages: DataFrame, html: str = "html", most: int = SAMPLE_PAGES) -> list[str]:
    """At most ``most`` different pages below ``SAMPLE_CHARACTERS``, chosen by a hash of their content: a bounded sample.

    A share of the pages is drawn first, so that what tasks send does not grow with the table.
    """
    body = pages.select(F.col(html).alias("body")).filter(F.length("body") < SAMPLE_CHARACTERS)
    share = max(1, body.count() // (4 * most))
    drawn = body.withColumn("hash", F.xxhash64("body")).filter(F.pmod("hash", F.lit(share)) == 0)
    drawn = drawn.groupBy("hash").agg(F.min("body").alias("body"))
    return [r.body for r in drawn.orderBy("hash").limit(most).collect()]


def extract(pages: DataFrame, html: str = "html", text: str = "text", labeller: Labeller | None = None) -> DataFrame:
    """``pages`` with the main text of each whole page: its blocks, joined by empty lines.

    A page without main text, an empty and a null one have an empty text. Pages are
    labelled one by one, so repeated rows agree and other columns do not matter; a column
    that is already called ``text`` is replaced.
    """
    fitted = labeller or train(sample_pages(pages, html))
    shipped = pages.sparkSession.sparkContext.broadcast(fitted.weights)

    def factory():
        labeller, vectors = Labeller(shipped.value), Vectors()

        def compute(column: pa.Array) -> Sequence[pa.Array]:
            read = [list(read_blocks(p)) if p else [] for p in column.to_pylist()]
            found = labeller.label([vectors.of(page) for page in read])
            texts = ["\n\n".join(t for (_, t), main in zip(page, marks) if main) for page, marks in zip(read, found)]
            return [pa.array(texts, pa.string())]

        return compute

    return add_from_text(pages, [StructField(text, StringType())], factory, html, 1 << 20)
