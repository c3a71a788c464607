"""Main text of web pages by a recurrent labeller of blocks.

A page becomes the sequence of its text blocks in page order. Each block is a vector of its
hashed tag path (tags with their class, id and role words), its hashed words and a few
numbers; a bidirectional LSTM reads the sequence and decides for every block, with the whole
page as context, whether it belongs to the article. The network is small, runs on NumPy and
is trained here, on layouts that are put together from common page parts and filled with
words of a bounded sample of the pages.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATH_DIM, WORD_DIM, HIDDEN = 192, 24, 12
LAYOUTS, EPOCHS, RATE = 700, 12, 0.02
SAMPLE_PAGES = 200  # about so many pages, by hash, lend words to the training layouts
SAMPLE_WORDS = 400
TYPICAL = 12  # words of a block whose words have full weight
_WINDOW = 49152  # blocks that go through the network together; a longer page alone

# HTML elements by their role for text.
SKIPPED = frozenset("script style noscript template head title svg math iframe object canvas select option textarea button".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var br wbr img".split()
)
#: What may stand in a head; any other start tag, or text, ends a head whose end tag is left out.
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: A start tag of the key closes an open element of the values that lies within the same container.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
CONTAINER = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_IN_TAG = re.compile(r"[>=]\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int  # characters inside links


class _Open(NamedTuple):
    """An open element, and what held before it."""

    tag: str
    path: tuple[str, ...]
    skipping: int
    linking: int


def _tag_end(page: str, at: int, absent: set[str]) -> int:
    """Where the ``>`` of a tag is (-1: nowhere). A quote opens a value only after ``=``; one that
    is never closed is part of an unquoted value. ``absent`` remembers quotes that do not occur
    any more, so that no page is searched to its end again and again."""
    while m := _IN_TAG.search(page, at):
        if m[0][0] == ">":
            return m.start()
        at = m.end()
        quote = page[at : at + 1]
        if quote in ("'", '"') and quote not in absent:
            close = page.find(quote, at + 1)
            if close >= 0:
                at = close + 1
                continue
            absent.add(quote)
        at = _UNQUOTED.match(page, at).end()
    return -1


def blocks(page: str | None) -> list[Block]:
    """The non-empty text blocks of a page. Tags that are not inline end a block."""
    page = page or ""
    stack: list[_Open] = []
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    path: tuple[str, ...] = ()
    skipping = linking = 0

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                out.append(Block(text, path, sum(len(p) for p, linked in parts if linked)))
            parts = []

    def cut(i: int) -> None:
        nonlocal path, skipping, linking
        path, skipping, linking = stack[i].path, stack[i].skipping, stack[i].linking
        del stack[i:]

    def end_head() -> None:
        for i, e in enumerate(stack):
            if e.tag == "head":
                cut(i)
                break

    at, absent = 0, set()
    while at < len(page):
        m = _TOKEN.search(page, at)
        close = _tag_end(page, m.end(), absent) if m and m[2] else 0
        if close < 0:  # no tag ends any more
            m = None
        end = m.start() if m else len(page)
        if stack and stack[-1].tag == "head" and page[at:end].strip():
            end_head()
        if end > at and not skipping:
            parts.append((page[at:end], linking > 0))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        said, at = page[at:close], close + 1
        tag = m[2].lower()
        inline = tag in INLINE
        if skipping and not m[1] and tag not in HEAD:
            end_head()
        if tag == "br":
            parts.append((" ", False))
            continue
        if not inline:
            flush()
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    cut(i)
                    break
            continue
        if tag in VOID or said.endswith("/") and inline:
            continue
        if tag in RAW:
            last = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = last.end() if last else len(page)
            continue
        if not inline and stack:
            closed = CLOSES.get(tag, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in CONTAINER.get(tag, ()):
                    break
                if stack[i].tag in closed or stack[i].tag == "p":
                    cut(i)
                    if tag not in CLOSES:
                        break
        stack.append(_Open(tag, path, skipping, linking))
        skipping += tag in SKIPPED
        linking += tag == "a"
        if not inline:
            named = _NAMED.findall(said) if "=" in said else ()
            path += (tag, *(w for g in named for w in _PART.findall("".join(g).lower())))
    flush()
    return out


@lru_cache(maxsize=1 << 16)
def _hash(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h >> 31 else -1.0


@lru_cache(maxsize=1 << 14)
def _path_row(path: tuple[str, ...]) -> np.ndarray:
    row = np.zeros(PATH_DIM, np.float32)
    for w in set(path) - {"html", "body"}:
        j, sign = _hash(w, PATH_DIM)
        row[j] += sign
    return row


class _Places(dict):
    """Hashed place of a word among WORD_DIM, WORD_DIM higher where its sign is negative."""

    def __missing__(self, word: str) -> int:
        j, sign = _hash.__wrapped__(word, WORD_DIM)
        place = j if sign > 0 else WORD_DIM + j
        if len(word) < 30:
            if len(self) > 1 << 16:
                self.clear()
            self[word] = place
        return place


_places = _Places()


def vectors(page: Sequence[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words, numbers.

    All words of a block count. Those of a block of more than TYPICAL words weigh less by the root of
    the ratio, so that the sums of long and short blocks spread alike.
    """
    x = np.zeros((len(page), PATH_DIM + WORD_DIM + 6), np.float32)
    if not len(page):
        return x
    x[:, :PATH_DIM] = [_path_row(b.path) for b in page]
    words = [b.text.lower().split() for b in page]
    n_words = np.array([len(ws) for ws in words])
    found = np.fromiter((_places[w] for ws in words for w in ws), np.int64, n_words.sum())
    cell = np.repeat(np.arange(len(page)) * (2 * WORD_DIM), n_words) + found
    counts = np.bincount(cell, minlength=len(page) * 2 * WORD_DIM).reshape(-1, 2, WORD_DIM)
    weight = 0.3 * np.sqrt(TYPICAL / np.maximum(n_words, TYPICAL))
    x[:, PATH_DIM : PATH_DIM + WORD_DIM] = (counts[:, 0] - counts[:, 1]) * weight[:, None]
    last = len(page) - 1 or 1
    x[:, -6:] = [
        (math.log1p(n := len(b.text)) / 6, min(1.0, b.linked / n), len(b.path) / 10, b.text[-1] in ".!?…:;\"'»)", i / last, 1.0)
        for i, b in enumerate(page)
    ]
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, seed: int = 11, width: int = PATH_DIM + WORD_DIM + 6, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            self.p[f"W{d}"] = rng.normal(0, 0.15, (width, 4 * hidden))
            self.p[f"U{d}"] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            self.p[f"c{d}"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)
        self.p["V"] = rng.normal(0, 0.2, 2 * hidden)
        self.p["v"] = np.zeros(1)
        self.p["S"] = np.zeros(width)  # a block's own vector also reaches the output directly
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """Hidden states (time, pages, hidden) in one direction; masked steps keep the state."""
        h_dim = self.hidden
        z = x @ self.p[f"W{d}"] + self.p[f"c{d}"]
        h = c = np.zeros((x.shape[1], h_dim), np.float32)
        out = np.zeros((*x.shape[:2], h_dim), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            a = z[t] + h @ self.p[f"U{d}"]
            gates = 1 / (1 + np.exp(-np.clip(a[:, : 3 * h_dim], -30, 30)))
            i, f, o = gates[:, :h_dim], gates[:, h_dim : 2 * h_dim], gates[:, 2 * h_dim :]
            g = np.tanh(a[:, 3 * h_dim :])
            new_c = f * c + i * g
            th = np.tanh(new_c)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, th, m))
            h, c = np.where(m, o * th, h), np.where(m, new_c, c)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        states = []
        for d in ("f", "b"):
            steps: list | None = [] if keep is not None else None
            states.append(self._pass(x, mask, d, steps))
            if keep is not None:
                keep[d] = steps
        s = np.concatenate(states, axis=2)
        if keep is not None:
            keep["s"] = s
        return s @ self.p["V"] + x @ self.p["S"] + self.p["v"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        keep: dict = {}
        z = self.logits(x, mask, keep)
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * mask / max(1, mask.sum())
        g = {"V": np.tensordot(e, keep["s"], ((0, 1), (0, 1))), "v": np.array([e.sum()])}
        g["S"] = np.tensordot(e, x, ((0, 1), (0, 1)))
        h_dim = self.hidden
        for k, d in enumerate(("f", "b")):
            into = e[:, :, None].astype(np.float32) * self.p["V"][k * h_dim : (k + 1) * h_dim]
            dh = dc = np.zeros((x.shape[1], h_dim))
            da = np.zeros((*x.shape[:2], 4 * h_dim))
            du = np.zeros_like(self.p[f"U{d}"])
            for t, h, c, i, f, o, cand, th, m in reversed(keep[d]):
                dh = dh + into[t]
                do = dh * th * m
                dcell = (dc + dh * o * (1 - th**2)) * m
                step = np.concatenate(
                    [dcell * cand * i * (1 - i), dcell * c * f * (1 - f), do * o * (1 - o), dcell * i * (1 - cand**2)],
                    axis=1,
                )
                da[t] = step
                du += h.T @ step
                dh = step @ self.p[f"U{d}"].T + dh * ~m
                dc = dcell * f + dc * ~m
            g[f"W{d}"] = np.tensordot(x, da, ((0, 1), (0, 1)))
            g[f"U{d}"] = du
            g[f"c{d}"] = da.sum((0, 1))
        return g

    def predict(self, pages: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Whether each block is article text. Pages of similar length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            group = [order.pop()]
            while order and (len(group) + 1) * longest <= _WINDOW:
                group.append(order.pop())
            x, mask = pad([pages[i] for i in group])
            z = self.logits(x, mask)
            for j, i in enumerate(group):
                out[i] = z[: len(pages[i]), j] > 0
        return out


def pad(pages: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros((longest, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


# Names that page parts commonly go by.
PARTS = {
    "header": ("header", "masthead", "site-header", "top-bar", "branding", "logo"),
    "menu": ("nav", "menu", "navbar", "main-nav", "breadcrumb", "breadcrumbs", "navigation"),
    "advert": ("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo"),
    "notice": ("cookie", "cookie-notice", "consent", "notice", "gdpr", "popup", "modal", "alert"),
    "sidebar": ("sidebar", "related", "widget", "aside", "more-links", "recommended", "trending", "rail"),
    "form": ("newsletter", "subscribe", "login", "search-form", "signup", "contact-form"),
    "comments": ("comments", "comment-list", "comment", "replies", "discussion", "disqus", "respond"),
    "share": ("share", "social", "share-buttons", "toolbar", "pagination", "tags"),
    "footer": ("footer", "site-footer", "copyright", "bottom", "colophon", "legal"),
    "article": ("article", "content", "post", "entry-content", "main", "main-content", "story", "article-body", "text", "post-body"),
    "wrapper": ("wrapper", "container", "page", "row", "col", "layout", "inner", "site"),
}
TAGS = {"header": "header", "menu": "nav", "sidebar": "aside", "form": "form", "footer": "footer"}


class Layouts:
    """Random pages whose article blocks are known by construction."""

    def __init__(self, words: Sequence[str], seed: int = 5):
        self._rng = np.random.default_rng(seed)
        self._words = list(words) or ["word", "text", "line"]
        self._main: list[bool] = []
        self._inside = False
        self._stops = 1.0

    def _pick(self, items: Sequence):
        return items[int(self._rng.integers(len(items)))]

    def _chance(self, p: float) -> bool:
        return bool(self._rng.random() < p)

    def _phrase(self, low: int, high: int) -> str:
        return " ".join(self._pick(self._words) for _ in range(int(self._rng.integers(low, high))))

    def _block(self, tag: str, text: str) -> str:
        self._main.append(self._inside)
        if self._chance(0.1):
            text = f"<b>{text}</b>" if self._chance(0.5) else f"<b>{text}<br>"
        return f"<{tag}>{text}</{tag}>" if tag else text

    def _links(self, n: int) -> str:
        items = [self._block("li", f'<a href="#">{self._phrase(1, 5)}</a>') for _ in range(n)]
        return f"<ul>{''.join(items)}</ul>"

    def _prose(self, n: int) -> str:
        out = []
        for _ in range(n):
            u = self._rng.random()
            low, high = (1, 6) if u < 0.3 else (6, 40) if u < 0.7 else (40, 150)
            text = self._phrase(low, high) + ("." if self._chance(self._stops) else "")
            if self._chance(0.15):
                text += f' <a href="#">{self._phrase(1, 4)}</a> {self._phrase(1, 8)}.'
            kind = self._rng.random()
            if kind < 0.82:
                out.append(self._block("p", text))
            elif kind < 0.88:
                out.append(self._block(self._pick(("h2", "h3", "h4")), self._phrase(1, 8)))
            elif kind < 0.93:
                out.append("<ul>" + "".join(self._block("li", self._phrase(2, 20)) for _ in range(3)) + "</ul>")
            elif kind < 0.96:
                out.append(self._block("blockquote", text))
            elif kind < 0.98:
                out.append("<table>" + "<tr>" + self._block("td", self._phrase(1, 6)) + self._block("td", self._phrase(1, 6)) + "</tr></table>")
            else:
                out.append(self._block("pre", text))
        return "".join(out)

    def _named(self, part: str, body: str) -> str:
        tag = TAGS.get(part, "div") if self._chance(0.7) else self._pick(("div", "div", "section", "p" if "<" not in body else "div"))
        if tag == TAGS.get(part) and self._chance(0.7):
            return f"<{tag}>{body}</{tag}>"
        name = self._pick(PARTS[part])
        return f'<{tag} {self._pick(("class", "id", "class"))}="{name}">{body}</{tag}>'

    def _boiler(self, part: str) -> str:
        inside, self._inside = self._inside, False
        if part in ("menu", "share"):
            body = self._links(int(self._rng.integers(2, 9)))
        elif part == "header":
            body = self._block(self._pick(("h1", "div", "p", "a")), self._phrase(1, 6))
        elif part == "sidebar":
            body = self._block(self._pick(("h3", "h4", "p")), self._phrase(1, 5)) + self._links(int(self._rng.integers(2, 7)))
            if self._chance(0.4):
                body += self._prose(1)
        elif part == "comments":
            n = int(self._rng.integers(1, 6))
            one = lambda: self._block("p", self._phrase(3, 60) + ".")
            body = self._block("h3", self._phrase(1, 3)) + "".join(f'<div class="comment">{one()}</div>' if self._chance(0.5) else one() for _ in range(n))
        elif part == "form":
            body = self._block("label", self._phrase(1, 6)) + '<input type="text">' if self._chance(0.5) else self._block("p", self._phrase(2, 15)) + "<input>"
        else:
            text = self._phrase(2, 30) + ("." if self._chance(0.6) else "")
            text = f"&copy; {text}" if part == "footer" and self._chance(0.5) else text
            body = self._block("" if self._chance(0.6) else "p", text)
        self._inside = inside
        return self._named(part, body)

    def page(self) -> tuple[str, list[bool]]:
        self._main, self._inside = [], False
        self._stops = self._pick((1.0, 0.85, 0.4, 0.0))  # some pages end no sentence with a stop
        out = [self._boiler(p) for p in ("notice", "header", "menu", "advert", "form", "menu") if self._chance(0.45)]
        side = [self._boiler("sidebar")] if self._chance(0.2) else []
        self._inside = True
        body = []
        if self._chance(0.85):
            body.append(self._block("h1", self._phrase(1, 14)))
        for _ in range(int(self._rng.integers(1, 4))):
            body.append(self._prose(int(self._rng.integers(1, 9))))
            if self._chance(0.2):
                body.append(self._boiler(self._pick(("advert", "share", "sidebar", "form", "notice"))))
        if self._chance(0.15):
            body.append(self._boiler("comments"))
        self._inside = False
        u = self._rng.random()
        inner = "".join(body)
        if u < 0.5:
            inner = f"<article>{inner}</article>"
        elif u < 0.65:
            inner = f"<main>{inner}</main>"
        elif u < 0.95:
            inner = f'<{(t := self._pick(("div", "section", "article", "main")))} {self._pick(("class", "id"))}="{self._pick(PARTS["article"])}">{inner}</{t}>'
        main = side + [inner]
        out += [f'<div class="{self._pick(PARTS["wrapper"])}">{"".join(main)}</div>'] if self._chance(0.3) else main
        out += [self._boiler(p) for p in ("share", "comments", "sidebar", "advert", "form", "menu") if self._chance(0.35)]
        out += [self._boiler("footer")] if self._chance(0.75) else []
        return f"<html><body>{''.join(out)}</body></html>", self._main


def train(words: Sequence[str], layouts: int = LAYOUTS, epochs: int = EPOCHS, seed: int = 11) -> Labeller:
    """A labeller fitted to random layouts filled with ``words``, by Adam."""
    make = Layouts(words, seed)
    pages = []
    while len(pages) < layouts:
        page, main = make.page()
        found = blocks(page)
        if found and len(found) == len(main):
            pages.append((vectors(found), np.array(main, float)))
    pages.sort(key=lambda p: len(p[0]))
    model, rng = Labeller(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    t = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for at in rng.permutation(np.arange(0, len(pages), 20)):
            part = pages[at : at + 20]
            x, mask = pad([a for a, _ in part])
            y = np.zeros(mask.shape)
            for j, (_, b) in enumerate(part):
                y[: len(b), j] = b
            t += 1
            for k, g in model.gradients(x, mask, y).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g**2
                model.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return model


def sample_words(pages: DataFrame) -> list[str]:
    """Words of a bounded sample of pages, in order of page hash."""
    n = pages.count()
    h = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20))
    few = pages.where(h < F.lit(int((1 << 20) * min(1.0, SAMPLE_PAGES / max(n, 1)))))
    start = F.substring("html", 1, 20_000)  # of the sample only
    rows = few.select(h.alias("h"), start.alias("html")).orderBy("h", "html").limit(2 * SAMPLE_PAGES).collect()
    words: dict[str, None] = {}
    for r in rows:
        for b in blocks(r.html):
            words.update(dict.fromkeys(w for w in b.text.split()[:40] if len(w) < 30))
        if len(words) > SAMPLE_WORDS:
            break
    return list(words)[:SAMPLE_WORDS]


def main_text(page: Sequence[Block], main: np.ndarray) -> str:
    return "\n".join(b.text for b, keep in zip(page, main) if keep)


def text_column(page: Column | str, model: Labeller) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        out: list[str] = []
        for lo in range(0, len(pages), 2048):
            found = [blocks(p) for p in pages.iloc[lo : lo + 2048]]
            labels = model.predict([vectors(b) for b in found])
            out += [main_text(b, keep) for b, keep in zip(found, labels)]
        return pd.Series(out, index=pages.index)

    return extract.asNondeterministic()(page)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row: the article blocks, one per line.

    A null, empty or textless page has the empty text. Blocks are decoded, their white space
    becomes single spaces, nothing is cut. Repeated rows are rows of their own; extra columns
    are ignored; an empty table gives no rows.
    """
    slim = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    model = train(sample_words(slim))
    return slim.select("page_id", "url", text_column("html", model).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
