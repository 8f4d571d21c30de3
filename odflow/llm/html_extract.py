"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks. Each block is a vector: learnt embeddings of the hashed entries of
its tag path, of its hashed words, and a few plain measures. A bidirectional LSTM (numpy only) reads the whole
sequence both ways, so every block is judged in the context of the whole document, and says for each
block whether it belongs to the article.

There are no labels for pages, so the labeller is trained on two kinds of pages: laid-out ones made here
from the words of a bounded sample, in many templates and with known labels, and the sample's own pages with the labels
that element and class names give where they are plain (other blocks there count for nothing in the loss).
"""

from __future__ import annotations

import html
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.llm.html_blocks import Block, Open, blocks
from odflow.llm.textarrays import ASCII_LOWER, NOT_SPACE, word_hashes, word_spans
from odflow.llm.training import fit_in_task
from odflow.llm.workers import tidy

SAMPLE_PAGES, SAMPLE_CHARS, SAMPLE_DEPTH, MADE_PAGES = 300, 30_000, 200, 900
KEPT_PATHS = 20_000
PATH_ROWS, WORD_ROWS, PATH_DIM, WORD_DIM, PLAIN, HIDDEN = 512, 512, 20, 6, 8, 20
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.01, 17
#: Steps that one padded batch may hold when pages are labelled.
BATCH_STEPS = 20_000

# Names that tell what a part of a page is for.
ASIDE_NAMES = frozenset(
    "nav header footer aside form menu navbar navigation breadcrumb breadcrumbs sidebar widget ad ads advert adverts "
    "advertisement banner promo sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay related share "
    "social comment comments reply replies respond disqus subscribe newsletter signup login search masthead topbar toolbar "
    "copyright legal pagination pager tags author bio button dialog".split())
MAIN_NAMES = frozenset("article main content post entry story articlebody maincontent".split())


def _entry_hash(text: str, rows: int) -> int:
    return zlib.crc32(text.encode()) % rows


def path_features(path: tuple[str, ...]) -> list[int]:
    """Rows of the path embedding: every entry's element and names, the last two also by place."""
    out = []
    for k, entry in enumerate(path):
        out += [_entry_hash(w, PATH_ROWS) for w in entry.split()]
        if len(path) - k <= 2:
            out.append(_entry_hash(f"{len(path) - k}:{entry.split()[0]}", PATH_ROWS))
    return out or [_entry_hash("(none)", PATH_ROWS)]


def plain_features(page: list[Block]) -> np.ndarray:
    n, rows = len(page), []
    for k, b in enumerate(page):
        chars = len(b.text)
        words = b.text.count(" ") + 1
        rows.append((np.log1p(words) / 4, min(1.0, b.link_chars / max(1, chars)), float(b.text[-1] in ".!?:;\"”»"), k / n, 1 - k / n,
                     min(1.0, chars / words / 12), float(any(c.isdigit() for c in b.text[:40])), np.log1p(n) / 5))
    return np.array(rows, dtype=np.float32).reshape(n, PLAIN)


def _word_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all words of some blocks, and each block's range in them."""
    raw = [t.encode() for t in texts]
    data = ASCII_LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    off = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    starts, ends, words = word_spans(data, off, NOT_SPACE)
    return (word_hashes(data, starts, ends) % np.uint64(WORD_ROWS)).astype(np.int32), words


@dataclass
class Page:
    """Input of the labeller: one row per block."""

    path: list[list[int]]
    words: list[np.ndarray]
    plain: np.ndarray

    @classmethod
    def of(cls, page: list[Block]) -> "Page":
        rows, at = _word_rows([b.text for b in page])
        return cls([path_features(b.path) for b in page], [rows[a:z] for a, z in zip(at[:-1], at[1:])], plain_features(page))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors with a logistic output; forward and backward passes in numpy."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + PLAIN

        def w(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"path": w(PATH_ROWS, PATH_DIM) * 3, "words": w(WORD_ROWS, WORD_DIM) * 3, "out": w(2 * HIDDEN + d, 1)[:, 0],
                  "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.p[f"w{side}"] = w(d + HIDDEN, 4 * HIDDEN)
            self.p[f"c{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)

    def vectors(self, page: Page) -> np.ndarray:
        path = np.stack([self.p["path"][r].sum(axis=0) / np.sqrt(len(r)) for r in page.path])
        words = np.stack([self.p["words"][r].mean(axis=0) if len(r) else np.zeros(WORD_DIM, np.float32) for r in page.words])
        return np.concatenate([path, words, page.plain], axis=1)

    def _run(self, x: np.ndarray, live: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States of one direction: x is (steps, pages, d); padding leaves the state as it is."""
        w, c0 = self.p[f"w{side}"], self.p[f"c{side}"]
        steps, n, d = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        pre = x @ w[:d] + c0
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            z = pre[t] + h @ w[d:]
            gates = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            m = live[t][:, None]
            new = f * c + i * g
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, new, m))
            c = np.where(m, new, c)
            h = np.where(m, o * np.tanh(new), h)
            out[t] = h
        return out

    def margins(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(x, live, "f"), self._run(x, live, "b"), x], axis=2)
        return both @ self.p["out"] + self.p["bias"][0]

    def _back(self, keep: list, x: np.ndarray, dh_out: np.ndarray, side: str, grads: dict) -> np.ndarray:
        w = self.p[f"w{side}"]
        d = x.shape[2]
        dx, dw, dc0 = np.zeros_like(x), np.zeros_like(w), np.zeros_like(self.p[f"c{side}"])
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        for t, h, c, i, f, o, g, new, m in reversed(keep):
            dh = dh + dh_out[t]
            th = np.tanh(new)
            own_h, own_c = np.where(m, dh, 0), np.where(m, dc, 0)
            dn = own_c + own_h * o * (1 - th * th)
            dz = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f), own_h * th * o * (1 - o), dn * i * (1 - g * g)], axis=1)
            dx[t] = dz @ w[:d].T
            dw[:d] += x[t].T @ dz
            dw[d:] += h.T @ dz
            dc0 += dz.sum(axis=0)
            dh = np.where(m, dz @ w[d:].T, dh)
            dc = np.where(m, dn * f, dc)
        grads[f"w{side}"], grads[f"c{side}"] = dw, dc0
        return dx

    def gradients(self, pages: list[Page], labels: list[np.ndarray]) -> tuple[float, dict]:
        """Loss and gradients of one batch; labels are 1, 0 or -1 (not counted)."""
        x, live = _pad([self.vectors(p) for p in pages])
        y = np.full(live.shape, -1.0, np.float32)
        for k, own in enumerate(labels):
            y[:len(own), k] = own
        keep_f, keep_b = [], []
        both = np.concatenate([self._run(x, live, "f", keep_f), self._run(x, live, "b", keep_b), x], axis=2)
        z = both @ self.p["out"] + self.p["bias"][0]
        counted = y >= 0
        n = max(1, counted.sum())
        prob = _sigmoid(z)
        loss = -np.where(counted, np.where(y > 0.5, np.log(prob + 1e-7), np.log(1 - prob + 1e-7)), 0).sum() / n
        dz = (np.where(counted, prob - y, 0) / n).astype(np.float32)
        grads = {"out": np.einsum("tnk,tn->k", both, dz), "bias": np.array([dz.sum()], np.float32)}
        dboth = dz[:, :, None] * self.p["out"]
        dx = dboth[:, :, 2 * HIDDEN:] + self._back(keep_f, x, dboth[:, :, :HIDDEN], "f", grads)
        dx = dx + self._back(keep_b, x, dboth[:, :, HIDDEN:2 * HIDDEN], "b", grads)
        dpath, dwords = np.zeros_like(self.p["path"]), np.zeros_like(self.p["words"])
        for k, p in enumerate(pages):
            for t in range(len(p.path)):
                np.add.at(dpath, p.path[t], dx[t, k, :PATH_DIM] / np.sqrt(len(p.path[t])))
                if len(p.words[t]):
                    np.add.at(dwords, p.words[t], dx[t, k, PATH_DIM:PATH_DIM + WORD_DIM] / len(p.words[t]))
        grads["path"], grads["words"] = dpath, dwords
        return float(loss), grads

    def fit(self, pages: list[Page], labels: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED) -> list[float]:
        """Adam over shuffled batches of pages of like length; mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, losses = 0, []
        order = np.argsort([len(p.path) for p in pages], kind="stable")
        batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
        for epoch in range(epochs):
            total = 0.0
            for b in rng.permutation(len(batches)):
                step += 1
                loss, grads = self.gradients([pages[i] for i in batches[b]], [labels[i] for i in batches[b]])
                total += loss
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                rate = RATE * (1 - 0.8 * epoch / max(1, epochs)) * min(1.0, 5.0 / max(norm, 1e-9))
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9**step))
                                 / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(total / max(1, len(batches)))
        return losses


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x, live = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32), np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[:len(r), k], live[:len(r), k] = r, True
    return x, live


def plain_labels(page: list[Block]) -> np.ndarray:
    """1 inside elements named for the main text, 0 inside those named for anything else, -1 where names do not tell."""
    out = []
    for b in page:
        names = {w for e in b.path for w in e.split()}
        out.append(0.0 if names & ASIDE_NAMES else 1.0 if names & MAIN_NAMES else -1.0)
    return np.array(out, dtype=np.float32)


_MENU = "Home News Sports World Contact About Login Search Archive Products Services Help Blog Shop Topics Video".split()
_PHRASES = {
    "notice": ["We use cookies to improve your experience.", "Accept all cookies", "This site uses cookies.", "Your browser is out of date.", "Please enable notifications"],
    "ad": ["Advertisement", "Sponsored content", "Buy now and save", "Limited offer", "Special deal today"],
    "form": ["Subscribe to our newsletter", "Your email address", "Sign up", "Search this site", "Send"],
    "comments": ["3 Comments", "Reply", "Leave a comment", "says:", "Posted by", "Great article, thanks!", "Log in to reply"],
    "sidebar": ["Related articles", "Most read", "Popular posts", "Recent posts", "Tags", "About the author", "Follow us"],
    "footer": ["All rights reserved.", "© 2024", "Privacy policy", "Terms of use", "Copyright"],
}
_NAMED = {
    "nav": ["menu", "navbar", "main-nav", "navigation", "breadcrumbs"], "header": ["header", "site-header", "masthead", "topbar"],
    "footer": ["footer", "site-footer", "copyright", "bottom"], "ad": ["ad", "ads", "advert", "banner", "promo", "sponsored"],
    "notice": ["cookie-notice", "cookie", "notice", "alert", "consent", "popup"], "sidebar": ["sidebar", "widget", "related", "share social"],
    "form": ["newsletter", "subscribe", "search", "login"], "comments": ["comments", "comment", "reply", "respond"],
    "main": ["content", "article", "post", "entry-content", "main", "story", "article-body", "text"],
}


def made_page(rng: np.random.Generator, words: list[str]) -> tuple[str, list[tuple[str, float]]]:
    """A laid-out page and the label of each of its texts, in order."""
    labels: list[tuple[str, float]] = []

    def run(n):
        return " ".join(words[int(k)] for k in rng.integers(0, len(words), max(1, int(n))))

    def text(s, y):
        labels.append((" ".join(s.split()), y))
        return html.escape(s, quote=False)

    def sentence(n):
        return run(n).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])

    def wrap(kind, tags, inner):
        tag = str(rng.choice(tags))
        named = rng.random() < (0.85 if tag == "div" else 0.4)
        attr = ""
        if named:
            attr = f' {rng.choice(["class", "class", "id"])}="{rng.choice(_NAMED[kind])}"'
        return f"<{tag}{attr}>{inner()}</{tag}>"

    def menu():
        items = []
        for _ in range(rng.integers(2, 9)):
            t = str(rng.choice(_MENU)) if rng.random() < 0.4 else run(rng.integers(1, 3))
            items.append(f"<li><a href='/x'>{text(t, 0)}</a></li>")
        return "<ul>" + "".join(items) + "</ul>"

    def side(kind, long=False):
        def inner():
            out = []
            for _ in range(rng.integers(1, 5 if long else 3)):
                t = str(rng.choice(_PHRASES[kind])) if rng.random() < 0.5 else sentence(rng.integers(2, 40 if kind == "comments" else 14))
                tag = rng.choice(["p", "div", "span", "li", "h3", ""])
                t = text(t, 0)
                t = f"<a href='#'>{t}</a>" if rng.random() < 0.3 and kind not in ("ad", "comments") else t
                out.append(f"<{tag}>{t}</{tag}>" if tag and tag != "span" else f"<span>{t}</span><br>" if tag else t + "<br>")
            return "".join(out)
        return inner

    def header():
        out = f"<div>{text(run(2), 0)}</div>"
        return out + (menu() if rng.random() < 0.4 else "")

    def article():
        out = []
        if rng.random() < 0.8:
            out.append(f"<h1>{text(run(rng.integers(3, 12)).capitalize(), 1)}</h1>")
        for k in range(int(rng.integers(1, 12))):
            r = rng.random()
            n = int(rng.integers(2, 6)) if rng.random() < 0.25 else int(rng.integers(10, 120))
            if r < 0.08:
                out.append(f"<h2>{text(run(rng.integers(1, 7)).capitalize(), 1)}</h2>")
            elif r < 0.13:
                out.append("<ul>" + "".join(f"<li>{text(sentence(rng.integers(2, 15)), 1)}</li>" for _ in range(rng.integers(2, 5))) + "</ul>")
            elif r < 0.17:
                out.append(f"<blockquote>{text(sentence(n), 1)}</blockquote>")
            elif r < 0.25:
                out.append(f"<p><b>{text(sentence(n), 1)}<br>")
            elif r < 0.31:
                out.append(wrap("ad", ["div", "aside"], side("ad")))
            elif r < 0.34:
                out.append(wrap("form", ["form", "div"], side("form")))
            elif r < 0.37:
                out.append(wrap("sidebar", ["aside", "div"], side("sidebar")))
            else:
                out.append(f"<p>{text(sentence(n), 1)}</p>")
        if rng.random() < 0.1:
            out.append(wrap("comments", ["section", "div"], side("comments", True)))
        return "".join(out)

    parts = []
    for chance, kind, tags, inner in ((0.3, "notice", ["div", "aside"], side("notice")), (0.5, "header", ["header", "div"], header),
                                      (0.8, "nav", ["nav", "nav", "div"], menu), (0.4, "ad", ["div"], side("ad")),
                                      (0.2, "sidebar", ["aside", "div"], side("sidebar", True))):
        if rng.random() < chance:
            parts.append(wrap(kind, tags, inner))
    parts.append(wrap("main", ["article", "article", "main", "div", "section"], article))
    for chance, kind, tags, inner in ((0.4, "comments", ["section", "div"], side("comments", True)), (0.35, "sidebar", ["aside", "div"], side("sidebar", True)),
                                      (0.3, "form", ["form", "div"], side("form")), (0.2, "ad", ["div"], side("ad")),
                                      (0.8, "footer", ["footer", "div"], side("footer")), (0.15, "notice", ["div"], side("notice"))):
        if rng.random() < chance:
            parts.append(wrap(kind, tags, inner))
    body = "".join(parts)
    if rng.random() < 0.2:
        body = f'<div id="{rng.choice(["page", "wrapper", "container"])}">{body}</div>'
    return f"<html><head><title>{html.escape(run(4))}</title></head><body>{body}</body></html>", labels


def _shallow(inside: Open | None) -> bool:
    depth = 0
    while inside is not None and depth <= SAMPLE_DEPTH:
        inside, depth = inside.parent, depth + 1
    return depth <= SAMPLE_DEPTH


def fit_pages(sample: list[tuple[str, int]]) -> Labeller:
    return train([page for page, _ in sample])


def train(sample: list[str], made: int = MADE_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Labeller from a sample of raw pages (none is fine) and made ones."""
    rng = np.random.default_rng(seed)
    own = [b for b in (blocks(p) for p in sample) if b and all(_shallow(x.inside) for x in b)]
    words = [w for page in own for b in page for w in b.text.split()[:60]] or [f"{a}{b}" for a in "ka lo mi ter an".split() for b in "s re nto li".split()]
    pages, labels = [Page.of(p) for p in own], [plain_labels(p) for p in own]
    for _ in range(made):
        raw, truth = made_page(rng, words)
        page = blocks(raw)
        if [b.text for b in page] != [t for t, _ in truth if t]:
            continue  # two texts met in one block
        pages.append(Page.of(page))
        labels.append(np.array([y for t, y in truth if t], dtype=np.float32))
    model = Labeller(seed)
    model.fit(pages, labels, epochs, seed)
    return model


class Extractor:
    """Labels pages in batches of bounded size; the vectors of tag paths are kept up to a bound."""

    def __init__(self, model: Labeller):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        """Path number 0 is no element; a path is the number of the one around it and its own entry."""
        self.known: dict[tuple[int, str], int] = {}
        self.sums, self.counts, self.names = [np.zeros(PATH_DIM, np.float32)], [0], [("", "")]
        self.vector: dict[int, np.ndarray] = {}

    def _inner(self, around: int, entry: str) -> int:
        n = self.known.get((around, entry))
        if n is None:
            n = self.known[around, entry] = len(self.sums)
            words = entry.split()
            rows = [_entry_hash(w, PATH_ROWS) for w in words]
            self.sums.append(self.sums[around] + self.model.p["path"][rows].sum(axis=0))
            self.counts.append(self.counts[around] + len(rows))
            self.names.append((words[0], self.names[around][0]))
        return n

    def _path(self, inside: Open | None, seen: dict[Open, int]) -> np.ndarray:
        """The embedding of ``path_features``, summed up along shared elements."""
        chain = []
        while inside is not None and inside not in seen:
            chain.append(inside)
            inside = inside.parent
        k = seen[inside] if inside is not None else 0
        for element in reversed(chain):
            k = seen[element] = self._inner(k, element.entry)
        if k not in self.vector:
            rows = [_entry_hash(f"{i + 1}:{name}", PATH_ROWS) for i, name in enumerate(self.names[k]) if name] or [_entry_hash("(none)", PATH_ROWS)]
            self.vector[k] = (self.sums[k] + self.model.p["path"][rows].sum(axis=0)) / np.sqrt(self.counts[k] + len(rows))
        return self.vector[k]

    def _vectors(self, page: list[Block]) -> np.ndarray:
        if len(self.sums) > KEPT_PATHS:
            self._forget()
        seen: dict[Open, int] = {}
        path = np.stack([self._path(b.inside, seen) for b in page])
        rows, at = _word_rows([b.text for b in page])
        words = np.add.reduceat(self.model.p["words"][rows], at[:-1], axis=0) / np.maximum(np.diff(at), 1)[:, None]
        return np.concatenate([path, words, plain_features(page)], axis=1).astype(np.float32)

    def texts(self, pages: list[str | None]) -> list[str]:
        """Main text of each page."""
        all_blocks = [blocks(p or "") for p in pages]
        out = [""] * len(pages)
        order = sorted((i for i in range(len(pages)) if all_blocks[i]), key=lambda i: len(all_blocks[i]))
        while order:
            some = []
            while order and (not some or (len(some) + 1) * len(all_blocks[order[0]]) <= BATCH_STEPS):
                some.append(order.pop(0))
            x, live = _pad([self._vectors(all_blocks[i]) for i in some])
            main = self.model.margins(x, live) > 0
            for k, i in enumerate(some):
                out[i] = " ".join(b.text for b, m in zip(all_blocks[i], main[:, k]) if m)
        return out


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Pages (all columns but the HTML; same-named inputs replaced) with text and n_chars (code points).

    The labeller is trained, in one task, on at most ``sample_pages`` pages chosen by a hash of their ids, without those of more than
    ``SAMPLE_CHARS`` characters or of elements more than ``SAMPLE_DEPTH`` deep, and on made pages. Null, empty and text-less pages give
    an empty text; repeated rows are labelled each for itself; of a repeated id one page counts for the training; an empty table gives
    an empty result.
    """
    at = F.md5(F.col(f"`{id_col}`").cast("string").cast("binary"))
    ids = pages.select(at.alias("at")).filter("at is not null").distinct().orderBy("at").limit(sample_pages)
    sample = (pages.select(at.alias("at"), F.col(f"`{html_col}`").alias("text")).filter(F.char_length("text") <= SAMPLE_CHARS)
              .join(F.broadcast(ids), "at", "left_semi")  # at most sample_pages ids
              .groupBy("at").agg(F.min("text").alias("text")).withColumn("y", F.lit(0)))
    shared = pages.sparkSession.sparkContext.broadcast(fit_in_task(sample, fit_pages))
    keep = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    cols = [f"c{i}" for i in range(len(keep))]
    src = pages.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keep, cols)], F.col(f"`{html_col}`").alias("_html"))

    def run(batches):
        extractor = Extractor(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = extractor.texts(part.column(len(cols)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:len(cols)], pa.array(texts, pa.string())], [*cols, "text"])

    out = src.mapInArrow(tidy(run), T.StructType([*src.schema.fields[:-1], T.StructField("text", T.StringType())]))
    return out.select(*[F.col(a).alias(c) for c, a in zip(keep, cols)], "text", F.char_length("text").cast("long").alias("n_chars"))
