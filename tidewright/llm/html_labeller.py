"""Main-text extraction: a bidirectional LSTM labels every block of a page.

A page becomes the sequence of its text blocks. Each block is read as the mean of learned vectors of its tag path (the
open elements with their class and id words, hashed), the mean of learned vectors of its words (hashed) and a few
figures: length, share of text in links, sentence marks, place in the page. One LSTM reads the sequence forwards, one
backwards, so each label sees the whole page. Blocks labelled content are joined by an empty line.

The labels to learn from are made here: blocks of at most ``sample`` pages, by their semantic elements, and pages put
together from those pages' own texts in varied layouts (article, main and plain div bodies, with menus, headers,
footers, sidebars, notices, adverts, forms and reader comments around them), whose labels are known. Training is plain
numpy on the driver, on a bounded number of pages, and repeats exactly. Tasks get the model, some hundred kilobytes.

Null or empty HTML and pages without text give an empty text; a page of any length is read whole, its blocks as one
sequence. Repeated rows, and pages that tie in the sample's order, get equal results. An empty table gives an empty
result. Other columns are left alone, but for ``text`` and ``n_blocks``, which are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import small_batches, tidy
from tidewright.llm.html_blocks import Block, blocks

PATH_ROWS, WORD_ROWS, DIM, HIDDEN, FIGURES = 512, 1024, 12, 16, 6
INPUT = 2 * DIM + FIGURES
_MARKS = re.compile(r"[.!?;,]")


def _hash(text: str, rows: int) -> int:
    return xxhash.xxh32_intdigest(text) % rows


_PATH_IDS: dict[tuple[str, ...], list[int]] = {}


def _path_ids(path: tuple[str, ...]) -> list[int]:
    known = _PATH_IDS.get(path)
    if known is None:
        if len(_PATH_IDS) > 50_000:
            _PATH_IDS.clear()
        own = [f"{x}^" for x in path[-1:]] + list(dict.fromkeys(x for x in path if x not in ("html", "body")))
        known = _PATH_IDS[path] = [_hash(x, PATH_ROWS) for x in own] or [0]
    return known


@dataclass
class Page:
    """What the network reads of one page: hashed path and word ids with their blocks, and the figures."""

    paths: np.ndarray
    path_of: np.ndarray
    words: np.ndarray
    word_of: np.ndarray
    figures: np.ndarray
    size: int


def read(page: list[Block]) -> Page:
    n = len(page)
    paths = [_path_ids(b.path) for b in page]
    words = [[_hash(w, WORD_ROWS) for w in b.text.lower().split()] for b in page]
    figures = np.zeros((n, FIGURES), np.float32)
    for i, b in enumerate(page):
        k = len(b.text)
        figures[i] = (np.log1p(k) / 6, b.link_chars / max(1, k), min(1.0, len(_MARKS.findall(b.text)) / max(1, len(words[i])) * 3), i / max(1, n - 1), np.log1p(n) / 4, float(k < 40))
    lengths = [len(x) for x in paths], [len(x) for x in words]
    flat = [np.array([y for x in xs for y in x], np.int64) for xs in (paths, words)]
    return Page(flat[0], np.repeat(np.arange(n), lengths[0]), flat[1], np.repeat(np.arange(n), lengths[1]), figures, n)


@dataclass
class Network:
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        w = {"path": r.normal(0, 0.3, (PATH_ROWS, DIM)), "word": r.normal(0, 0.1, (WORD_ROWS, DIM)), "out": r.normal(0, 0.2, (2 * HIDDEN + INPUT,)), "bias": np.zeros(1)}
        for d in "fb":
            w[f"{d}x"] = r.normal(0, 0.25, (INPUT, 4 * HIDDEN))
            w[f"{d}h"] = r.normal(0, 0.25, (HIDDEN, 4 * HIDDEN))
            w[f"{d}0"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        return cls({k: v.astype(np.float32) for k, v in w.items()})


def _mean(table: np.ndarray, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, table.shape[1]), np.float32)
    if len(ids):
        count = np.bincount(owner, minlength=n)
        there = np.flatnonzero(count)
        out[there] = np.add.reduceat(table[ids], (np.cumsum(count) - count)[there]) / count[there, None]
    return out


def _batch(pages: list[Page]) -> tuple[Page, np.ndarray, np.ndarray]:
    """The pages as one, with each block's page and place."""
    sizes = np.array([p.size for p in pages])
    first = np.cumsum(sizes) - sizes
    one = Page(np.concatenate([p.paths for p in pages]), np.concatenate([p.path_of + f for p, f in zip(pages, first, strict=True)]), np.concatenate([p.words for p in pages]), np.concatenate([p.word_of + f for p, f in zip(pages, first, strict=True)]), np.concatenate([p.figures for p in pages]), int(sizes.sum()))
    return one, np.repeat(np.arange(len(pages)), sizes), np.arange(one.size) - np.repeat(first, sizes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray, keep: bool):
    """Hidden states of an LSTM over x (pages, steps, input); steps outside the mask leave the state alone."""
    pages, steps, _ = x.shape
    pre = x @ wx + b
    h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    out, saved = np.zeros((pages, steps, HIDDEN), np.float32), []
    for t in range(steps):
        z = pre[:, t] + h @ wh
        g = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = g[:, :HIDDEN], g[:, HIDDEN : 2 * HIDDEN], g[:, 2 * HIDDEN :]
        u = np.tanh(z[:, 3 * HIDDEN :])
        m = mask[:, t, None]
        c2 = np.where(m, f * c + i * u, c)
        tc = np.tanh(c2)
        h2 = np.where(m, o * tc, h)
        if keep:
            saved.append((i, f, o, u, c, tc, h, m))
        h, c = h2, c2
        out[:, t] = h
    return out, saved


def _back(dout: np.ndarray, x: np.ndarray, saved: list, wx: np.ndarray, wh: np.ndarray):
    dx, dwx, dwh, db = np.zeros_like(x), np.zeros_like(wx), np.zeros_like(wh), np.zeros(4 * HIDDEN, np.float32)
    dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
    for t in range(x.shape[1] - 1, -1, -1):
        i, f, o, u, c, tc, h, m = saved[t]
        dh = dh + dout[:, t]
        dht = np.where(m, dh, 0)
        dct = np.where(m, dc, 0) + dht * o * (1 - tc * tc)
        dz = np.concatenate((dct * u * i * (1 - i), dct * c * f * (1 - f), dht * tc * o * (1 - o), dct * i * (1 - u * u)), 1)
        dwx += x[:, t].T @ dz
        dwh += h.T @ dz
        db += dz.sum(0)
        dx[:, t] = dz @ wx.T
        dh = np.where(m, 0, dh) + dz @ wh.T
        dc = np.where(m, dct * f, dc)
    return dx, dwx, dwh, db


def _forward(net: Network, pages: list[Page], keep: bool = False):
    w = net.weights
    one, page, place = _batch(pages)
    flat = np.concatenate((_mean(w["path"], one.paths, one.path_of, one.size), _mean(w["word"], one.words, one.word_of, one.size), one.figures), 1)
    steps = max(p.size for p in pages)
    x, mask = np.zeros((len(pages), steps, INPUT), np.float32), np.zeros((len(pages), steps), bool)
    x[page, place], mask[page, place] = flat, True
    hf, sf = _run(x, mask, w["fx"], w["fh"], w["f0"], keep)
    hb, sb = _run(x[:, ::-1], mask[:, ::-1], w["bx"], w["bh"], w["b0"], keep)
    top = np.concatenate((hf[page, place], hb[:, ::-1][page, place], flat), 1)
    return _sigmoid(top @ w["out"] + w["bias"]), (one, page, place, flat, x, mask, sf, sb, top)


def train(examples: list[tuple[Page, np.ndarray]], rounds: int = 8, batch: int = 24, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on the cross entropy of all blocks."""
    net, r, step = Network.fresh(seed), np.random.default_rng(seed), 0
    w = net.weights
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for epoch in range(rounds):
        order = r.permutation(len(examples))
        for a in range(0, len(order), batch):
            own = [examples[i] for i in order[a : a + batch]]
            p, (one, page, place, flat, x, _, sf, sb, top) = _forward(net, [e[0] for e in own], True)
            dz = ((p - np.concatenate([e[1] for e in own])) / len(p)).astype(np.float32)
            grad = {"out": top.T @ dz, "bias": dz.sum(keepdims=True)}
            dtop = dz[:, None] * w["out"]
            df, db = np.zeros((*x.shape[:2], HIDDEN), np.float32), np.zeros((*x.shape[:2], HIDDEN), np.float32)
            df[page, place], db[page, place] = dtop[:, :HIDDEN], dtop[:, HIDDEN : 2 * HIDDEN]
            dxf, grad["fx"], grad["fh"], grad["f0"] = _back(df, x, sf, w["fx"], w["fh"])
            dxb, grad["bx"], grad["bh"], grad["b0"] = _back(db[:, ::-1], x[:, ::-1], sb, w["bx"], w["bh"])
            dflat = dtop[:, 2 * HIDDEN :] + dxf[page, place] + dxb[:, ::-1][page, place]
            for name, ids, owner, at in (("path", one.paths, one.path_of, 0), ("word", one.words, one.word_of, DIM)):
                share = dflat[:, at : at + DIM] / np.maximum(np.bincount(owner, minlength=one.size), 1)[:, None]
                grad[name] = np.zeros_like(w[name])
                np.add.at(grad[name], ids, share[owner].astype(np.float32))
            step += 1
            now = rate * (1 - 0.7 * epoch / rounds)
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


#: Element names, and class and id words by which pages mark what is not their article.
NOT_ARTICLE = frozenset("nav header footer aside form menu dialog".split())
NOISE_WORDS = frozenset("ad ads advert advertisement sponsor sponsored promo banner sidebar widget related cookie consent notice popup modal newsletter subscribe share social comment comments respond reply nav navbar menu breadcrumb breadcrumbs footer header masthead copyright login signup search pagination pager toolbar".split())
BODY_WORDS = frozenset("content article post entry story main body text".split())


def by_elements(b: Block, in_body: bool) -> bool:
    """The label that a block's own elements suggest: inside the article and inside nothing that marks noise."""
    noise = any(x in NOT_ARTICLE or x[0] == "." and x[1:] in NOISE_WORDS for x in b.path)
    body = any(x in ("article", "main") or x[0] == "." and x[1:] in BODY_WORDS for x in b.path)
    return not noise and (body or not in_body)


def weak_labels(page: list[Block]) -> np.ndarray:
    some = any(by_elements(b, True) for b in page)
    return np.array([by_elements(b, some) for b in page], np.float32)


#: Paths of bodies and of what surrounds them in the made pages.
_BODIES = (("article",), ("main", "article"), ("main",), ("div", ".content"), ("div", ".post", ".content"), ("div", ".entry", ".content"), ("section", ".article", ".body"), ("div", ".story"), ("div",), ("div", ".page", "article"), ("div", ".wrapper", "div", ".main"))
_BEFORE = (("nav", "ul", "li"), ("header", "nav", "ul", "li"), ("header",), ("header", "h1"), ("header", "p"), ("div", ".header"), ("div", ".menu", "ul", "li"), ("div", ".navbar"), ("div", ".ad"), ("div", ".cookie", ".notice"), ("div", ".cookie", ".banner", "p"), ("div", ".notice"), ("ul", ".breadcrumb", "li"), ("form",), ("form", "label"), ("div", ".advert"), ("div", ".search", "form"), ("div", ".banner"), ("section", ".notice", "p"))
_AFTER = (("footer",), ("footer", "p"), ("div", ".footer"), ("aside",), ("aside", "p"), ("aside", "ul", "li"), ("div", ".sidebar", "p"), ("div", ".sidebar", "ul", "li"), ("div", ".related", "ul", "li"), ("section", ".comments", "p"), ("div", ".comments", "div", ".comment", "p"), ("section", ".comments", "article", ".comment", "p"), ("ol", ".comments", "li", "p"), ("div", ".ad"), ("div", ".ads", "p"), ("form", "label"), ("form", ".newsletter", "p"), ("div", ".newsletter"), ("div", ".share"), ("div", ".copyright"), ("div", ".advertisement"), ("div", ".comment"))
_INSIDE = (("div", ".ad"), ("aside",), ("aside", "p"), ("div", ".advert", "p"), ("div", ".related", "ul", "li"), ("form",), ("div", ".share"), ("div", ".promo"))
#: What the whole page may stand in, menus and footers too.
_AROUND = ((), (), (), (), ("div", ".wrapper"), ("div", ".page"), ("table", "tr", "td"), ("div", ".container", "div"), ("center",))
_LISTS = (("ul", "li"), ("ol", "li"), ("ol", "li", "p"), ("dl", "dd"), ("dl", "dt"))
_PARTS = (("p",), ("p",), ("p",), ("p",), ("h2",), ("blockquote",), ("blockquote", "p"), ("ul", "li"), ("pre",), ("div",), ("section", "p"), ("h1",), ("h3",), ("figure", "figcaption"), ("table", "tr", "td"), ())


def made_pages(texts: list[str], n: int, seed: int = 11) -> list[tuple[list[Block], np.ndarray]]:
    """Pages of these texts in varied layouts, with labels."""
    r = np.random.default_rng(seed)
    pick = lambda options: options[int(r.integers(len(options)))]
    short = lambda: " ".join(pick(texts).split()[: int(r.integers(1, 14))])
    out = []
    for _ in range(n):
        page: list[Block] = []
        labels: list[int] = []
        around = pick(_AROUND)

        def noise(paths, top=(), page=page, labels=labels, around=around):
            path = ("html", "body", *around, *top, *pick(paths))
            for _ in range(int(r.integers(2, 8)) if path[-1] == "li" else int(r.integers(1, 3))):
                text = short() if path[-1] in ("li", "label") or r.random() < 0.5 else pick(texts)
                page.append(Block(path, text, len(text) if path[-1] == "li" and r.random() < 0.9 else 0))
                labels.append(0)

        for _ in range(int(r.integers(0, 4))):
            noise(_BEFORE)
        if r.random() < 0.15:  # a list of links that nothing names
            noise((("ul", "li"), ("td", "ul", "li"), ("div", "ul", "li"), ("ol", "li")))
        body = pick(_BODIES)
        for k in range(int(r.integers(1, 16))):
            if k and r.random() < 0.06:
                noise(_INSIDE, body)
            part = ("h1",) if k == 0 and r.random() < 0.7 else pick(_LISTS) if r.random() < 0.12 else pick(_PARTS)
            for _ in range(int(r.integers(2, 6)) if part in _LISTS else 1):
                text = short() if part and part[-1] in ("h1", "h2", "h3", "dt") or r.random() < (0.5 if part in _LISTS else 0.25) else pick(texts)
                page.append(Block(("html", "body", *around, *body, *part), text, int(len(text) * r.random()) if r.random() < 0.05 else 0))
                labels.append(1)
        for _ in range(int(r.integers(0, 4))):
            noise(_AFTER, body if r.random() < 0.1 else ())
        out.append((page, np.array(labels, np.float32)))
    return out


def fit(pages: DataFrame, sample: int = 200, made: int = 900, html_col: str = "html", id_col: str = "url") -> Network:
    """A network from at most ``sample`` of the pages, those whose ids hash lowest, and ``made`` pages of their texts."""
    hashed = pages.where(F.length(html_col) > 0).withColumn("_k", F.xxhash64(F.col(id_col)))
    last = hashed.select("_k").orderBy("_k").limit(sample).agg(F.max("_k")).first()[0]  # numbers alone leave the tasks
    some = hashed.where(F.col("_k") <= F.lit(last)).select("_k", F.col(html_col).alias("html")).orderBy("_k", "html").limit(sample).collect()
    real = [b for b in (blocks(x.html) for x in some) if b]
    if not real:
        return Network.fresh()
    texts = [b.text for page in real for b in page]
    examples = [(read(page), weak_labels(page)) for page in real]
    examples += [(read(page), labels) for page, labels in made_pages(texts, made)]
    return train(examples)


def labelled(net: Network, pages: list[list[Block]], group: int = 128) -> list[np.ndarray]:
    """The network's content score of every block, reading pages of like length together."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    for a in range(0, len(order), group):
        own = order[a : a + group]
        # a page much longer than the rest would make all of them wide
        while own:
            part = [i for i in own if len(pages[i]) <= 2 * len(pages[own[0]]) + 8]
            own = own[len(part) :]
            read_pages = [read(pages[i]) for i in part]
            scores, at = _forward(net, read_pages)[0], 0
            for i, p in zip(part, read_pages, strict=True):
                out[i], at = scores[at : at + p.size], at + p.size
    return out


def extract(pages: DataFrame, net: Network, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_blocks``, the number of blocks before labelling; the HTML column goes."""
    spread = pages.sparkSession.sparkContext.broadcast(net)
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_blocks")]
    schema = pages.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_blocks")).schema

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = [blocks(h) if h else [] for h in part.column(part.schema.get_field_index(html_col)).to_pylist()]
                texts = ["\n\n".join(b.text for b, s in zip(page, scores, strict=True) if s >= 0.5) for page, scores in zip(found, labelled(spread.value, found), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in keep), pa.array(texts, pa.string()), pa.array([len(p) for p in found], pa.int64())], [*keep, "text", "n_blocks"])
        tidy()

    small_batches(pages.sparkSession, 8 << 20)
    return pages.select(*keep, html_col).mapInArrow(run, schema)
