"""Main-text extraction: a bidirectional LSTM labels every text block of a page, reading the whole page."""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches
from .learning import Adam, fitted
from .markup import Block, Element, blocks

PATH, WORD, SHAPE = 64, 32, 8
FEATURES = PATH + WORD + SHAPE
HIDDEN = 24
TRAINING_PAGES, EPOCHS = 1200, 5
SEED = 13
BATCH = 64  # pages at a time
BATCH_BLOCKS = 1 << 16  # blocks at a time; a longer page goes alone
_DIGIT = re.compile(r"\d")


def _spot(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "replace"))
    return h % size, 1.0 if h & 0x10000 else -1.0


def _path(element: Element | None, cache: dict[str, tuple[int, float]]) -> np.ndarray:
    """The hashed path down to an element; each element adds to the vector of the one around it."""
    way = []
    while element is not None and element.seen is None:
        way.append(element)
        element = element.parent
    x = np.zeros(PATH, np.float32) if element is None else element.seen
    for element in reversed(way):
        x = x.copy()
        for word in (f"t:{element.name}", *(f"h:{w}" for w in element.hints)):
            if word not in cache:
                cache[word] = _spot(word, PATH)
            k, sign = cache[word]
            x[k] = sign
        element.seen = x
    return x


def features(block: Block, place: float, cache: dict[str, tuple[int, float]]) -> np.ndarray:
    """Hashed tag path with its class, id and role words, hashed words, and the shape of the text."""
    x = np.zeros(FEATURES, np.float32)
    x[:PATH] = _path(block.inside, cache)
    k, sign = _spot(f"l:{block.inside.name if block.inside else ''}", PATH)
    x[k] = sign
    text = block.text
    found = text.split(" ")
    for word in found:
        k, sign = _spot(word.lower(), WORD)
        x[PATH + k] += sign
    x[PATH : PATH + WORD] = np.clip(x[PATH : PATH + WORD] / np.sqrt(len(found)), -2, 2)
    n = len(text)
    stops = sum(text.count(c) for c in ".!?")
    x[PATH + WORD :] = (np.log1p(n) / 5, min(1.0, block.linked / n), min(1.0, 20 * stops / n), "©" in text or "(c)" in text.lower(), place, len(_DIGIT.findall(text)) / n, min(50, block.inside.depth if block.inside else 0) / 10, len(found) < 4)
    return x


# --- labelled pages for training ---------------------------------------------------------------------------------

#: What pages call the parts that are not main text, and those that are.
NOT_MAIN = {
    "nav": "nav menu navigation navbar topnav breadcrumb breadcrumbs links tabs pager pagination toc".split(),
    "header": "header masthead banner branding logo top site-header".split(),
    "footer": "footer foot copyright legal colophon bottom site-footer".split(),
    "aside": "sidebar side aside related widget recommended popular trending promo more rail".split(),
    "notice": "cookie consent notice gdpr alert popup modal overlay newsletter subscribe signup paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad adsbox".split(),
    "form": "form search login contact signup subscribe comment-form".split(),
    "comments": "comments comment replies reply discussion responses thread disqus respond".split(),
    "social": "share social sharing follow tags byline-links".split(),
}
MAIN = "article post entry content main body story text main-content post-body entry-content article-body".split()


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiouéäñ") for _ in range(rng.randint(1, 4)))


def _sentences(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        s = [_word(rng) for _ in range(rng.randint(1, 18))] if rng.random() < 0.97 else [_word(rng)] * rng.randint(5, 60)
        out.append((", " if rng.random() < 0.1 else " ").join(s).capitalize() + ".")
    return " ".join(out)


def _mark(label: int, text: str) -> str:
    return f"{'MAIN' if label else 'REST'}{text}"  # a marker that is cut off again


def _part(rng: random.Random, kind: str) -> str:
    tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
    tag = tag if rng.random() < 0.6 and kind not in ("comments", "ad", "notice", "social") or kind == "form" else rng.choice(["div", "section", "ul"])
    named = tag == "div" or tag == "section" or tag == "ul" or rng.random() < 0.3
    name = rng.choice(NOT_MAIN[kind])
    attr = f' {rng.choice(["class", "id", "class"])}="{name}{rng.choice(["", "-wrap", " box", " block"])}"' if named else ""
    link = lambda: f'<a href="/{_word(rng)}">{_mark(0, _word(rng))}</a>'
    if kind in ("nav", "social") or kind == "aside" and rng.random() < 0.5:
        items = [link() for _ in range(rng.randint(2, 9))]
        body = "<ul>" + "".join(f"<li>{i}{rng.choice(['</li>', '</li>', ''])}" for i in items) + "</ul>" if rng.random() < 0.7 else rng.choice([" | ", " ", "</div><div>"]).join(items)
    elif kind == "footer":
        body = _mark(0, rng.choice(["&copy; ", "© ", "", "All rights reserved. "]) + f"{_word(rng)}.example &middot; {_sentences(rng, rng.randint(0, 3))}") if rng.random() < 0.7 else f"<p>{_mark(0, '© ' + _word(rng))}</p><p>{link()} {link()}</p>"
    elif kind == "form":
        body = f"<label>{_mark(0, _word(rng))}</label><input name=q><button>{_mark(0, _word(rng))}</button>" + (f"<p>{_mark(0, _sentences(rng, 1))}</p>" if rng.random() < 0.4 else "")
        body += "<select>" + "".join(f"<option>{_mark(0, _word(rng))}" for _ in range(rng.randint(1, 5))) + "</select>" if rng.random() < 0.3 else ""
    elif kind == "comments":
        body = "".join(f'<{t} class="{rng.choice(["comment", "reply", "c"])}"><p>{_mark(0, _sentences(rng, rng.randint(1, 5)))}</p></{t}>' for t in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 6)))
        body = (f"<h3>{_mark(0, _word(rng))}</h3>" if rng.random() < 0.6 else "") + body
    elif kind == "header":
        body = rng.choice(["<div>{}</div>", "<p>{}</p>", "<h1>{}</h1>", "{}"]).format(_mark(0, _sentences(rng, 1)))
    else:  # adverts, notices, teasers: prose outside the main text
        body = _mark(0, _sentences(rng, rng.randint(1, 5)))
        body = f"<p>{body}</p>" if rng.random() < 0.4 else body
        body += link() if rng.random() < 0.3 else ""
        if rng.random() < 0.15:
            shell = rng.choice(["noscript", "object", "template", "svg"])
            body = f"<{shell}>{body}</{shell}>"
    return f"<{tag}{attr}>{body}</{tag}>"


def _main(rng: random.Random) -> str:
    kind = rng.random()
    tag, attr = ("article", "") if kind < 0.5 else ("main", "") if kind < 0.6 else (rng.choice(["div", "section", "article"]), f' {rng.choice(["class", "id"])}="{rng.choice(MAIN)}"') if kind < 0.95 else ("div", "")
    out = []
    if rng.random() < 0.85:
        head = rng.choice(["h1", "h1", "h2"])
        out.append(f"<{head}>{_mark(1, _sentences(rng, 1))}</{head}>")
    for _ in range(rng.choice([1, 2, 3, 5, 8, 12, 20, 35])):
        r = rng.random()
        text = _mark(1, _sentences(rng, rng.choice([1, 1, 2, 3, 5, 9])))
        if r < 0.62:
            out.append(f"<p>{text}</p>")
        elif r < 0.72:
            out.append(f"<p>{text}")
        elif r < 0.80:
            out.append(f"<p><b>{text}<br>")
        elif r < 0.86:
            out.append(f"<h{rng.randint(2, 4)}>{_mark(1, _word(rng))}</h3>")
        elif r < 0.91:
            out.append("<ul>" + "".join(f"<li>{_mark(1, _sentences(rng, 1))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
        elif r < 0.95:
            out.append(f"<blockquote><p>{text}</p></blockquote>")
        elif r < 0.97:
            out.append(f"<p>{text} <a href=/{_word(rng)}>{_word(rng)}</a> {_word(rng)}.</p>")
        else:
            out.append(_part(rng, rng.choice(["ad", "aside", "social", "form", "notice"])))
    if rng.random() < 0.15:
        out.append(_part(rng, "comments"))
    return f"<{tag}{attr}>{''.join(out)}</{tag}>"


def training_page(rng: random.Random) -> tuple[list[Block], list[int]]:
    """A made-up page: its blocks, and 1 for each that is main text."""
    before = [k for k in ("header", "nav", "notice", "ad", "form", "aside") if rng.random() < 0.45]
    after = [k for k in ("ad", "comments", "aside", "social", "notice", "form", "footer", "nav") if rng.random() < (0.75 if k == "footer" else 0.35)]
    rng.shuffle(before)
    parts = [_part(rng, k) for k in before] + [_main(rng)] + [_part(rng, k) for k in after]
    if rng.random() < 0.3:
        middle = "".join(parts[len(before) :])
        parts = [*parts[: len(before)], f'<div class="{rng.choice(["container", "wrapper", "page", "row", "layout"])}">{middle}</div>']
    found = blocks("<html><body>" + "".join(parts) + "</body></html>")
    labels = [int("MAIN" in b.text) for b in found]
    for b in found:
        n = b.text.count("MAIN") + b.text.count("REST")
        b.text = b.text.replace("MAIN", "").replace("REST", "") or "."
        b.linked = max(0, b.linked - 4 * n)
    return found, labels


# --- network -----------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Bidirectional LSTM over the blocks of a page, then one logistic unit per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        scale = lambda *s: (rng.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32)
        self.w = {f"{d}{k}": v for d in "fb" for k, v in (("x", scale(FEATURES, 4 * HIDDEN)), ("h", scale(HIDDEN, 4 * HIDDEN)), ("c", np.zeros(4 * HIDDEN, np.float32)))}
        self.w |= {"out": scale(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.w[f"{d}c"][HIDDEN : 2 * HIDDEN] = 1

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction over x [time, pages, features]; padding carries states on unchanged."""
        steps, pages = x.shape[:2]
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        drive = (x.reshape(steps * pages, -1) @ self.w[f"{d}x"] + self.w[f"{d}c"]).reshape(steps, pages, -1)
        out, tape = np.zeros((steps, pages, HIDDEN), np.float32), []
        for t in range(steps):
            z = drive[t] + h @ self.w[f"{d}h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = np.where(m, f * c + i * g, c)
            s = np.tanh(new_c)
            new_h = np.where(m, o * s, h)
            if keep:
                tape.append((h, c, i, f, o, g, s, m))
            h, c = new_h, new_c
            out[t] = h
        return out, tape

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        ahead, tape_f = self._run("f", x, mask, keep)
        back, tape_b = self._run("b", x[::-1], mask[::-1], keep)
        both = np.concatenate([ahead, back[::-1]], 2)
        return (both @ self.w["out"])[..., 0] + self.w["bias"], both, tape_f, tape_b

    def _unroll(self, d: str, x: np.ndarray, tape: list, slope: np.ndarray, into: dict[str, np.ndarray]) -> None:
        dh = dc = np.zeros_like(slope[0])
        dz = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        weight = into[f"{d}h"] = np.zeros_like(self.w[f"{d}h"])
        for t in range(len(tape) - 1, -1, -1):
            h, c, i, f, o, g, s, m = tape[t]
            total = dh + slope[t]
            inner = (dc + total * o * (1 - s * s)) * m
            z = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), total * s * o * (1 - o) * m, inner * i * (1 - g * g)], 1)
            dz[t] = z
            weight += h.T @ z
            dh = z @ self.w[f"{d}h"].T + np.where(m, 0, total)
            dc = np.where(m, inner * f, dc)
        flat = dz.reshape(-1, 4 * HIDDEN)
        into[f"{d}x"], into[f"{d}c"] = x.reshape(len(flat), -1).T @ flat, flat.sum(0)

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, seed: int = SEED) -> BlockLabeller:
        rng, optimiser = np.random.default_rng(seed), Adam(self.w, 6e-3)
        pages = sorted(pages, key=lambda p: len(p[1]))
        batches = [pages[s : s + 24] for s in range(0, len(pages), 24)]
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                x, mask = _padded([p[0] for p in batches[k]])
                gold = np.zeros(mask.shape, np.float32)
                for j, (_, y) in enumerate(batches[k]):
                    gold[: len(y), j] = y
                logits, both, tape_f, tape_b = self.logits(x, mask, keep=True)
                slope = ((_sigmoid(logits) - gold) * mask / mask.sum()).astype(np.float32)
                grads = {"out": both.reshape(-1, 2 * HIDDEN).T @ slope.reshape(-1, 1), "bias": np.array([slope.sum()], np.float32)}
                below = slope[..., None] * self.w["out"][:, 0]
                self._unroll("f", x, tape_f, below[..., :HIDDEN], grads)
                self._unroll("b", x[::-1], tape_b, below[::-1][..., HIDDEN:], grads)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                optimiser.update({n: g * min(1.0, 1.0 / max(norm, 1e-9)) for n, g in grads.items()})
        return self

    def main(self, pages: list[list[Block]], cache: dict[str, tuple[int, float]]) -> list[list[bool]]:
        """For every block of every page, whether it is main text."""
        out: list[list[bool]] = [[] for _ in pages]
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        s = 0
        while s < len(order):
            e = s + 1
            while e < min(len(order), s + BATCH) and (e - s + 1) * len(pages[order[e]]) <= BATCH_BLOCKS:
                e += 1
            some = order[s:e]
            x, mask = _padded([page_features(pages[k], cache) for k in some])
            logits = self.logits(x, mask)[0]
            for j, k in enumerate(some):
                out[k] = (logits[: len(pages[k]), j] > 0).tolist()
            s = e
        return out


def page_features(page: list[Block], cache: dict[str, tuple[int, float]]) -> np.ndarray:
    return np.stack([features(b, k / len(page), cache) for k, b in enumerate(page)])


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), FEATURES), np.float32), np.zeros((steps, len(pages)), bool)
    for j, p in enumerate(pages):
        x[: len(p), j], mask[: len(p), j] = p, True
    return x, mask


def train_labeller(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> BlockLabeller:
    """A network trained on made-up pages whose blocks carry their labels; it never sees the pages that it labels."""
    rng, cache, examples = random.Random(seed), {}, []
    for _ in range(pages):
        found, labels = training_page(rng)
        examples.append((page_features(found, cache), np.array(labels, np.float32)))
    return BlockLabeller(seed).fit(examples, epochs)


def extract_main_text(pages: DataFrame, labeller: BlockLabeller, url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    text joins the blocks that the network takes for main text, in page order, by one newline; white space inside a block
    is one space, character references are decoded, nothing else is dropped or cut. Null and empty pages, and pages
    without main text, give the empty string; broken markup is read as it comes, however often tags are left open; rows that repeat get equal
    results; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, float]] = {}
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                found = [blocks(h.as_py()) for h in part.column(2)]
                texts = ["\n".join(b.text for b, keep in zip(page, kept, strict=True) if keep) for page, kept in zip(found, labeller.main(found, cache), strict=True)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeller = fitted(spark.range(1), lambda batches: train_labeller())  # in a task: the driver only passes it on
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), labeller)
