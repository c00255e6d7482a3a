"""Main text of web pages by a recurrent block labeller.

A page is parsed into its text blocks in order. Each block is described by its tag path (hashed tags, classes, ids and roles), its hashed words and a few rates; a
bidirectional LSTM in numpy reads the whole sequence of a page and labels every block as main text or not, so a block's label depends on the page around
it. The model is trained here, on pages that made_page() invents: articles in varied mark-up between menus, headers, notices, adverts, sidebars, forms, reader comments and
footers. It takes a few seconds on the driver; the weights (some 100 kB, the same for every input) go to the executors.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import table

PATH, WORDS, RATES, HIDDEN = 96, 32, 8, 24
WIDTH = PATH + WORDS + RATES
#: Pages that are parsed, and blocks that go through the network, at a time.
PAGES, BLOCKS = 256, 4096
SILENT = {"script", "style", "noscript", "template", "svg", "title", "iframe", "object", "canvas", "select", "textarea"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Open elements of these kinds end where another of them begins.
SELF_ENDING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that end an open paragraph.
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
#: Elements whose content is text up to their own end tag; all of them are silent.
RAW = {"script", "style", "title", "textarea", "iframe"}
_SPACE = re.compile(r"\s+")
#: The start of a tag, a comment or another declaration.
_TOKEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?/])")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))?)?)""")


@functools.lru_cache(100_000)
def _slot(word: str, size: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return h % size, 1.0 if h >> 16 & 1 else -1.0


_MARK, _DIGIT = re.compile(r"[a-z]+"), re.compile(r"\d")


@functools.lru_cache(20_000)
def _marks(tag: str, marks: str) -> np.ndarray:
    """A tag and its classes, ids and roles, hashed."""
    out = np.zeros(PATH, np.float32)
    for name in (tag, *(f".{m}" for m in _MARK.findall(marks.lower()))):
        at, sign = _slot(name, PATH)
        out[at] += sign
    return out


class Node:
    """An open block element: its own hashed marks and the sum of those from the root down, so that a block's path costs the same at any depth."""

    __slots__ = ("own", "total", "above", "depth")

    def __init__(self, tag: str, marks: str, above: "Node | None"):
        self.own = _marks(tag, marks)
        self.total = self.own if above is None else above.total + self.own
        self.above, self.depth = above, 1 if above is None else above.depth + 1


Block = tuple[str, Node | None, int]


class Leaves:
    """Text blocks of a page: (text, innermost block element, characters in links), read as browsers read it: unclosed comments, tags and scripts run to the end of the page. Each character is read a fixed
    number of times, and each tag is dealt with in constant time, but for the elements that it closes."""

    def __init__(self):
        self.stack: list[tuple[str, Node | None]] = []
        self.open: dict[str, int] = {}
        self.outer: list[int] = []  # places of the block elements in the stack
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked = self.silent = self.links = 0

    def read(self, html: str) -> list[Block]:
        at = 0
        while m := _TOKEN.search(html, at):
            self.data(html[at : m.start()])
            close, name, comment = m.group(1, 2, 3)
            if name:
                found = self._attributes(html, m.end()) if not close else (html.find(">", m.end()) + 1, "")
                if not found[0]:
                    break
                at, tag = found[0], name.lower()
                if close:
                    self.end(tag)
                else:
                    self.start(tag, found[1])
                    if tag in RAW:  # its content is no mark-up
                        end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                        if not end:
                            at = len(html)
                            break
                        at = end.start()
            else:
                end = html.find("-->" if comment else ">", m.end() - 2 if comment else m.end())
                if end < 0:
                    break
                at = end + (3 if comment else 1)
        else:
            self.data(html[at:])
        self.flush()
        return self.blocks

    def _attributes(self, html: str, at: int) -> tuple[int, str]:
        """(end of the start tag, its class, id and role); 0: it doesn't end."""
        marks = []
        while m := _ATTRIBUTE.match(html, at):
            at = m.end()
            if m.group(1):
                return at, " ".join(marks)
            if m.group(2).lower() in ("class", "id", "role"):
                marks.append(unescape(m.group(3) or m.group(4) or m.group(5) or ""))
        return 0, ""

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((text, self.stack[self.outer[-1]][1] if self.outer else None, self.linked))
        self.text, self.linked = [], 0

    def _pop(self, at: int) -> None:
        for tag, _ in self.stack[at:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
            self.open[tag] -= 1
        del self.stack[at:]
        while self.outer and self.outer[-1] >= at:
            self.outer.pop()

    def start(self, tag: str, marks: str) -> None:
        if tag == "br":
            self.text.append(" ")
        if tag not in INLINE:
            self.flush()
            ends = SELF_ENDING.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            for at in reversed(self.outer[-8:]):
                open_ = self.stack[at][0]
                if open_ in ends:
                    self._pop(at)
                    break
                if open_ != "p":
                    break
        if tag not in VOID:
            node = None
            if tag not in INLINE:
                node = Node(tag, marks, self.stack[self.outer[-1]][1] if self.outer else None)
                self.outer.append(len(self.stack))
            self.stack.append((tag, node))
            self.open[tag] = self.open.get(tag, 0) + 1
            self.silent += tag in SILENT
            self.links += tag == "a"

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if self.open.get(tag):
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self._pop(at)

    def data(self, text: str) -> None:
        if text and not self.silent:
            text = unescape(text) if "&" in text else text
            self.text.append(text)
            self.linked += len(text.strip()) if self.links else 0


def leaves(html: str | None) -> list[Block]:
    return Leaves().read(html or "")


def vector(block: Block, first: bool) -> np.ndarray:
    text, node, linked = block
    out = np.zeros(WIDTH, np.float32)
    depth = node.depth if node else 0
    if node:
        out[:PATH] = 0.7 * node.total
        for _ in range(3):  # the innermost three count fully
            if node:
                out[:PATH] += 0.3 * node.own
                node = node.above
    words = text.lower().split()
    at, sign = zip(*[_slot(w, WORDS) for w in words])
    out[PATH : PATH + WORDS] = np.bincount(at, sign, WORDS) / len(words)
    n = len(text)
    out[PATH + WORDS :] = [np.log1p(n) / 5, np.log1p(len(words)) / 4, linked / n, sum(map(text.count, ".!?")) / len(words), len(_DIGIT.findall(text)) / n, "©" in text, first, min(depth, 64) / 8]
    return out


# ---------------------------------------------------------------- the model


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _cell(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """One direction of the LSTM over x (time, batch, width); to keep: what the gradient needs."""
    steps, rows = x.shape[:2]
    n = u.shape[0]
    h, c = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
    ahead = x @ w + b
    out, kept = np.empty((steps, rows, n), np.float32), []
    for t in range(steps):
        z = ahead[t] + h @ u
        g = _sigmoid(z[:, : 3 * n])
        i, f, o, a = g[:, :n], g[:, n : 2 * n], g[:, 2 * n :], np.tanh(z[:, 3 * n :])
        new = f * c + i * a
        th = np.tanh(new)
        if keep:
            kept.append((i, f, o, a, c, th, h))
        c, h = new, o * th
        out[t] = h
    return out, kept


def _cell_back(x, w, u, kept, dout):
    n = u.shape[0]
    dz = np.empty((*dout.shape[:2], 4 * n), np.float32)
    dh, dc, du = np.zeros_like(dout[0]), np.zeros_like(dout[0]), np.zeros_like(u)
    for t in range(len(dout) - 1, -1, -1):
        i, f, o, a, c, th, h = kept[t]
        d = dout[t] + dh
        dc = dc + d * o * (1 - th**2)
        dz[t] = np.concatenate((dc * a * i * (1 - i), dc * c * f * (1 - f), d * th * o * (1 - o), dc * i * (1 - a**2)), 1)
        du += h.T @ dz[t]
        dh, dc = dz[t] @ u.T, dc * f
    return np.einsum("tbi,tbj->ij", x, dz, optimize=True), du, dz.sum((0, 1))


class Labeller:
    def __init__(self, weights: list[np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, seed: int) -> Labeller:
        draw = np.random.default_rng(seed)
        sizes = [(WIDTH, 4 * HIDDEN), (HIDDEN, 4 * HIDDEN), (4 * HIDDEN,)] * 2 + [(2 * HIDDEN, 1), (1,)]
        return cls([(draw.normal(size=s) / np.sqrt(s[0]) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in sizes])

    def logits(self, x: np.ndarray) -> np.ndarray:
        """For x (time, batch, width); sequences of one length only."""
        return self._forward(x)[0]

    def _forward(self, x, keep: bool = False):
        w = self.weights
        one, kept1 = _cell(x, *w[:3], keep)
        two, kept2 = _cell(x[::-1], *w[3:6], keep)
        both = np.concatenate((one, two[::-1]), 2)
        return (both @ w[6] + w[7])[..., 0], both, kept1, kept2

    def gradient(self, x, y, mask):
        w = self.weights
        logit, both, kept1, kept2 = self._forward(x, keep=True)
        d = ((_sigmoid(logit) - y) * mask / mask.sum())[..., None].astype(np.float32)
        dboth = d @ w[6].T
        first = _cell_back(x, w[0], w[1], kept1, dboth[..., :HIDDEN])
        second = _cell_back(x[::-1], w[3], w[4], kept2, dboth[::-1, :, HIDDEN:])
        return [*first, *second, np.einsum("tbi,tbj->ij", both, d), d.sum((0, 1))]

    def main(self, blocks: list) -> list[bool]:
        """Label of every block of a page."""
        return self.labels([blocks])[0]

    def labels(self, pages: list[list]) -> list[list[bool]]:
        """Label of every block of each page, from the whole page. Pages with equally many blocks go through together, BLOCKS blocks at a time at most
        unless one page has more."""
        out: list[list[bool]] = [[] for _ in pages]
        by_size: dict[int, list[int]] = {}
        for at, blocks in enumerate(pages):
            by_size.setdefault(len(blocks), []).append(at)
        for size, ats in by_size.items():
            step = max(1, BLOCKS // max(1, size))
            for lo in range(0, len(ats) if size else 0, step):
                group = ats[lo : lo + step]
                x = np.stack([np.stack([vector(b, i == 0) for i, b in enumerate(pages[at])]) for at in group], 1)
                for at, labels in zip(group, (self.logits(x) > 0).T.tolist()):
                    out[at] = labels
        return out


def made_page(draw: random.Random) -> tuple[str, list[bool]]:
    """An invented page and the labels of its blocks."""
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéñó"
    word = lambda: "".join(draw.choice(letters) for _ in range(draw.randint(2, 11)))
    line = lambda lo, hi: (" ".join(word() for _ in range(draw.randint(lo, hi)))).capitalize() + draw.choice([".", ".", ".", "", "!", "?"])
    prose = lambda lo, hi: draw.choice([" ", " ", "\n", " | "]).join(line(3, 14) for _ in range(draw.randint(lo, hi)))
    labels: list[bool] = []

    def block(tag: str, text: str, good: bool, marks: str = "") -> str:
        labels.append(good)
        inner = text if draw.random() < 0.8 else f"<{(k := draw.choice(['b', 'em', 'span', 'i']))}>{text}</{k}>"
        return f"<{tag}{marks}>{inner}" + ("" if tag in ("p", "li") and draw.random() < 0.2 else f"</{tag}>")

    def marked(names: str) -> str:
        return f' {draw.choice(["class", "id"])}="{draw.choice(names.split())}"'

    def menu():
        holder = draw.choice(["nav", "nav", "div", "ul"])
        items = [block("li", f'<a href="/{word()}">{line(1, 2)}</a>', False) for _ in range(draw.randint(2, 9))]
        inner = "".join(items) if holder == "ul" else f"<ul>{''.join(items)}</ul>"
        return f"<{holder}{marked('menu nav navbar navigation breadcrumb toc') if holder != 'nav' or draw.random() < 0.3 else ''}>{inner}</{holder}>"

    def boxed(names: str, holders: list[str], lo: int = 1, hi: int = 3):
        holder = draw.choice(holders)
        marks = marked(names) if holder in ("div", "section", "p") or draw.random() < 0.4 else ""
        if draw.random() < 0.5 and holder != "p":
            n = draw.randint(1, 3)
            if draw.random() < 0.3:
                return f"<{holder}{marks}>" + block(draw.choice(["h2", "h3", "h4"]), line(1, 4), False) + "".join(block("p", prose(lo, hi), False) for _ in range(n)) + f"</{holder}>"
            return f"<{holder}{marks}>" + "".join(block(draw.choice(["p", "div", "li"]), prose(lo, hi), False) for _ in range(n)) + f"</{holder}>"
        labels.append(False)
        return f"<{holder}{marks}>{prose(lo, hi)}</{holder}>"

    extras = {
        "menu": menu,
        "advert": lambda: boxed("ad ads advert advertisement banner sponsored promo", ["div", "aside", "section"]),
        "notice": lambda: boxed("cookie consent notice banner newsletter popup alert gdpr subscribe", ["div", "section", "p"]),
        "side": lambda: boxed("sidebar related widget side share social recommended", ["aside", "aside", "div"]),
        "form": lambda: f"<form{marked('search login signup form')}>" + block(draw.choice(["p", "div", "p"]), line(1, 4), False) + draw.choice(["<input name=q>", "<input type=text><br>", ""]) + "</form>",
        "comment": lambda: boxed("comments comment replies discussion respond", ["section", "div"], 1, 4),
        "header": lambda: boxed("header masthead site-header top logo", ["header", "header", "div"], 1, 2),
    }

    def article():
        holder = draw.choice(["article", "article", "article", "main", "div", "section"])
        marks = marked("article content post entry main story body text") if holder in ("div", "section") or draw.random() < 0.3 else ""
        out = [block("h1", line(2, 12), True)] if draw.random() < 0.9 else []
        for _ in range(draw.choice([1, 2, 3, 5, 8, 14])):
            kind = draw.random()
            if kind < 0.75:
                out.append(block("p", prose(1, 6) + draw.choice(["", "", "<br>"]), True))
            elif kind < 0.82:
                out.append(block(draw.choice(["h2", "h3"]), line(1, 6), True))
            elif kind < 0.9:
                out.append("<ul>" + "".join(block("li", line(1, 12), True) for _ in range(draw.randint(1, 4))) + "</ul>")
            elif kind < 0.95:
                out.append(f"<blockquote>{block('p', prose(1, 3), True)}</blockquote>")
            elif kind < 0.97:
                out.append(block("pre", prose(1, 3), True))
            else:
                out.append(extras[draw.choice(["advert", "side", "form", "notice"])]())
        return f"<{holder}{marks}>{''.join(out)}</{holder}>"

    before = [extras[k]() for k in ("header", "menu", "notice", "advert", "side") if draw.random() < (0.75 if k == "menu" else 0.4)]
    body = article()
    after = [extras[k]() for k in ("side", "comment", "form", "advert", "menu") if draw.random() < 0.3]
    if draw.random() < 0.9:
        labels.append(False)
        after.append(f"<{(k := draw.choice(['footer', 'footer', 'div class=footer']))}>{draw.choice(['&copy; ', '', f'© {draw.randint(1990, 2030)} ', '&#169; '])}{draw.choice([word(), word() + '.example', word() + '.example.com'])}{draw.choice([' &middot; ', ' | ', ' - ', ' '])}{line(2, 16)}</{k.split()[0]}>")
    script = draw.choice([f"var {word()} = 1 < 2;", f"if ({word()} && !0) document.write('<div>');", f"/* {word()} */", f"x = '</p>{word()}';", ""])
    style = draw.choice([f".{word()} {{ margin: {draw.randint(0, 9)}px }}", "p{}", f"@media print {{ #{word()} {{ display: none }} }}"])
    parts = [f"<title>{line(2, 6)}</title>", f"<style>{style}</style>", f"<script>{script}</script>", f'<meta name="{word()}" content="{word()}">']
    head = f"<head>{''.join(draw.sample(parts, draw.randint(1, 4)))}</head>"
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{body}{''.join(after)}{draw.choice(['</body></html>', ''])}", labels


@functools.lru_cache(1)
def trained(pages: int = 1200, rounds: int = 6, seed: int = 3) -> Labeller:
    """Adam on batches of invented pages; the same weights in every run."""
    draw, model = random.Random(seed), Labeller.fresh(seed)
    data = []
    while len(data) < pages:
        html, labels = made_page(draw)
        blocks = leaves(html)
        if len(blocks) == len(labels):
            data.append((np.stack([vector(b, i == 0) for i, b in enumerate(blocks)]), np.array(labels, np.float32)))
    data.sort(key=lambda d: len(d[1]))
    batches = [data[a : a + 24] for a in range(0, len(data), 24)]
    first, second, step = [np.zeros_like(w) for w in model.weights], [np.zeros_like(w) for w in model.weights], 0
    for turn in range(rounds):
        draw.shuffle(batches)
        for batch in batches:
            steps = max(len(y) for _, y in batch)
            x, y, mask = np.zeros((steps, len(batch), WIDTH), np.float32), np.zeros((steps, len(batch)), np.float32), np.zeros((steps, len(batch)), np.float32)
            for k, (a, b) in enumerate(batch):
                x[: len(b), k], y[: len(b), k], mask[: len(b), k] = a, b, 1
            step += 1
            rate = 0.01 * (1 - turn / rounds) + 0.0005
            for w, g, m, v in zip(model.weights, model.gradient(x, y, mask), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return model


def main_texts(html: list[str | None], model: Labeller) -> list[str]:
    pages = list(map(leaves, html))
    return ["\n".join(b[0] for b, good in zip(blocks, labels) if good) for blocks, labels in zip(pages, model.labels(pages))]


def main_text(html: str | None, model: Labeller) -> str:
    return main_texts([html], model)[0]


def extracted(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every row, repeated rows too; null html counts as empty, and pages without main text have an empty one. Other columns play no part. Broken, deeply nested and very
    long pages take time and memory in proportion to their length."""
    weights = (model or trained()).weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(weights)
        for whole, at in ((b, at) for b in batches for at in range(0, b.num_rows, PAGES)):
            batch = whole.slice(at, PAGES)
            texts = main_texts(batch.column(2).to_pylist(), labeller)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: page_id, url, text, n_chars."""
    return extracted(table(spark, sf_dir, "pages"))
