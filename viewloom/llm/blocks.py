"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks: runs of text between block-level tags, each with the tags, classes and ids above
it.  A bidirectional LSTM in numpy reads one vector per block (path, hashed words, a few measures) and classifies
every block with the whole page as its context.  HTML's elements and the telling names have an input each; all other names share one, so no name looks like another.  It is trained on a bounded, seeded sample of the pages themselves: blocks whose
place in the page is telling (inside an article; in a menu, a footer, an advert) label themselves, and copies of the sampled pages with their
containers renamed or boilerplate inserted show it the other ways in which pages say the same, names among them that it doesn't know.  Scripts, styles and comments of the markup never become blocks.

Defined results: null and empty html, and pages without a block of main text, give the empty string; repeated rows are extracted each
on their own; a stray quote in a tag is an ordinary character, a head without its end ends where the body begins; markup that breaks off ends where it breaks off; without any page to learn from every block counts as main text.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm.text import narrow, sample, slices

WORDS, MEASURES = 32, 6
#: Shares of the training copies in which no container has a telling name, and in which one of main text, or one of other things, has an unknown name.
HIDDEN, UNKNOWN_MAIN, UNKNOWN_OTHER = 0.25, 0.35, 0.25
UNKNOWN = "#?"
#: A quote counts after '=' alone; where the quoted values leave no '>', a tag ends at its first one.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:=\s*+(?:"[^"]*"|'[^']*')|[^>])*+|[^>]*+)>|[^<]+|<""", re.S)
ATTRIBUTE = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# Names of HTML elements.
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE |= {"button", "math", "object"}
SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "canvas", "head", "title", "select", "textarea"}
#: Of these, those that may stand inside a line of text, which goes on after them.
WITHIN = {"script", "style", "noscript", "template", "svg", "iframe", "canvas", "select", "textarea"}
HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
MAIN = ("article", "main", "#content", "#post", "#entry", "#story", "#article", "#body")
OTHER = (
    "nav", "header", "footer", "aside", "form", "menu", "dialog", "#ad", "#ads", "#advert", "#banner", "#sponsored", "#promo", "#menu", "#nav", "#navbar", "#breadcrumb",
    "#sidebar", "#widget", "#footer", "#header", "#cookie", "#notice", "#consent", "#newsletter", "#subscribe", "#popup", "#modal", "#share", "#social", "#related",
    "#recommended", "#comments", "#comment", "#reply", "#disqus", "#copyright", "#legal", "#toolbar", "#search", "#login", "#pagination", "#alert", "#tags",
)
# Names of HTML elements that hold blocks.
ELEMENTS = (
    "html", "body", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "section",
    "hgroup", "address", "fieldset", "legend", "details", "summary", "center", "option",
)
KNOWN = {name: k for k, name in enumerate((*ELEMENTS, *MAIN, *OTHER))}
PATH = len(KNOWN) + 2  # unknown names; unknown elements
WIDTH = PATH + WORDS + MEASURES


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags, and '#' with each class, id or role, outermost first
    linked: float  # share of characters inside links and buttons


def blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order, with character references decoded and white space made one space."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[tuple[str, bool]] = []
    skipping = links = 0

    def flush() -> None:
        nonlocal held
        if held:
            text = " ".join(entities.unescape("".join(t for t, _ in held)).split())
            if text:
                total = sum(len(t) for t, _ in held)
                path = tuple(x for tag, names in stack if tag not in INLINE and tag not in WITHIN for x in (tag, *names))
                out.append(Block(text, path, sum(len(t) for t, a in held if a) / total))
            held = []

    def close(to: int) -> None:
        nonlocal skipping, links
        for tag, _ in stack[to:]:
            skipping -= tag in SKIPPED
            links -= tag in ("a", "button")
        del stack[to:]

    at = 0
    while at < len(page):
        found = TOKEN.match(page, at)
        at = found.end()
        slash, tag, attributes = found.groups()
        if tag is None:
            piece = found.group()
            if piece[0] == "<" and len(piece) > 1:
                continue
            if piece == "<" and (page[at : at + 1].isalpha() or page[at : at + 1] in "/!?"):
                end = page.find(">", at)
                if end < 0:
                    break  # a tag that breaks off
                at = end + 1
                continue
            if skipping and stack[-1][0] == "head" and piece.strip():
                close(len(stack) - 1)
            if not skipping:
                held.append((piece, links > 0))
            continue
        tag = tag.lower()
        if not slash and tag not in HEAD:  # what belongs into the body ends a head that is still open
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "head":
                    close(k)
                    break
        if tag in VOID:
            if tag == "br":
                held.append((" ", links > 0))
            elif tag == "hr":
                flush()
            continue
        formula = any(x == "math" for x, _ in stack)  # its elements are parts of a line
        if slash:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in INLINE and tag not in WITHIN and not formula and not skipping:
                        flush()
                    close(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag not in INLINE and tag not in WITHIN and not formula and not skipping:
            flush()
            if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                ends = ("p",) if tag in CLOSES_P else ("p", "li") if tag == "li" else ("p", "dt", "dd") if tag in ("dt", "dd") else ("p", "td", "th") if tag in ("td", "th") else ("p", tag)
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        close(k)
                    elif stack[k][0] not in INLINE:
                        break
        if attributes.endswith("/") and tag not in INLINE and tag not in CLOSES_P:
            continue
        names = () if tag in INLINE or formula else tuple("#" + w for x in ATTRIBUTE.findall(attributes) for w in re.split(r"[\s_-]+", "".join(x).lower()) if w)
        stack.append((tag, names))
        skipping += tag in SKIPPED
        links += tag in ("a", "button")
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(len(stack) - 1)
    flush()
    return out


def teacher(block: Block) -> int:
    """1 or 0 where the block's place says that it is main text or not; -1 where it doesn't."""
    # the innermost telling name decides between a container of main text and one of other things inside it
    for name in reversed(block.path):
        if name in OTHER:
            return 0
        if name in MAIN:
            return 1
    return -1


def vector(block: Block, order: float) -> np.ndarray:
    out = np.zeros(WIDTH, np.float32)
    for k, name in enumerate(reversed(block.path)):
        at = KNOWN.get(name, PATH - 2 if name[0] == "#" else PATH - 1)
        out[at] = max(out[at], 1.0 if k < 12 else 0.5)
    words = block.text.split(" ")
    # all words count, by their share; short blocks weigh less
    hashed = np.bincount([zlib.crc32(w) % WORDS for w in block.text.lower().encode().split(b" ")], minlength=WORDS)
    out[PATH : PATH + WORDS] = hashed * (2.0 / max(8, len(words)))
    ends = sum(w[-1] in ".!?:;," for w in words)
    out[PATH + WORDS :] = (np.log1p(len(words)) / 5, block.linked, ends / len(words), order, block.text[-1] in ".!?\"'", len(block.text) / len(words) / 20)
    return out


def vectors(page: list[Block]) -> np.ndarray:
    return np.array([vector(b, i / len(page)) for i, b in enumerate(page)], np.float32).reshape(-1, WIDTH)


def varied(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A copy of a page with containers renamed and boilerplate put in, and the labels of its blocks.

    In a share ``HIDDEN`` of the copies no container has a telling name, so words, links, measures and neighbours have to decide.
    """
    hidden, unknown_main = rng.random() < HIDDEN, rng.random() < UNKNOWN_MAIN
    unknown_other = [rng.random() < UNKNOWN_OTHER for _ in range(2)]
    label = [teacher(b) for b in page]
    main = [i for i, y in enumerate(label) if y == 1]
    out, labels = [], []
    new_main = [rng.choice(MAIN)] if rng.random() < 0.8 else [rng.choice(MAIN), rng.choice(MAIN)]
    outside = [str(rng.choice(OTHER)) for _ in range(4)]

    def tags(names: list[str], unknown: bool = False) -> tuple[str, ...]:
        if hidden or unknown:
            return tuple(x for _ in names for x in (("div", UNKNOWN) if rng.random() < 0.5 else ("section",) if rng.random() < 0.2 else ("div",)))
        return tuple(x for n in names for x in (("div", str(n)) if n[0] == "#" else (str(n),)))

    over_main, over_other = tags(new_main, unknown_main), [tags([outside[k]], unknown_other[k]) for k in range(2)]
    for i, (b, y) in enumerate(zip(page, label, strict=True)):
        rest = [x for x in b.path if x not in MAIN and x not in OTHER]
        if y == 1:
            inner = rest[2:] if rng.random() < 0.7 else [str(x) for x in rng.choice(["div", "ul", "ol", "li", "h2", "h3", "blockquote", "td", "table", "section", "p", "pre"], 2)]
            out.append(Block(b.text, (*rest[:2], *over_main, *inner), b.linked))
        elif y == 0:
            out.append(Block(b.text, (*rest[:2], *over_other[i % 2], *rest[2:]), b.linked))
        else:
            out.append(b)
        labels.append(y)
    for name in [] if hidden else outside[2:]:
        # texts that read like main text, in a place that is not: beside it or inside its container
        many = int(rng.integers(1, 6))
        at = int(rng.integers(0, len(out) + 1))
        over = over_main if rng.random() < 0.5 else ()
        texts = [page[int(rng.choice(main))].text if main and rng.random() < 0.7 else page[int(rng.integers(len(page)))].text for _ in range(many)] if page else []
        kind = "li" if rng.random() < 0.3 else "p" if rng.random() < 0.7 else "div"
        out[at:at] = [Block(t, ("html", "body", *over, *tags([name]), kind), float(rng.random() < 0.2)) for t in texts]
        labels[at:at] = [0] * len(texts)
    return out, labels


@dataclass
class Labeller:
    """Bidirectional LSTM; gates in the order input, forget, output, candidate."""

    hidden: int
    w: list[np.ndarray] = field(default_factory=list)  # per direction: (WIDTH + hidden + 1) x 4 hidden
    out: np.ndarray | None = None  # 2 hidden + 1

    @classmethod
    def new(cls, hidden: int, rng: np.random.Generator) -> Labeller:
        w = [rng.standard_normal((WIDTH + hidden + 1, 4 * hidden)).astype(np.float32) * 0.15 for _ in range(2)]
        for x in w:
            x[-1, hidden : 2 * hidden] = 1.0
        return cls(hidden, w, rng.standard_normal(2 * hidden + 1).astype(np.float32) * 0.3)

    def direction(self, d: int, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (T x n x hidden) of one direction over padded pages x (T x n x WIDTH)."""
        steps, n, _ = x.shape
        h = c = np.zeros((n, self.hidden), np.float32)
        seen = x @ self.w[d][:WIDTH] + self.w[d][-1]
        inner, states, k = self.w[d][WIDTH:-1], np.zeros((steps, n, self.hidden), np.float32), self.hidden
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            z = seen[t] + h @ inner
            gate = 1 / (1 + np.exp(-np.clip(z[:, : 3 * k], -30, 30)))
            g = np.tanh(z[:, 3 * k :])
            new_c = gate[:, k : 2 * k] * c + gate[:, :k] * g
            tc = np.tanh(new_c)
            new_h = gate[:, 2 * k :] * tc
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, gate, g, tc, m))
            h, c = np.where(m, new_h, h), np.where(m, new_c, c)
            states[t] = h
        return states

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        kept = [[], []] if keep is not None else [None, None]
        both = np.concatenate([self.direction(d, x, mask, kept[d]) for d in (0, 1)], 2)
        if keep is not None:
            keep.extend(kept)
        return both @ self.out[:-1] + self.out[-1], both

    def gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients by back-propagation through time; y is -1 where it does not count."""
        keep: list = []
        z, both = self.logits(x, mask, keep)
        counts = mask & (y >= 0)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        number = max(1, counts.sum())
        loss = -(np.where(y > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7)) * counts).sum() / number
        dz = ((p - (y > 0)) * counts / number).astype(np.float32)
        d_out = np.append(np.einsum("tnh,tn->h", both, dz), dz.sum()).astype(np.float32)
        d_both, k, grads = dz[..., None] * self.out[:-1], self.hidden, []
        for d in (0, 1):
            d_states = d_both[..., d * k : (d + 1) * k]
            dh = dc = np.zeros_like(d_states[0])
            d_gates = np.zeros((*mask.shape, 4 * k), np.float32)
            d_inner = np.zeros((k, 4 * k), np.float32)
            inner = self.w[d][WIDTH:-1]
            for t, h, c, gate, g, tc, m in reversed(keep[d]):
                dh = dh + d_states[t]
                a, f, o = gate[:, :k], gate[:, k : 2 * k], gate[:, 2 * k :]
                through = dc + dh * o * (1 - tc**2)
                dg = np.concatenate([through * g * a * (1 - a), through * c * f * (1 - f), dh * tc * o * (1 - o), through * a * (1 - g**2)], 1) * m
                d_gates[t] = dg
                d_inner += h.T @ dg
                dh, dc = np.where(m, dg @ inner.T, dh), np.where(m, through * f, dc)
            flat = d_gates.reshape(-1, 4 * k)
            grads.append(np.vstack([x.reshape(-1, WIDTH).T @ flat, d_inner, flat.sum(0)[None]]))
        return float(loss), [*grads, d_out]

    def probabilities(self, pages: list[np.ndarray], most: int = 1 << 13) -> list[np.ndarray]:
        """For each page, each block's probability of being main text; pages of like length are padded together."""
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        while order:
            group = [order.pop()]
            longest = len(pages[group[0]])
            while order and (len(group) + 1) * longest <= most:
                group.append(order.pop())
            x, mask = padded([pages[i] for i in group])
            z, _ = self.logits(x, mask)
            for k, i in enumerate(group):
                out[i] = 1 / (1 + np.exp(-np.clip(z[: len(pages[i]), k], -30, 30)))
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x, mask = np.zeros((steps, len(pages), WIDTH), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


def fit(pages: list[list[Block]], hidden: int = 16, copies: int = 3, rounds: int = 6, least_steps: int = 300, batch: int = 32, most_blocks: int = 128, seed: int = 0) -> Labeller:
    """Train on the pages' own telling blocks and on ``copies`` varied copies of each, in windows of ``most_blocks``; ``rounds`` over all, or more for few pages."""
    rng = np.random.default_rng(seed)
    examples = []
    for page in pages:
        for k in range(copies + 1):
            own, labels = (page, [teacher(b) for b in page]) if k == 0 else varied(page, rng)
            x = vectors(own)
            for i in range(0, len(own), most_blocks):
                if any(y >= 0 for y in labels[i : i + most_blocks]):
                    examples.append((x[i : i + most_blocks], np.array(labels[i : i + most_blocks])))
    model = Labeller.new(hidden, rng)
    weights = [*model.w, model.out]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step, examples = 0, sorted(examples, key=lambda e: len(e[0]))
    groups = [examples[i : i + batch] for i in range(0, len(examples), batch)]
    total = max(rounds, -(-least_steps // len(groups))) * len(groups) if groups else 0
    while step < total:
        for g in rng.permutation(len(groups)):
            x, mask = padded([e[0] for e in groups[g]])
            y = np.full(mask.shape, -1)
            for k, (_, own) in enumerate(groups[g]):
                y[: len(own), k] = own
            step += 1
            for w, grad, (m, v) in zip(weights, model.gradients(x, y, mask)[1], moments, strict=True):
                m += 0.1 * (grad - m)
                v += 0.01 * (grad**2 - v)
                w -= 0.02 * 0.06 ** (step / total) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return model


def train(pages: DataFrame, most: int = 400, most_chars: int = 200_000, seed: int = 0) -> Labeller | None:
    """Fit on a sample of at most ``most`` pages of ``most_chars`` characters at most, first in a seeded hash order."""
    rows = pages.select(F.col("page_id").alias("doc_id"), "html").where(F.length("html") <= most_chars)
    # an id that stands in many rows gives its smallest page alone
    some = sample(rows.where("html is not null"), most, seed).groupBy("doc_id").agg(F.min("html").alias("html"))
    found = sorted((r["doc_id"], r["html"]) for r in some.collect())
    own = [b for b in (blocks(page) for _, page in found) if b]
    return fit(own, seed=seed) if own else None


def extract(pages: DataFrame, model: Labeller | None, columns: list[str | Column], html: str = "html") -> DataFrame:
    """The named columns and ``text``, the main text of every whole page."""
    narrow(pages.sparkSession)
    chosen = pages.select(*columns, F.col(html).alias("_html"))
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField("text", T.StringType())])
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html", 1 << 21):
            own = [blocks(page or "") for page in batch.column(batch.num_columns - 1).to_pylist()]
            labeller = held.value
            main = labeller.probabilities([vectors(b) for b in own]) if labeller else [np.ones(len(b)) for b in own]
            texts = ["\n".join(b.text for b, p in zip(page, ps, strict=True) if p >= 0.5) for page, ps in zip(own, main, strict=True)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return chosen.mapInArrow(run, schema)
