"""Main text of web pages: a bidirectional LSTM labels the blocks of a page.

A page becomes the sequence of its leaf blocks.  A block's vector holds its tag path (tags, classes and ids from the
body down), its words (both hashed) and a few sizes.  The network reads the sequence in both directions, so a block is
judged by all that stands before and after it, and says for each block whether it belongs to the article.

No page carries labels, so the network is trained on pages put together anew: the article blocks of a bounded sample of
pages, as their own markup names them, stand between, around and among menus, notices, adverts, forms and comments
whose containers are named the ways the web names them.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import slices

#: Pages that may be learned from: a documented bound.
MAX_TRAINING_PAGES = 400
#: Longer pages teach nothing, and of one page no more blocks teach.
MAX_TRAINING_BYTES = 256 << 10
TRAINING_BLOCKS = 200
VARIANTS = 4
EPOCHS = 5
HIDDEN = 20
PATH_DIM, WORD_DIM, SIZE_DIM = 96, 24, 6
DIM = PATH_DIM + WORD_DIM + SIZE_DIM
SEED = 31

# Markup whose content is never text, tags without content, tags that bound blocks.
HIDDEN_TAGS = frozenset("script style template noscript head svg iframe object canvas math audio video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5
h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead
tr ul button""".split())
#: An open tag of the first kind is closed by the start of one of the second.
CLOSED_BY = {"p": BLOCK_TAGS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
             "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}

_MARKUP = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)(%s)>|([^<]++|<(?![a-zA-Z/])|</(?![a-zA-Z]))"
#: A quote counts behind a "=" only; nothing is tried twice, so a tag takes time in proportion to its length.
_TOKEN = re.compile(_MARKUP % r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+", re.DOTALL)
#: For what follows a tag whose quotes run over the page's end: the first ">" ends a tag.
_LOOSE = re.compile(_MARKUP % r"[^>]*+", re.DOTALL)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Path:
    """The names of the block elements around a block, shared by all blocks of an element: their hashed vector, how
    many they are, the last two, and whether they name an article or what is none."""

    __slots__ = ("features", "size", "last", "article", "barred")

    def __init__(self, parent: Path | None, names: Sequence[str], fresh: Iterable[str]):
        """``fresh``: those of ``names`` that no element further out has."""
        self.features = np.zeros(PATH_DIM, np.float32) if parent is None else parent.features
        fresh = set(fresh)
        if fresh:
            self.features = self.features.copy()
            for name in fresh:
                self.features[_bucket(name, PATH_DIM)] += 1
        self.size = len(names) + (parent.size if parent else 0)
        self.last = (*(parent.last if parent else ()), *names)[-2:]
        self.article = bool(parent and parent.article) or any(n in ("article", "main") for n in fresh)
        self.barred = bool(parent and parent.barred) or any(NOT_ARTICLE.match(n) for n in fresh)

    @classmethod
    def of(cls, names: Sequence[str]) -> Path:
        return cls(None, names, names)


@dataclass
class Block:
    """A leaf block: its path, its text, and the part of the text inside links."""

    path: Path
    text: str
    linked: float


@lru_cache(4096)
def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element is called: its tag, and the parts of its class, id and role."""
    out = [tag]
    for m in _NAMES.finditer(attributes):
        out += [f".{p.lower()}" for p in _PARTS.findall(m[2] or m[3] or m[4] or "")]
    return tuple(out)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; references decoded, white space joined, blocks without text left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], Path]] = []  # of the open elements: tag, names, path with them
    outside = Path(None, (), ())
    open_names: Counter = Counter()  # names of the open block elements
    open_tags: Counter = Counter()
    open_blocks: list[int] = []  # their places in the stack
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(stack[-1][2] if stack else outside, text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def close(k: int) -> None:
        """Close the open elements from number ``k`` on."""
        nonlocal links
        for tag, names, _ in stack[k:]:
            links -= tag == "a"
            open_tags[tag] -= 1
            if tag in BLOCK_TAGS:
                open_names.subtract(names)
        del stack[k:]
        while open_blocks and open_blocks[-1] >= k:
            open_blocks.pop()

    position, hidden, token = 0, "", _TOKEN
    while position < len(page):
        if hidden:  # raw content up to its end tag
            end = re.compile(rf"</{hidden}\s*>", re.IGNORECASE).search(page, position)
            position, hidden = (end.end() if end else len(page)), ""
            continue
        m = token.match(page, position)
        if m is None and token is _TOKEN:
            token = _LOOSE
            continue
        if m is None:  # an unfinished tag at the end
            break
        position = m.end()
        if m[4]:
            text = html.unescape(m[4])
            parts.append(text)
            linked += len(text) if links else 0
        elif m[2]:
            tag = m[2].lower()
            if m[1]:
                if open_tags[tag]:
                    if tag in BLOCK_TAGS:
                        flush()
                    close(next(k for k in reversed(range(len(stack))) if stack[k][0] == tag))
                elif tag in BLOCK_TAGS:
                    flush()
            elif tag in HIDDEN_TAGS and tag != "head":
                hidden = tag if not m[0].endswith("/>") else ""
            elif tag == "head":
                end = re.compile(r"</head\s*>|<body\b", re.IGNORECASE).search(page, position)
                position = end.start() if end else position
            else:
                if tag in BLOCK_TAGS:
                    flush()
                    while open_blocks and tag in CLOSED_BY.get(stack[open_blocks[-1]][0], ()):
                        close(open_blocks[-1])
                elif tag == "br":
                    parts.append(" ")
                if tag not in VOID_TAGS:
                    names, path = _names(tag, m[3] or ""), stack[-1][2] if stack else outside
                    if tag in BLOCK_TAGS:
                        path = Path(path, names, [n for n in names if not open_names[n]])
                        open_names.update(names)
                        open_blocks.append(len(stack))
                    stack.append((tag, names, path))
                    open_tags[tag] += 1
                    links += tag == "a"
    flush()
    return out


# --- vectors -----------------------------------------------------------------------------------------------------
@lru_cache(1 << 16)
def _bucket(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


def vectors(page: list[Block]) -> np.ndarray:
    """One row for each block: hashed path names, hashed words, sizes."""
    out = np.zeros((len(page), DIM), np.float32)
    for i, b in enumerate(page):
        row = out[i]
        row[:PATH_DIM] = b.path.features
        for name in b.path.last:
            row[_bucket(name, PATH_DIM)] += 0.5
        words = b.text.split()
        counts = np.bincount([_bucket(w.lower(), WORD_DIM) for w in words], minlength=WORD_DIM)
        row[PATH_DIM:PATH_DIM + WORD_DIM] = counts / np.sqrt(len(words)) / 4
        row[-SIZE_DIM:] = (np.log1p(len(words)) / 4, b.linked, b.text[-1] in ".!?…\"»", i / len(page), b.path.size / 10, sum(map(len, words)) / len(words) / 10)
    return out


# --- the network -------------------------------------------------------------------------------------------------
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, w: dict, name: str, live: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) of a batch (T, B, D); behind a sequence's end its state stays as it was."""
    steps, batch, _ = x.shape
    h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    out, kept = np.zeros((steps, batch, HIDDEN)), []
    for t in range(steps):
        z = x[t] @ w[name + "x"] + h @ w[name + "h"] + w[name + "b"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        new = f * c + i * g
        m = live[t][:, None]
        tanh = np.tanh(new)
        kept.append((h, c, i, f, o, g, tanh))
        h, c = m * (o * tanh) + (1 - m) * h, m * new + (1 - m) * c
        out[t] = h
    return out, kept


def _lstm_back(x: np.ndarray, w: dict, name: str, live: np.ndarray, kept: list, dout: np.ndarray, grad: dict) -> None:
    steps, batch, _ = x.shape
    dh, dc = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
    for t in reversed(range(steps)):
        h, c, i, f, o, g, tanh = kept[t]
        m = live[t][:, None]
        dh = dh + dout[t]
        into = m * dh
        dnew = m * dc + into * o * (1 - tanh ** 2)
        dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), into * tanh * o * (1 - o), dnew * i * (1 - g ** 2)], 1)
        grad[name + "x"] += x[t].T @ dz
        grad[name + "h"] += h.T @ dz
        grad[name + "b"] += dz.sum(0)
        dh = (1 - m) * dh + dz @ w[name + "h"].T
        dc = (1 - m) * dc + dnew * f


def _flip(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each sequence backwards, its padding still behind it."""
    t = np.arange(len(x))[:, None]
    return x[np.where(t < sizes, sizes - 1 - t, t), np.arange(x.shape[1])]


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for p in pages])
    x = np.zeros((sizes.max(), len(pages), DIM))
    for k, p in enumerate(pages):
        x[:len(p), k] = p
    return x, sizes, (np.arange(len(x))[:, None] < sizes).astype(float)


def probabilities(w: dict, pages: list[np.ndarray]) -> list[np.ndarray]:
    """For each page (a row for each block) the blocks' probabilities of belonging to the article."""
    x, sizes, live = _padded(pages)
    ahead, _ = _lstm(x, w, "f", live)
    back, _ = _lstm(_flip(x, sizes), w, "r", live)
    p = _sigmoid(ahead @ w["of"] + _flip(back, sizes) @ w["or"] + x @ w["ox"] + w["ob"])
    return [p[:n, k] for k, n in enumerate(sizes)]


def train(examples: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = SEED) -> dict:
    """Adam on the cross-entropy of the blocks; the same examples give the same network."""
    rng = np.random.default_rng(seed)
    w = {f"{d}{k}": rng.normal(size=s) * 0.1 for d in "fr" for k, s in (("x", (DIM, 4 * HIDDEN)), ("h", (HIDDEN, 4 * HIDDEN)))}
    w |= {f"{d}b": np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN) for d in "fr"}
    w |= {"of": rng.normal(size=HIDDEN) * 0.1, "or": rng.normal(size=HIDDEN) * 0.1, "ox": np.zeros(DIM), "ob": np.zeros(1)}
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    order = sorted(range(len(examples)), key=lambda k: len(examples[k][0]))
    groups = [order[i:i + 32] for i in range(0, len(order), 32)]
    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            picked = [examples[k] for k in groups[g]]
            x, sizes, live = _padded([p for p, _ in picked])
            y = np.zeros(live.shape)
            for k, (_, label) in enumerate(picked):
                y[:len(label), k] = label
            ahead, kept_f = _lstm(x, w, "f", live)
            flipped = _flip(x, sizes)
            back, kept_r = _lstm(flipped, w, "r", live)
            back = _flip(back, sizes)
            d = (_sigmoid(ahead @ w["of"] + back @ w["or"] + x @ w["ox"] + w["ob"]) - y) * live / live.sum()
            grad = {k: np.zeros_like(v) for k, v in w.items()}
            grad["of"], grad["or"], grad["ox"], grad["ob"] = np.tensordot(ahead, d, ([0, 1], [0, 1])), np.tensordot(back, d, ([0, 1], [0, 1])), np.tensordot(x, d, ([0, 1], [0, 1])), np.array([d.sum()])
            _lstm_back(x, w, "f", live, kept_f, d[:, :, None] * w["of"], grad)
            _lstm_back(flipped, w, "r", live, kept_r, _flip(d, sizes)[:, :, None] * w["or"], grad)
            step += 1
            for k in w:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.99 * second[k] + 0.01 * grad[k] ** 2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return w


# --- training pages ----------------------------------------------------------------------------------------------
# What containers of articles and of everything else are called.
ARTICLES = ("article", "main article", "main", "div.article", "div.post", "div.post-content", "div.entry-content", "div.content article", "div#content",
            "div.article-body", "section.article", "div.story", "div#main div.text", "main div.content", "div.page section.content", "td.content", "div.main-content")
AROUND = {
    "menu": ("nav ul li", "div.menu ul li", "ul.nav li", "header nav ul li", "div#navigation ul li", "div.breadcrumb", "nav.breadcrumbs ol li", "div.navbar ul li", "ul.menu li", "div.topnav", "nav", "div.pagination", "menu li"),
    "header": ("header", "div.header", "div#header div.logo", "div.masthead", "header div.site-title", "div.banner", "header p", "header h1", "header.site h1", "div.header h1", "div#logo h1", "header div.brand h2"),
    "footer": ("footer", "div.footer", "div#footer p", "footer ul li", "footer div.copyright", "div.site-info", "footer p"),
    "side": ("aside", "div.sidebar", "div#sidebar ul li", "aside.related ul li", "div.widget", "div.related", "section.recommended ul li", "aside p", "aside h3", "div.side p", "div.sidebar h3", "div.trending li", "aside section h3"),
    "notice": ("div.cookie", "div.cookie-notice p", "div#cookie-banner", "div.consent", "div.alert", "div.notice", "div.gdpr p", "div.popup", "div.modal p", "dialog p", "div.warning", "section.notice p"),
    "advert": ("div.ad", "div.ads", "div.advert", "aside.ad", "div.advertisement p", "div.sponsored", "div.promo", "div#ad-top", "section.sponsor p", "div.banner-ad", "ins.adsbygoogle div"),
    "form": ("form", "form div", "form label", "div.newsletter form", "div.subscribe form p", "form fieldset legend", "form select option", "form button", "div.search form", "div.signup p", "div.login form label"),
    "comments": ("div.comments", "section.comments div.comment p", "div#comments ol li p", "ul.commentlist li div p", "div.comment-body p", "section#comments p", "div.disqus p", "div.replies div.reply p", "div.reader-comments p", "ol.comments li", "section.comments h3", "div#comments h2"),
    "share": ("div.share", "div.social ul li", "ul.share-buttons li", "div.tags a", "div.author-bio p", "p.byline"),
}
INSIDE = ("p", "p", "p", "p", "h1", "h2", "h3", "li", "blockquote p", "ul li", "div p", "pre", "td", "section p", "figure figcaption")
NOT_ARTICLE = re.compile(r"^(nav|aside|footer|header|form|menu|dialog|button|select|\.(ad|ads|advert|advertisement|sponsor|sponsored|promo|cookie|consent|comment|comments|sidebar|related|newsletter|subscribe|share|social|menu|nav|footer|breadcrumb|banner|notice))$")


def _path(selector: str) -> tuple[str, ...]:
    out = []
    for element in selector.split():
        tag, *names = re.split(r"[.#]", element)
        out += [tag, *(f".{p.lower()}" for n in names for p in _PARTS.findall(n))]
    return tuple(out)


def weak_labels(page: list[Block]) -> list[bool] | None:
    """What the page's own markup calls article; None if it names none."""
    return [b.path.article and not b.path.barred for b in page] if any(b.path.article for b in page) else None


def recompose(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The page's article in another container, among other blocks made of the page's own words."""
    labels = weak_labels(page) or [True] * len(page)
    body = [b for b, good in zip(page, labels) if good]
    words = [w for b in page for w in b.text.split()] or ["x"]
    outer = ("html", "body", *(_path("div.page") if rng.random() < 0.2 else ()), *(_path("div.wrapper") if rng.random() < 0.2 else ()))
    home = _path(ARTICLES[rng.integers(len(ARTICLES))])

    def said(low: int, high: int) -> str:
        n = int(rng.integers(low, high + 1))
        k = int(rng.integers(len(words)))
        return " ".join(words[(k + j) % len(words)] for j in range(n))

    def other(kind: str, within: tuple[str, ...] = ()) -> list[Block]:
        name = _path(AROUND[kind][rng.integers(len(AROUND[kind]))])
        long = kind in ("comments", "notice", "advert", "side", "footer", "header") and rng.random() < 0.6
        n = int(rng.integers(1, 9 if kind in ("menu", "form", "side") else 5))
        linked = 1.0 if kind == "menu" else float(rng.random() < 0.4)
        return [Block(Path.of((*outer, *within, *name)), said(4, 45) if long else said(1, 5), linked) for _ in range(n)]

    rows: list[tuple[Block, bool]] = []
    put = lambda kind, share, within=(): rows.extend((b, False) for b in other(kind, within)) if rng.random() < share else None
    for kind, share in (("notice", 0.3), ("header", 0.5), ("menu", 0.8), ("advert", 0.4), ("form", 0.2), ("side", 0.2)):
        put(kind, share)
    if rng.random() < 0.93:
        put("share", 0.15, home)
        flat = rng.random() < 0.2
        for k, b in enumerate(body):
            tail = b.path.last[-1:] if b.path.last and b.path.last[-1] in ("h1", "h2", "h3") else _path(INSIDE[rng.integers(len(INSIDE))]) if rng.random() < 0.3 else ("p",)
            rows.append((Block(Path.of((*outer, *home, *(() if flat and len(body) == 1 else tail))), b.text, b.linked), True))
            if k + 1 < len(body) and rng.random() < 0.06:
                put(("advert", "side", "form", "share", "notice")[rng.integers(5)], 1, home)
        put("comments", 0.2, home)
        put("share", 0.15, home)
    for kind, share in (("comments", 0.4), ("side", 0.4), ("form", 0.3), ("advert", 0.3), ("notice", 0.2), ("footer", 0.8), ("menu", 0.2)):
        put(kind, share)
    return [b for b, _ in rows], [y for _, y in rows]


def fit(pages: DataFrame, bound: int = MAX_TRAINING_PAGES, seed: int = SEED) -> dict | None:
    """Train on at most ``bound`` different pages of at most MAX_TRAINING_BYTES each, chosen by a hash of their html
    (rows that repeat a page count once, whatever their ids), each as it is, where its markup names an article, and
    recomposed.  Of a page with more than TRAINING_BLOCKS blocks as many in a row teach, from a place drawn by chance.
    None without a page to learn from."""
    usable = pages.where(F.octet_length("html") <= MAX_TRAINING_BYTES).select("html", F.xxhash64("html").alias("_hash"))
    n = usable.agg(F.approx_count_distinct("_hash")).first()[0]
    share = min(1.0, 2 * bound / n) if n else 1.0  # twice as many as needed, so that hardly ever fewer are chosen
    chosen = usable.where(F.pmod("_hash", F.lit(1 << 30)) < int(share * (1 << 30))).dropDuplicates(["_hash"])
    sample = chosen.orderBy("_hash").limit(bound).collect()  # bounded in rows and bytes
    rng = np.random.default_rng(seed)
    examples = []
    for row in sample:
        page = blocks(row["html"])
        if len(page) > TRAINING_BLOCKS:
            start = int(rng.integers(len(page) - TRAINING_BLOCKS + 1))
            page = page[start:start + TRAINING_BLOCKS]
        if not page:
            continue
        if (known := weak_labels(page)) is not None:
            examples.append((vectors(page), np.array(known, float)))
        for _ in range(VARIANTS):
            other, labels = recompose(page, rng)
            if other:
                examples.append((vectors(other), np.array(labels, float)))
    return train(examples, seed=seed) if examples else None


def judged(w: dict | None, pages: list[list[Block]]) -> list[np.ndarray]:
    """The blocks' probabilities; without a network 1 for what the markup calls article, for all where it names none."""
    if w is not None:
        return probabilities(w, [vectors(p) for p in pages])
    return [np.array(weak_labels(p) or [True] * len(p), float) for p in pages]


def _extractor(w: dict | None):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", 4 << 20):
            pages = [blocks(h or "") for h in batch.column("html").to_pylist()]
            texts = [""] * len(pages)
            order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
            at = 0
            while at < len(order):  # pages of like length together, a bounded number of blocks at a time
                size = max(1, min(256, 20_000 // len(pages[order[min(at + 255, len(order) - 1)]])))
                some = order[at:at + size]
                for k, p in zip(some, judged(w, [pages[k] for k in some])):
                    texts[k] = " ".join(b.text for b, q in zip(pages[k], p) if q >= 0.5)
                at += size
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return extract


def extract(pages: DataFrame, bound: int = MAX_TRAINING_PAGES) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``: the blocks that the network takes for the article, in order.

    A null or empty page, or one without article blocks, has text ''; repeated rows are read each; nulls in page_id and
    url pass through; where no page can be learned from, the markup alone decides; an empty table gives an empty result.  Whole pages are read, however long; other columns are
    ignored.
    """
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_extractor(fit(pages, bound)), "page_id long, url string, text string, n_chars long")
