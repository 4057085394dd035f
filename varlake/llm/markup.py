"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. Each block is a vector of its tag path (tags,
and hashed words of class and id), its hashed words and a few measures. A bidirectional LSTM in numpy reads a page's
blocks in both directions and labels each with the whole page in view. Blocks labelled as main text are joined.

It is trained on a bounded sample of pages whose own markup says where the article is, and on variants of them: the same
texts in other layouts, with menus, notices, forms, sidebars and comments around and inside the article. Many of these
pages are masked: telling tags and names are taken out, so that texts, layout and order must decide.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varlake.llm.arrays import Words, slices

# The elements of HTML by how they are laid out.
BLOCK_TAGS = "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
VOID_TAGS = "area base br col embed hr img input link meta param source track wbr".split()
RAW_TAGS = "script style noscript template textarea iframe svg math object canvas audio video".split()
#: Tags with a place of their own in the vector; all others share one.
PATH_TAGS = "a article aside b blockquote body button dd div dl dt em fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header i label li main nav ol option p pre section select span strong summary table td th title tr ul".split()
#: Closed by a block-level tag that begins, or by a like one.
_CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
_BLOCK, _VOID, _RAW = set(BLOCK_TAGS), set(VOID_TAGS), set(RAW_TAGS)
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORD = re.compile(r"[a-zA-Z]+")

NAME_BITS, WORD_BITS, MEASURES = 96, 32, 8
WIDTH = len(PATH_TAGS) + 1 + NAME_BITS + WORD_BITS + MEASURES
_TAG_AT = {t: i for i, t in enumerate(PATH_TAGS)}


@dataclass
class Block:
    path: tuple[tuple[str, str], ...]  # (tag, words of class and id) of each open element
    text: str
    linked: int  # characters inside links


def _names(attributes: str) -> str:
    return " ".join(w.lower().rstrip("s") for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[1] or m[2] or m[3] or "")) if "=" in attributes else ""


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a whole page in order, without empty ones. Character references are decoded, white space is one space.
    Broken markup is read as far as it goes: unclosed elements end with their parent, stray ends count for nothing."""
    out: list[Block] = []
    path: list[tuple[str, str]] = []
    pieces: list[str] = []
    linked, links, at, end = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(tuple(path), text, min(linked, len(text))))
            pieces.clear()
            linked = 0

    def drop(k: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in path[k:])
        del path[k:]

    while at < end:
        m = _TAG.search(page, at)
        begin = m.start() if m else end
        if begin > at:
            pieces.append(page[at:begin])
            if links:
                linked += begin - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag in _RAW:
            if not m[1] and not m[3].endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if m[1]:
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == tag:
                    drop(k)
                    break
            continue
        if tag in _BLOCK:  # a paragraph ends where a block begins
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == "p":
                    drop(k)
                    break
                if path[k][0] in _BLOCK:
                    break
        if tag in _CLOSES:
            like, until = (x.split() for x in _CLOSES[tag])
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] in until:
                    break
                if path[k][0] in like:
                    drop(k)
                    break
        if tag not in _VOID and not m[3].endswith("/"):
            path.append((tag, _names(m[3])))
            links += tag == "a"
    flush()
    return out


_paths: dict[tuple, np.ndarray] = {}


def _path_vector(path: tuple) -> np.ndarray:
    have = _paths.get(path)
    if have is None:
        if len(_paths) > 20_000:
            _paths.clear()
        have = np.zeros(len(PATH_TAGS) + 1 + NAME_BITS, np.float32)
        for tag, names in path:
            have[_TAG_AT.get(tag, len(PATH_TAGS))] = 1
            for w in names.split():
                have[len(PATH_TAGS) + 1 + crc32(w.encode()) % NAME_BITS] = 1
        _paths[path] = have
    return have


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """A row of WIDTH numbers for each block of all pages."""
    every = [b for page in pages for b in page]
    out = np.zeros((len(every), WIDTH), np.float32)
    if not every:
        return out
    k = len(PATH_TAGS) + 1 + NAME_BITS
    for i, b in enumerate(every):
        out[i, :k] = _path_vector(b.path)
    words = Words(pa.array([b.text for b in every], pa.string()), lower=True, terms=True)
    owner = np.repeat(np.arange(len(every)), words.counts)
    np.add.at(out, (owner, k + (words.hashes() % np.uint64(WORD_BITS)).astype(int)), 1)
    # shares of the words, cut off: a text of one repeated word is no stranger than others
    out[:, k : k + WORD_BITS] = np.minimum(out[:, k : k + WORD_BITS] / np.maximum(1, words.counts)[:, None], 0.15)
    size = np.array([len(b.text) for b in every], np.float32)
    place = np.concatenate([np.linspace(0, 1, len(p), dtype=np.float32) for p in pages if p])
    m = out[:, k + WORD_BITS :]
    m[:, 0], m[:, 1], m[:, 2] = np.log1p(size) / 8, np.array([b.linked for b in every]) / size, np.log1p(words.counts) / 6
    m[:, 3], m[:, 4], m[:, 5] = place, size < 40, [b.text[-1] in ".!?" for b in every]
    m[:, 6], m[:, 7] = [len(b.path) / 16 for b in every], [any(c in b.text for c in "©|»") for b in every]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one output for each step. Sequences of a batch are padded; a mask keeps padding out."""

    def __init__(self, hidden: int = 20, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.w = {}
        for d in "fb":
            self.w[f"x{d}"] = (rng.standard_normal((WIDTH, 4 * hidden)) * 0.15).astype(np.float32)
            self.w[f"h{d}"] = (rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32)
            self.w[f"b{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
        self.w["o"] = (rng.standard_normal(2 * hidden) * 0.2).astype(np.float32)
        self.w["c"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        steps, rows, n = x.shape[0], x.shape[1], self.hidden
        gates = x.reshape(-1, WIDTH) @ self.w[f"x{d}"] + self.w[f"b{d}"]
        gates = gates.reshape(steps, rows, 4 * n)
        h, c, out, tape = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32), np.zeros((steps, rows, n), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ self.w[f"h{d}"]
            g = _sigmoid(z[:, : 3 * n])
            i, f, o, u = g[:, :n], g[:, n : 2 * n], g[:, 2 * n :], np.tanh(z[:, 3 * n :])
            on = mask[t][:, None]
            new = f * c + i * u
            tan = np.tanh(new)
            if keep:
                tape.append((t, h, c, i, f, o, u, tan, on))
            c = np.where(on, new, c)
            h = np.where(on, o * tan, h)
            out[t] = h
        return out, tape

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        f, _ = self._run(x, mask, "f", False)
        b, _ = self._run(x, mask, "b", False)
        return _sigmoid(f @ self.w["o"][: self.hidden] + b @ self.w["o"][self.hidden :] + self.w["c"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over the steps of mask, and its gradients."""
        n, total = self.hidden, max(1, int(mask.sum()))
        runs = {d: self._run(x, mask, d, True) for d in "fb"}
        p = _sigmoid(runs["f"][0] @ self.w["o"][:n] + runs["b"][0] @ self.w["o"][n:] + self.w["c"])
        loss = -float((np.log(np.where(y > 0.5, p, 1 - p) + 1e-9) * mask).sum()) / total
        err = ((p - y) * mask / total).astype(np.float32)
        grad = {"c": np.array([err.sum()], np.float32), "o": np.concatenate([np.einsum("tr,trn->n", err, runs[d][0]) for d in "fb"])}
        for k, d in enumerate("fb"):
            back = err[:, :, None] * self.w["o"][k * n : (k + 1) * n]
            dz_all = np.zeros((*mask.shape, 4 * n), np.float32)
            dh, dc = np.zeros((mask.shape[1], n), np.float32), np.zeros((mask.shape[1], n), np.float32)
            gh = np.zeros_like(self.w[f"h{d}"])
            for t, h, c, i, f, o, u, tan, on in reversed(runs[d][1]):
                dh = dh + back[t]
                live_h, live_c = np.where(on, dh, 0), np.where(on, dc, 0)
                dcell = live_c + live_h * o * (1 - tan * tan)
                dz = np.concatenate([dcell * u * i * (1 - i), dcell * c * f * (1 - f), live_h * tan * o * (1 - o), dcell * i * (1 - u * u)], 1)
                dz_all[t] = dz
                gh += h.T @ dz
                dh = np.where(on, dz @ self.w[f"h{d}"].T, dh)
                dc = np.where(on, dcell * f, dc)
            grad[f"h{d}"] = gh
            grad[f"x{d}"] = x.reshape(-1, WIDTH).T @ dz_all.reshape(-1, 4 * n)
            grad[f"b{d}"] = dz_all.sum((0, 1))
        return loss, grad


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(r) for r in rows)
    x, mask = np.zeros((steps, len(rows), WIDTH), np.float32), np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, True
    return x, mask


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 14, seed: int = 7) -> Labeller:
    """Adam on batches of pages of like length: 24, or as many as 20,000 padded blocks hold."""
    model, rng = Labeller(seed=seed), random.Random(seed)
    pages = [p for p in pages if p[0]]
    rows = [vectors([b]) for b, _ in pages]
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    batches: list[list[int]] = []
    for i in order:
        if not batches or len(batches[-1]) == 24 or len(rows[i]) * (len(batches[-1]) + 1) > 20_000:
            batches.append([])
        batches[-1].append(i)
    m, v, step = {k: np.zeros_like(w) for k, w in model.w.items()}, {k: np.zeros_like(w) for k, w in model.w.items()}, 0
    for epoch in range(epochs):
        rng.shuffle(batches)
        for batch in batches:
            x, mask = _padded([rows[i] for i in batch])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(batch):
                y[: len(rows[i]), k] = pages[i][1]
            _, grad = model.gradients(x, mask, y)
            norm, step = np.sqrt(sum(float((g * g).sum()) for g in grad.values())), step + 1
            rate = 0.02 * (0.5 if epoch > epochs * 2 // 3 else 1)
            for key, g in grad.items():
                g = g * min(1, 1 / max(norm, 1e-9))
                m[key] = 0.9 * m[key] + 0.1 * g
                v[key] = 0.99 * v[key] + 0.01 * g * g
                model.w[key] = (model.w[key] - rate * (m[key] / (1 - 0.9**step)) / (np.sqrt(v[key] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


# Names that pages give their parts, for the variants to train on.
CONTENT_NAMES = "article content entry-content post-content post-body article-body story main-content page-content text body-text post entry single-post rich-text prose markdown-body".split()
MENU_NAMES = "nav navbar menu main-menu topbar breadcrumbs breadcrumb site-header header masthead toolbar navigation pagination pager skip-link".split()
SIDE_NAMES = "sidebar side-bar widget widget-area related related-posts recommended popular tags categories archive toc author-box bio more-stories trending".split()
NOTICE_NAMES = "cookie cookie-banner cookie-notice consent gdpr notice alert banner modal popup overlay subscribe newsletter paywall promo announcement disclaimer".split()
AD_NAMES = "ad ads advert advertisement ad-container ad-slot sponsor sponsored promoted adsbox banner-ad".split()
FOOTER_NAMES = "footer site-footer copyright legal colophon bottom footer-links credits".split()
COMMENT_NAMES = "comments comment comment-list comment-body responses discussion replies reply disqus-thread comments-area user-comments respond".split()
SHARE_NAMES = "share social sharing share-buttons social-links follow print-links post-meta byline-links".split()
FORM_NAMES = "search search-form login signup contact-form form comment-form subscribe-form survey".split()
_WRAPPERS = "container wrapper row col page site inner layout grid content-wrapper main-wrapper".split()


def _variant(texts: list[str], other: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A page in some layout: texts are its article, other texts fill what stands around and inside it."""
    kept: list[tuple[list[Block], int]] = []

    def words(least: int, most: int) -> str:
        return " ".join(rng.choice(other).split()[: rng.randint(least, most)]) or "x"

    def put(path: list, text: str, label: int, linked: bool = False) -> None:
        kept.append(([Block(tuple(path), text, len(text) if linked else 0)], label))

    def element(tags: str, names: list[str]) -> tuple[str, str]:
        tag = rng.choice(tags.split())
        plain = tag in "nav aside footer header form main article".split() and rng.random() < 0.5
        return tag, "" if plain else " ".join(w.rstrip("s") for w in _WORD.findall(rng.choice(names)))

    def links(path: list, tags: str, names: list[str], n: int) -> None:
        own = element(tags, names)
        for _ in range(n):
            put([*path, own, ("ul", ""), ("li", "")] if rng.random() < 0.8 else [*path, own, ("div", "")], words(1, 4), 0, True)

    def prose(path: list, tags: str, names: list[str], n: int, least: int = 4, most: int = 40) -> None:
        own = element(tags, names)
        for _ in range(n):
            inner = rng.choice([[("p", "")], [], [("div", "")], [("span", "")], [("h3", "")]])
            put([*path, own, *inner], words(least, most), 0, rng.random() < 0.15)

    def comments(path: list) -> None:
        own = element("section div ol aside", COMMENT_NAMES)
        if rng.random() < 0.6:
            put([*path, own, (rng.choice(["h2", "h3", "h4"]), "")], words(1, 3), 0)
        for _ in range(rng.randint(1, 6)):
            item = [*path, own, rng.choice([("li", rng.choice(["comment", ""])), ("div", rng.choice(["comment", "comment body", "reply"])), ("article", rng.choice(["comment", ""])), ("p", "")])]
            if rng.random() < 0.5:
                put([*item, ("div", rng.choice(["author", "comment meta", "comment author"]))], words(1, 3), 0)
            put([*item, ("p", "")] if item[-1][0] != "p" else item, words(3, 60), 0)

    def noise(path: list, inside: bool) -> None:
        kind = rng.choice(["ad", "share", "notice", "form", "related", "ad"] if inside else ["menu", "side", "notice", "ad", "form", "footer", "share"])
        if kind == "menu":
            links(path, "nav div header ul", MENU_NAMES, rng.randint(2, 8))
        elif kind == "ad":
            prose(path, "div aside section ins", AD_NAMES, rng.randint(1, 2))
        elif kind == "share":
            links(path, "div ul aside", SHARE_NAMES, rng.randint(1, 4))
        elif kind == "notice":
            prose(path, "div section aside p", NOTICE_NAMES, rng.randint(1, 2), 4, 30)
        elif kind == "form":
            own, inner = element("form", FORM_NAMES), rng.choice(["label", "button", "p", "legend", "option"])
            for _ in range(rng.randint(1, 3)):
                put([*path, own, (inner, "")], words(1, 8), 0)
        elif kind == "footer":
            prose(path, "footer div", FOOTER_NAMES, rng.randint(1, 2), 3, 20)
        elif rng.random() < 0.5:
            links(path, "aside div section", SIDE_NAMES, rng.randint(2, 6))
        else:
            prose(path, "aside div section", SIDE_NAMES, rng.randint(1, 3))

    body = [("html", ""), ("body", "")] + [("div", rng.choice(_WRAPPERS))] * rng.choice([0, 0, 1, 2])
    put([("html", ""), ("head", ""), ("title", "")], texts[0][:60], 0)
    for _ in range(rng.randint(0, 3)):
        noise(body, False)
    if rng.random() < 0.7:
        links(body, "nav div header", MENU_NAMES, rng.randint(2, 8))
    content = [*body, element("article article main div div section", CONTENT_NAMES)]
    if rng.random() < 0.3:
        content.append(element("div section article", CONTENT_NAMES))
    put([*content, *([("header", "")] if rng.random() < 0.15 else []), (rng.choice(["h1", "h1", "h2"]), rng.choice(["", "", "title", "entry title", "headline"]))], texts[0], 1)
    for text in texts[1:]:
        if rng.random() < 0.06:
            noise(content, True)
        inner = rng.choice([[("p", "")]] * 12 + [[("p", ""), ("b", "")], [("h2", "")], [("h3", "")], [("blockquote", ""), ("p", "")], [("ul", ""), ("li", "")], [("ol", ""), ("li", "")], [("table", ""), ("tr", ""), ("td", "")], [("pre", "")], [("div", "")], [("figure", ""), ("figcaption", "")]])
        put([*content, *inner], " ".join(text.split()[: rng.randint(1, 8)]) if rng.random() < 0.1 else text, 1, False)
        if rng.random() < 0.08:
            items = [(rng.choice(["ul", "ol"]), ""), ("li", "")] if rng.random() < 0.8 else [("dl", ""), ("dd", "")]
            for _ in range(rng.randint(2, 5)):
                put([*content, *items], words(1, 12), 1)
    if rng.random() < 0.35:
        noise(content, True)
    if rng.random() < 0.25:
        comments(content)
    elif rng.random() < 0.4:
        comments(body)
    for _ in range(rng.randint(0, 2)):
        noise(body, False)
    if rng.random() < 0.75:
        prose(body, "footer footer div", FOOTER_NAMES, rng.randint(1, 2), 3, 20)
    return [b for bs, _ in kept for b in bs], [y for bs, y in kept for _ in bs]


_ROOTS, _AROUND = {"article", "main"}, {"nav", "aside", "footer", "form", "head", "button", "select"}
_AROUND_NAMES = {w.rstrip("s") for names in (SIDE_NAMES, NOTICE_NAMES, AD_NAMES, COMMENT_NAMES, SHARE_NAMES, FORM_NAMES) for n in names for w in n.split("-")} - {"more", "body", "list", "form", "area", "box", "user", "author", "print", "link", "post", "meta", "container", "slot", "tag"}


def labelled(page: list[Block]) -> list[int] | None:
    """What the page's markup says: blocks in article or main, without parts that tags or names set apart. None if it says nothing."""
    roots = [any(t in _ROOTS for t, _ in b.path) for b in page]
    if not any(roots):
        return None
    return [int(r and not any(t in _AROUND or _AROUND_NAMES & set(n.split()) for t, n in b.path)) for b, r in zip(page, roots)]


#: Tags that say what a part is for. Where they are masked, all are div.
_TELLING = {"article", "main", "nav", "aside", "header", "footer", "section", "form", "figure", "figcaption", "button", "menu"}


def masked(page: list[Block], tags: bool, names: bool) -> list[Block]:
    """The page without telling tags, or without names, or without both: what is left is its texts and their layout."""
    known: dict[tuple, tuple] = {}

    def path(own: tuple) -> tuple:
        if own not in known:
            known[own] = tuple(("div" if tags and t in _TELLING else t, "" if names else n) for t, n in own)
        return known[own]

    return [Block(path(b.path), b.text, b.linked) for b in page]


#: Pages that training takes at most, bytes of all of them and of one, and variants made of each.
MAX_PAGES, MAX_BYTES, MAX_PAGE_BYTES, VARIANTS = 160, 4 << 20, 256 << 10, 4


def sample(pages: DataFrame, max_pages: int = MAX_PAGES, max_bytes: int = MAX_BYTES, max_page_bytes: int = MAX_PAGE_BYTES) -> list[str]:
    """HTML of the pages to train on, whole: of those of at most max_page_bytes the first in the order of a hash of page_id, at most max_pages,
    as many as max_bytes hold. They are chosen by id and size before any HTML is fetched."""
    known = pages.where("html IS NOT NULL AND page_id IS NOT NULL").select("page_id", F.xxhash64("html").alias("copy"), F.octet_length("html").cast("long").alias("size"))
    rows = known.where(F.col("size") <= max_page_bytes).orderBy(F.xxhash64("page_id"), "page_id", "copy").limit(max_pages).collect()
    wanted, total = [], 0
    for r in rows:
        total += r["size"]
        if total <= max_bytes:
            wanted.append((r.page_id, r["copy"]))
    if not wanted:
        return []
    keys = F.broadcast(pages.sparkSession.createDataFrame(wanted, "page_id long, copy long").distinct())
    found = pages.select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64("html").alias("copy"), "html").join(keys, ["page_id", "copy"], "left_semi")
    # rows of equal id and HTML are one
    return [r.html for r in sorted(found.dropDuplicates(["page_id", "copy"]).collect(), key=lambda r: (crc32(str(r.page_id).encode()), r.html))]


def examples(htmls: list[str], variants: int = VARIANTS, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Labelled pages to train on: those whose markup names the article, as they are and masked, and variants of their texts, of which
    two thirds are masked. Pages that say nothing are left out; without any, variants are made of fixed words."""
    known, rng = [], random.Random(seed)
    for page in htmls:
        own = blocks(page)
        labels = labelled(own)
        if labels and sum(labels):
            known.append((own, labels))
    texts = [[b.text for b, y in zip(own, labels) if y] for own, labels in known] or [["A title", "Some words of text.", "More words, and an end."]] * 8
    pool = [t for ts in texts for t in ts]
    known += [(masked(own, True, True), labels) for own, labels in known]
    for ts in texts:
        for _ in range(variants):
            own, labels = _variant(ts[: rng.randint(1, len(ts))] if len(ts) > 1 and rng.random() < 0.7 else ts, pool, rng)
            kind = rng.randrange(3)
            known.append((masked(own, kind > 1, kind > 0) if kind else own, labels))
    return known


def fit(pages: DataFrame, max_pages: int = MAX_PAGES, variants: int = VARIANTS, seed: int = 7) -> Labeller:
    """A labeller from pages (page_id, html), trained on a bounded sample of them."""
    return train(examples(sample(pages, max_pages), variants, seed), seed=seed)


RESULT = "text string, n_chars long, n_blocks int, n_kept int"


def extract(pages: DataFrame, model: Labeller, keep: list[str] | None = None) -> DataFrame:
    """The columns named in keep (all but html, if None) with text (the blocks labelled as main text, joined by two \\n), n_chars
    (its code points), n_blocks and n_kept. Whole pages are read. A null or empty page, or one without main text,
    gives an empty text. Columns of the input with these names give way."""
    names = [f.name for f in T._parse_datatype_string(RESULT)]
    keep = [c for c in (pages.columns if keep is None else keep) if c not in [*names, "html"]]
    source = pages.select(*keep, F.col("html").alias("__html"))
    schema = T.StructType([*pages.select(*keep).schema.fields, *T._parse_datatype_string(RESULT).fields])
    shared = pages.sparkSession.sparkContext.broadcast(model)  # its size is fixed

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = shared.value
        for batch in slices(batches, "__html"):
            own = [blocks(page or "") for page in batch.column("__html").to_pylist()]
            rows = vectors(own)
            ends = np.append(0, np.cumsum([len(b) for b in own]))
            chosen = np.zeros(len(rows), bool)
            order = sorted((i for i in range(len(own)) if own[i]), key=lambda i: len(own[i]))
            while order:  # pages of like length together, about 20,000 padded blocks at once
                n = max(1, min(len(order), 256))
                while n > 1 and len(own[order[n - 1]]) * n > 20_000:
                    n //= 2
                batch_, order = order[:n], order[n:]
                x, mask = _padded([rows[ends[i] : ends[i + 1]] for i in batch_])
                score = labeller.scores(x, mask)
                for k, i in enumerate(batch_):
                    chosen[ends[i] : ends[i + 1]] = score[: len(own[i]), k] >= 0.5
            texts = ["\n\n".join(b.text for b, y in zip(bs, chosen[lo:hi]) if y) for bs, lo, hi in zip(own, ends[:-1], ends[1:])]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(np.diff(ends), pa.int32()), pa.array([int(chosen[lo:hi].sum()) for lo, hi in zip(ends[:-1], ends[1:])], pa.int32())]
            yield pa.record_batch(columns, names=[f.name for f in schema])

    return source.mapInArrow(extracted, schema)
