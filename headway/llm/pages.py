"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is read into leaf blocks: text between the tags that begin or end a block, with the tags, class
words and roles of its ancestors. A chain over the blocks with two labels, text of the article or not,
is trained by gradient on labelled pages and decoded by Viterbi. Features are ancestor tags, ancestor class words
(each as it is and by what such words commonly stand for), and how the text looks.

Labelled pages: a sample of about ``SAMPLE_PAGES`` pages, by hash of the id, whose blocks are labelled by the meaning HTML
gives to tags (inside ``article`` or ``main``, and not inside ``nav``, ``aside``, ``footer``, ``form`` and the like). Their
texts are also written into made-up pages of many layouts, with menus, notices, sidebars, adverts, forms and
reader comments inside and outside the article, labelled by construction.

Defined results: null and empty pages give empty text; pages cut off anywhere are read as far as they go, and
what is unclosed ends with the page; repeated rows give repeated results; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from headway.llm.common import batch_of, blocks, mapped, unit_hash

SAMPLE_PAGES = 300
WIDTH = 1 << 14
ROUNDS = 12

# --- reading ------------------------------------------------------------------------------------

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(?P<raw>script|style|textarea)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CLASS_WORD = re.compile(r"[a-z]+")
#: Tags that begin and end blocks.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Tags without content.
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags whose content is no text of the page, from one to its own end; one without an end hides nothing.
HIDDEN = frozenset("noscript template svg iframe select button".split())
HIDING = re.compile(r"<(?:" + "|".join(sorted(HIDDEN)) + r")[\s/>]", re.I).search
#: Tags that an opening tag of the same group closes.
CLOSED_BY = {
    "p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "tr": frozenset({"tr", "td", "th", "p"}),
}


class Block(NamedTuple):
    text: str
    tag: str  # the innermost block tag
    tags: frozenset[str]  # all block tags it lies in
    words: frozenset[str]  # words of their classes, ids and roles
    linked: int  # characters inside links


def class_words(more: str) -> tuple[str, ...]:
    out: list[str] = []
    for m in ATTRIBUTE.finditer(more):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "").lower()
        out += CLASS_WORD.findall(value)
    return tuple(out)


def hidden(page: str) -> dict[int, int]:
    """Where hidden content begins, at its tag, and where its end tag does. The end of a block around ends what is open in it."""
    out: dict[int, int] = {}
    if not HIDING(page):
        return out
    stack: list[tuple[str, int]] = []
    count: dict[str, int] = {}
    for m in TOKEN.finditer(page):
        name = (m["name"] or "").lower()
        if name not in HIDDEN and name not in BLOCK_TAGS or name in EMPTY_TAGS:
            continue
        if not m["end"]:
            if not (name == "svg" and m["more"].endswith("/")):  # of these only svg can close itself
                stack.append((name, m.start()))
                count[name] = count.get(name, 0) + 1
        elif count.get(name):
            while True:
                last, start = stack.pop()
                count[last] -= 1
                if last == name:
                    break
            if name in HIDDEN:
                out[start] = m.start()
    return out


def leaf_blocks(page: str) -> list[Block]:
    out: list[Block] = []
    # Each open tag with all tags and words down to it; sets that do not grow are shared.
    stack: list[tuple[str, frozenset[str], frozenset[str]]] = [("", frozenset(), frozenset())]
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, *stack[-1], linked))
            parts.clear()
        linked = 0

    ends, shown = hidden(page), 0
    for m in TOKEN.finditer(page):
        if m.start() < shown:
            continue
        name = m["name"]
        if name is None:
            if m["raw"] is None and not m[0].startswith(("<!", "<?", "</")):
                text = html.unescape(m[0])
                parts.append(text)
                linked += len(text) if in_link else 0
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
        elif name == "a":
            in_link = not m["end"]
        elif name not in BLOCK_TAGS:
            shown = ends.get(m.start(), shown)
            continue
        elif m["end"]:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        else:
            flush()
            closes = CLOSED_BY.get(name, frozenset({"p"}))
            while stack and stack[-1][0] in closes:
                stack.pop()
            if name not in EMPTY_TAGS:  # a tag that closes itself is no less open in HTML
                _, tags, words = stack[-1]
                own = class_words(m["more"])
                stack.append((name, tags if name in tags else tags | {name}, words if words.issuperset(own) else words.union(own)))
    flush()
    return out


# --- features -------------------------------------------------------------------------------------

#: What class words commonly stand for.
MEANINGS = {
    "advert": "ad ads adv advert adverts advertisement banner promo promoted promotion sponsor sponsored sponsors teaser adsense",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc skip",
    "footer": "footer foot copyright colophon legal imprint",
    "header": "header masthead topbar branding logo hero",
    "side": "sidebar side aside widget widgets related recommended recommendations trending popular rail share sharing social more",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay warning disclaimer announcement paywall toast",
    "comment": "comment comments commentlist reply replies respond discussion disqus thread reader readers reviews feedback complementary",
    "form": "form subscribe subscription newsletter signup signin login register search contact",
    "article": "article post entry content story main body text prose page articlebody postcontent",
}
MEANING_OF = {word: name for name, words in MEANINGS.items() for word in words.split()}


def features(blocks_: list[Block]) -> list[np.ndarray]:
    """For each block the places of its features among the weights."""
    out = []
    known: dict[tuple[str, frozenset[str], frozenset[str]], list[str]] = {}
    for i, b in enumerate(blocks_):
        outer = known.get(b[1:4])
        if outer is None:
            outer = [f"in {t}" for t in b.tags] + [f"word {w}" for w in b.words]
            outer += [f"means {m}" for m in {MEANING_OF[w] for w in b.words if w in MEANING_OF}]
            outer += [f"tag {b.tag}", "any"]
            known[b[1:4]] = outer
        n = len(b.text)
        share = b.linked / n
        look = [
            f"size {min(n.bit_length(), 11)}", f"linked {0 if not b.linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
            f"ends {b.text[-1] if b.text[-1] in '.!?:;,' else 'open'}", f"rights {any(c in b.text for c in '©|»·')}",
            f"first {i == 0}", f"last {i == len(blocks_) - 1}",
        ]
        out.append(np.array([zlib.crc32(f.encode()) % WIDTH for f in outer + look]))
    return out


# --- the chain ------------------------------------------------------------------------------------


class Model(NamedTuple):
    weight: np.ndarray  # of each feature for label 1 against label 0
    step: np.ndarray  # label to label


def _gradient(found: list[np.ndarray], y: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Of the log-likelihood of one page: with respect to the scores of label 1, and to the transitions."""
    e = np.zeros((len(found), 2))
    e[:, 1] = [m.weight[f].sum() for f in found]
    n = len(e)
    alpha, beta = e.copy(), np.zeros_like(e)
    for t in range(1, n):
        alpha[t] += np.logaddexp.reduce(alpha[t - 1][:, None] + m.step, axis=0)
    for t in range(n - 2, -1, -1):
        beta[t] = np.logaddexp.reduce(m.step + e[t + 1] + beta[t + 1], axis=1)
    total = np.logaddexp.reduce(alpha[-1])
    p = np.exp(alpha + beta - total)
    step = np.zeros((2, 2))
    np.add.at(step, (y[:-1], y[1:]), 1.0)
    if n > 1:
        step -= np.exp(alpha[:-1, :, None] + m.step + (e[1:] + beta[1:])[:, None, :] - total).sum(axis=0)
    return y - p[:, 1], step


def train(pages: list[tuple[list[np.ndarray], np.ndarray]], rounds: int = ROUNDS, seed: int = 4) -> Model:
    """By stochastic gradient with per-weight rates, a little shrinkage."""
    m = Model(np.zeros(WIDTH), np.zeros((2, 2)))
    seen_w, seen_s = np.full(WIDTH, 1e-6), np.full((2, 2), 1e-6)
    order = random.Random(seed)
    pages = [p for p in pages if p[0]]
    for _ in range(rounds):
        order.shuffle(pages)
        for found, y in pages:
            score, step = _gradient(found, y, m)
            flat = np.concatenate(found)
            g = np.bincount(flat, weights=np.repeat(score, [len(f) for f in found]), minlength=WIDTH)
            some = np.flatnonzero(g)
            g = g[some] - 1e-3 * m.weight[some]
            seen_w[some] += g * g
            m.weight[some] += 0.3 * g / np.sqrt(seen_w[some])
            seen_s += step * step
            m.step[...] += 0.3 * (step - 1e-3 * m.step) / np.sqrt(seen_s)
    return m


def decode(found: list[np.ndarray], m: Model) -> list[int]:
    """The likeliest labels, by Viterbi."""
    (s00, s01), (s10, s11) = m.step.tolist()
    zero, one, came = 0.0, 0.0, []
    for t, f in enumerate(found):
        e = float(m.weight[f].sum())
        if t:
            a, b, c, d = zero + s00, one + s10, zero + s01, one + s11
            came.append((a < b, c < d))
            zero, one = max(a, b), max(c, d) + e
        else:
            one = e
    labels = [int(one > zero)] if found else []
    for back in reversed(came):
        labels.append(int(back[labels[-1]]))
    return labels[::-1]


# --- labelled pages ---------------------------------------------------------------------------------

OUTSIDE = frozenset({"nav", "aside", "footer", "form", "header", "menu", "dialog", "title", "head"})
REFUSED = frozenset({"advert", "menu", "footer", "side", "notice", "comment", "form"})


def labels_by_meaning(blocks_: list[Block]) -> np.ndarray | None:
    """1 inside ``article`` or ``main`` but for what is marked as something else; None for pages without either."""
    if not any(t in ("article", "main") for b in blocks_ for t in b.tags):
        return None
    return np.array(
        [
            int(
                any(t in ("article", "main") for t in b.tags) and not OUTSIDE & b.tags
                and not REFUSED & {MEANING_OF.get(w) for w in b.words}
            )
            for b in blocks_
        ]
    )


def written_page(texts: list[str], chance: random.Random) -> tuple[str, list[str]]:
    """A made-up page around the texts, and the blocks of its article in order."""
    esc = html.escape
    short = lambda: " ".join((chance.choice(texts).split() * 3)[: chance.randint(1, 14)])
    pick = chance.choice
    kinds = {
        "advert": ["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "ad-slot", "advertisement"],
        "menu": ["nav", "navbar", "menu", "breadcrumbs", "main-nav", "pagination"],
        "footer": ["footer", "site-footer", "copyright", "foot"],
        "header": ["header", "site-header", "masthead", "topbar"],
        "side": ["sidebar", "widget", "related-posts", "aside", "trending", "share-buttons", "recommended"],
        "notice": ["cookie-notice", "consent", "gdpr-banner", "notice", "alert", "popup", "modal"],
        "comment": ["comments", "comment-list", "reader-comments", "replies", "discussion", "comment", "disqus_thread"],
        "form": ["newsletter", "signup", "login-form", "subscribe", "search-form", "contact-form"],
    }
    tags = {"menu": ["nav", "div", "ul"], "footer": ["footer", "div"], "header": ["header", "div"], "side": ["aside", "div", "section"], "form": ["form", "div"]}

    def other(kind: str) -> str:
        tag = pick(tags.get(kind, ["div", "section", "aside", "div", "p"]))
        # A tag that speaks for itself may come without a class.
        bare = tag in ("nav", "footer", "header", "aside", "form") and chance.random() < 0.5
        mark = "" if bare else f' {pick(["class", "class", "id"])}="{pick(kinds[kind])}"'
        if kind == "menu":
            items = "".join(f'<li><a href="#">{esc(short())}</a></li>' for _ in range(chance.randint(2, 7)))
            inner = items if tag == "ul" else f"<ul>{items}</ul>"
        elif kind == "form":
            inner = f"<label>{esc(short())}</label><input><p>{esc(short())}</p>"
        elif tag == "p":
            inner = esc(short())
        else:
            rows = chance.randint(1, 4)
            text = lambda: esc(pick(texts) if kind in ("comment", "side", "advert", "notice") and chance.random() < 0.4 else short())
            inner = "".join(pick(["<p>{}</p>", "<div>{}</div>", "<h3>{}</h3>", "<p><a href='#'>{}</a></p>", "{}"]).format(text()) for _ in range(rows))
        return f"<{tag}{mark}>{inner}</{tag}>"

    article: list[str] = []
    body = ""
    for k, t in enumerate([short(), *(pick(texts) for _ in range(chance.randint(1, 8)))]):
        t = " ".join(t.split())
        if not t:
            continue
        article.append(t)
        body += pick(["<h1>{}</h1>", "<h2>{}</h2>"] if not k else ["<p>{}</p>"] * 6 + ["<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<h2>{}</h2>"]).format(esc(t))
        if k and chance.random() < 0.15:
            body += other(pick(["advert", "side", "form", "notice"]))
    if chance.random() < 0.3:
        body += other("comment")
    box = pick(["article", "article", "article", "main", "div", "div", "section"])
    mark = "" if box in ("article", "main") and chance.random() < 0.6 else f' class="{pick(["content", "post", "entry-content", "article-body", "story", "main-content", "post-body"])}"'
    page = "".join(other(k) for k in ("notice", "header", "menu", "advert", "side") if chance.random() < 0.6)
    page += f"<{box}{mark}>{body}</{box}>"
    page += "".join(other(k) for k in ("comment", "side", "advert", "form", "footer", "notice") if chance.random() < 0.55)
    return f"<html><head><title>{esc(short())}</title></head><body>{page}</body></html>", article


def _labels_by_order(blocks_: list[Block], article: list[str]) -> np.ndarray:
    """1 for the blocks of the article, told by their ancestors' container and their order."""
    y, k = np.zeros(len(blocks_), dtype=np.int64), 0
    for i, b in enumerate(blocks_):
        if k < len(article) and b.text == article[k] and not OUTSIDE & b.tags and not REFUSED & {MEANING_OF.get(w) for w in b.words}:
            y[i], k = 1, k + 1
    return y


FALLBACK = ["The council met last week and agreed on the plan for the coming year.", "It rained.", "A longer text follows here, with some clauses, and an end."]


def training_pages(pages: list[str], made: int = 500, seed: int = 6) -> list[tuple[list[np.ndarray], np.ndarray]]:
    out = []
    texts: list[str] = []
    for page in pages:
        found = leaf_blocks(page)
        y = labels_by_meaning(found)
        if y is not None and found:
            out.append((features(found), y))
            texts += [b.text for b, label in zip(found, y) if label][:6]
    chance = random.Random(seed)
    texts = texts or FALLBACK
    for _ in range(made):
        page, article = written_page(texts, chance)
        found = leaf_blocks(page)
        out.append((features(found), _labels_by_order(found, article)))
    return out


def learn(pages: DataFrame, sample: int = SAMPLE_PAGES, made: int = 500, rounds: int = ROUNDS) -> Model:
    """Train on about ``sample`` pages of ``page_id, html`` and as many made-up ones as said."""
    rows = pages.where(F.col("html").isNotNull()).select("page_id", "html")
    total = pages.select("page_id").count()
    taken = rows.where(unit_hash(F.col("page_id"), F.lit("pages")) < F.lit(sample / max(1, total)))
    got = sorted(r["html"] for r in taken.select("html").toLocalIterator(True))
    return train(training_pages(got, made), rounds)


def main_text(page: str, m: Model) -> str:
    found = leaf_blocks(page)
    return " ".join(b.text for b, label in zip(found, decode(features(found), m)) if label)


FOUND = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """``page_id, url, text`` of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, "html"):
            yield batch_of(
                FOUND, page_id=batch.column("page_id"), url=batch.column("url"), text=[main_text(t, sent.value) for t in texts]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return mapped(rows, run, "page_id long, url string, text string")


def op8_crf_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, learn(pages)).withColumn("n_chars", F.length("text").cast("long"))
