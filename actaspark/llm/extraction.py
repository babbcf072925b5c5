"""Main text of pages: a linear-chain conditional random field over DOM leaf blocks.

Every leaf block is one position of the chain. Its features are its ancestors' tags and the words of their classes, ids
and roles, and of its text the length, the share of links, punctuation and, in short blocks, the words. The two labels
(main, other) share a score for each hashed feature and have learned transitions; the fit maximises the likelihood
by exact forward-backward, and Viterbi decodes each page.

Labelled pages: pages of the table whose markup says it (blocks in ``article`` or ``main``, but not in ``nav``, ``aside``,
``footer``, ``form``), and the same texts laid out anew in ``layouts``' random templates with the containers of other
sites (class names of content, menus, notices, adverts, sidebars, forms, reader comments), so that the markup of one site
isn't all that is learned. The fit reads at most ``pages`` pages of at most ``page_bytes`` bytes, drawn by hash; every
page of the table is extracted whole, in one scan without a shuffle.

Defined results: null html is empty; a page without main blocks gives the empty text and 0; very long pages are read
whole; null and repeated ids, ties and repeated rows give a row each; other columns are ignored, whatever their
names; an empty table gives no rows, and the fit then uses templates alone. Markup that is never closed ends with the
page, as browsers have it; a line break element is white space; scripts, styles, titles and text areas hold no blocks."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_bytes, slices
from .dom_blocks import BITS, Block, blocks, feature, text_features

#: Words of classes and ids for each part of a page, by which layouts name their containers. Fixed values.
NAMES = {
    "main": "content,main,post,entry,article,story,post-content,entry-content,article-body,story-body,main-content,page-content,post-body,blog-post,text,mw-body,td-post-content,articleBody,single-post,prose",
    "menu": "nav,menu,navbar,navigation,topnav,main-menu,breadcrumb,breadcrumbs,site-nav,pagination,tabs,toc-links",
    "header": "header,masthead,site-header,top-bar,branding,banner,logo,page-header",
    "footer": "footer,site-footer,bottom,colophon,copyright,legal,page-footer,footer-links",
    "sidebar": "sidebar,aside,widget,related,recommended,related-posts,trending,most-read,side,right-column,teaser,promo-links,tag-cloud",
    "notice": "cookie,cookie-notice,cookie-banner,consent,gdpr,notice,alert,banner,popup,modal,overlay,paywall,message",
    "advert": "ad,ads,advert,advertisement,sponsored,sponsor,promo,promotion,ad-slot,adsbygoogle,banner-ad,native-ad",
    "form": "newsletter,subscribe,signup,search,search-form,login,contact-form,registration,poll",
    "comments": "comments,comment,comment-list,comment-body,comment-content,discussion,replies,reply,respond,disqus,user-comments,reactions",
    "share": "share,social,sharing,share-buttons,follow,social-links,author-box,byline-links,meta-links,print-link",
}
TAGS = {"main": "div article main section td", "menu": "nav div ul", "header": "header div", "footer": "footer div", "sidebar": "aside div section td", "notice": "div section aside", "advert": "div aside ins section", "form": "form", "comments": "div section ol article", "share": "div ul"}
NAMES, TAGS = {k: v.split(",") for k, v in NAMES.items()}, {k: v.split() for k, v in TAGS.items()}
#: Short texts of parts that aren't main. Fixed values.
PHRASES = {
    "menu": "Home|About us|Contact|News|Sports|Products|Login|Sign in|Archive|Accueil|Contact|Startseite|Kontakt|Inicio|Contacto|Next page|Previous|FAQ|Blog|Shop",
    "header": "Welcome|The daily site|Skip to content|Search|Menu|Language",
    "footer": "© 2023 All rights reserved.|Terms of use|Privacy policy|Impressum|Mentions légales|Aviso legal|Datenschutz|Powered by our system|Copyright 2019|Site map",
    "sidebar": "Related articles|Most read|Recent posts|Tags|You may also like|Popular now|À lire aussi|Mehr zum Thema|Te puede interesar",
    "notice": "We use cookies to improve your experience.|Accept all|Accept|Nous utilisons des cookies.|Diese Website verwendet Cookies.|Este sitio usa cookies.|Please enable JavaScript.|Subscribe to read more|This page is not available in your region.",
    "advert": "Advertisement|Sponsored content|Buy now|Special offer|Limited offer, 50 % off|Anzeige|Publicité|Publicidad|Click here",
    "form": "Your email|Subscribe|Sign up for our newsletter|Send|Search|Name|Password|Log in|Submit|Envoyer|Absenden",
    "comments": "Reply|Report|3 comments|Leave a comment|Posted by guest|Log in to comment|Kommentare|Commentaires|Comentarios|2 hours ago",
    "share": "Share|Tweet|Print|Email this|Follow us|Facebook|Teilen|Partager|Compartir",
}
PHRASES = {k: v.split("|") for k, v in PHRASES.items()}
_MAIN, _OUT = [feature(f"t:{t}") for t in ("article", "main")], [feature(f"t:{t}") for t in ("nav", "aside", "footer", "form")]
#: Words of classes inside an article whose blocks aren't of it.
_OUT += [feature(f"c:{w}") for w in ("ad", "ads", "advert", "advertisement", "comment", "comments", "cookie", "menu", "nav", "newsletter", "promo", "related", "share", "sidebar", "sponsored")]


@dataclass
class Chain:
    """Scores: ``weights`` by feature for label 1, ``move`` from label to label, ``start`` of the first label."""

    weights: np.ndarray
    move: np.ndarray
    start: np.ndarray


def marked(page: str) -> tuple[list[Block], list[int]] | None:
    """Blocks of a page and their labels by its markup; None if it says nothing."""
    found = list(blocks(page))
    if any(b.main for b in found):
        return found, [int(b.main) for b in found]
    labels = [int(any(f in b.features for f in _MAIN) and not any(f in b.features for f in _OUT)) for b in found]
    return (found, labels) if any(labels) else None


def layouts(texts: list[list[tuple[str, str]]], number: int, seed: int = 0) -> Iterator[str]:
    """Labelled pages: main blocks (tag, text) of ``texts`` in containers of random templates, marked ``data-main``."""
    rng = random.Random(seed)
    words = [w for group in PHRASES.values() for p in group for w in p.split()]
    invented = [[("p", " ".join(rng.choices(words, k=rng.randint(8, 60))) + rng.choice([".", ".", ".", "?", "!", ""])) for _ in range(rng.randint(2, 9))] for _ in range(50 if len(texts) < 50 else 0)]
    texts = [t for t in texts if t] + invented

    def prose() -> str:
        return escape(rng.choice(rng.choice(texts))[1])

    def opening(part: str, more: str = "") -> tuple[str, str]:
        tag = rng.choice(TAGS[part])
        name = rng.choice(NAMES[part])
        if part in ("menu", "header", "footer", "sidebar", "main") and tag not in ("div", "td", "ul", "section") and rng.random() < 0.5:
            return f"<{tag}{more}>", f"</{tag}>"
        key = rng.choice(["class", "class", "id"])
        extra = rng.choice(["", "", " box", " col-8", " wrap", " block-3"])
        if rng.random() < 0.3:
            name += f"-{rng.choice(['wrapper', 'container', 'inner', 'box', 'area', '1', 'list'])}"
        return f'<{tag} {key}="{name}{extra}"{more}>', f"</{tag}>"

    def heading(texts_of: list[str]) -> str:
        tag = f"h{rng.randint(2, 5)}"
        return f"<{tag}>{rng.choice(texts_of)}</{tag}>"

    def links(n: int, texts_of: list[str]) -> str:
        one = [f'<li><a href="/{i}">{escape(rng.choice(texts_of)) if rng.random() < 0.6 else " ".join(prose().split(" ")[: rng.randint(1, 9)])}</a></li>' for i in range(n)]
        return f"<ul>{''.join(one)}</ul>" if rng.random() < 0.7 else " ".join(x[4:-5] for x in one)

    def part(kind: str) -> str:
        a, b = opening(kind)
        said = PHRASES[kind]
        if kind in ("menu", "share"):
            inner = links(rng.randint(2, 9), said)
        elif kind == "comments":
            h = f"<h3>{rng.choice(said)}</h3>" if rng.random() < 0.6 else ""
            tag = rng.choice(["div", "li", "article"])
            one = [f'<{tag} class="{rng.choice(NAMES["comments"])}"><p>{prose()}</p>{rng.choice(["", f"<a href=#>{rng.choice(said)}</a>"])}</{tag}>' for _ in range(rng.randint(1, 5))]
            inner = h + "".join(one)
        elif kind == "form":
            inner = "".join(f"<{t}>{rng.choice(said)}</{t}>" for t in rng.choices(["label", "p", "button", "div"], k=rng.randint(1, 4)))
        else:
            inner = "".join(rng.choice([f"<p>{rng.choice(said)}</p>", rng.choice(said), heading(said), f"<p>{prose()}</p>", f"<div>{prose()}</div>", links(rng.randint(2, 6), said)]) for _ in range(rng.randint(1, 3)))
        return a + inner + b

    def body(main: list[tuple[str, str]]) -> str:
        a, b = opening("main", " data-main")
        inner = []
        for tag, text in main:
            tag = tag if tag in ("h1", "h2", "h3", "h4", "p", "li", "blockquote", "pre", "td") else rng.choice(["p", "p", "div"])
            open_tag, end = (f"<{tag}>", "</p>" if rng.random() < 0.1 and tag == "p" else f"</{tag}>")
            inner.append(f"{open_tag}{escape(text)}{end}")
        if rng.random() < 0.3:
            a, b = a + '<div class="inner">', "</div>" + b
        if inner and rng.random() < 0.3:  # a part that isn't main amid the blocks ends the marked container for a while
            k = rng.randrange(len(inner))
            plain = a.replace(" data-main", "")
            inner = [x.replace(">", " data-main>", 1) for x in inner]
            inner.insert(k, part(rng.choice(["advert", "share", "sidebar", "form", "notice"])))
            a = plain
        return a + "".join(inner) + b

    for _ in range(number):
        main = list(rng.choice(texts))
        main = [(rng.choice(["h1", "h2", "h3"]) if tag[:1] == "h" else tag, text) for tag, text in main]
        for k in [0, rng.randrange(len(main))]:
            if rng.random() < 0.5:
                main.insert(k, (rng.choice(["h1", "h2", "h2", "h3"]), " ".join(rng.choice(rng.choice(texts))[1].split(" ")[: rng.randint(1, 10)]).rstrip(".")))
        before = rng.sample(["header", "menu", "notice", "advert", "share", "sidebar"], rng.randint(1, 4))
        after = rng.sample(["comments", "sidebar", "share", "footer", "form", "advert", "menu"], rng.randint(1, 5))
        if rng.random() < 0.6:
            after.append("footer")
        yield "<html><body>" + rng.choice(["", '<div class="container">', "<div>"]) + "".join(map(part, before)) + body(main) + "".join(map(part, after)) + "</body></html>"


def _sequences(pages: list[tuple[list[Block], list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of all blocks one after the other, where each block's begin, labels, and the pages' lengths."""
    flat, starts, labels = [], [], []
    for found, own in pages:
        for k, b in enumerate(found):
            starts.append(len(flat))
            flat += [*b.features, *text_features(b, k)]
        labels += own
    return np.array(flat, np.int64), np.array(starts, np.int64), np.array(labels, np.float64), np.array([len(own) for _, own in pages])


def marginals(scores: np.ndarray, lengths: np.ndarray, chain: Chain) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (pages, positions) scores: the probability of label 1, summed probabilities of moves, of first labels."""
    pages, width = scores.shape
    unary = np.stack([np.zeros_like(scores), scores], axis=2)
    ahead, back = np.empty((pages, width, 2)), np.zeros((pages, width, 2))
    ahead[:, 0] = chain.start + unary[:, 0]
    for t in range(1, width):
        ahead[:, t] = np.logaddexp(ahead[:, t - 1, :1] + chain.move[0], ahead[:, t - 1, 1:] + chain.move[1]) + unary[:, t]
    last = lengths - 1
    for t in range(width - 2, -1, -1):
        step = unary[:, t + 1] + back[:, t + 1]
        own = np.logaddexp(chain.move[:, 0] + step[:, :1], chain.move[:, 1] + step[:, 1:])
        back[:, t] = np.where((t < last)[:, None], own, 0.0)
    total = np.logaddexp(*ahead[np.arange(pages), last].T)
    single = np.exp(ahead + back - total[:, None, None])
    inside = np.arange(1, width) < lengths[:, None]
    pair = ahead[:, :-1, :, None] + chain.move + (unary + back)[:, 1:, None, :] - total[:, None, None, None]
    moves = np.exp(np.where(inside[:, :, None, None], pair, -np.inf)).sum(axis=(0, 1))
    return single[:, :, 1], moves, single[:, 0].sum(axis=0)


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 120, rate: float = 0.15, decay: float = 1e-4, groups: int = 12) -> Chain:
    """Maximum likelihood with a quadratic penalty, by full gradients with moment estimates; pages are padded to
    the longest of about as many of their length."""
    flat, starts, labels, lengths = _sequences(sorted((p for p in pages if p[0]), key=lambda p: len(p[0])))
    n = len(lengths)
    counts = np.diff(np.append(starts, len(flat)))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    cuts = np.unique(np.linspace(0, n, groups + 1).astype(int))
    padded = []  # of each group: its lengths, which blocks, and where they stand in a matrix of the group
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own, width = lengths[a:b], int(lengths[b - 1])
        inside = np.arange(begins[a], ends[b - 1])
        padded.append((own, width, inside, np.repeat(np.arange(b - a) * width, own) + inside - np.repeat(begins[a:b], own)))
    y = labels.astype(int)
    inner = np.setdiff1d(np.arange(1, len(y)), ends)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1], y[inner]), 1)
    first = np.bincount(y[ends - lengths], minlength=2)
    size = 1 << BITS
    theta, m, v = np.zeros(size + 6), np.zeros(size + 6), np.zeros(size + 6)
    for turn in range(1, rounds + 1):
        chain = Chain(theta[:size], theta[size : size + 4].reshape(2, 2), theta[size + 4 :])
        scores = np.add.reduceat(chain.weights[flat], starts)
        error, moves, begin = labels.copy(), np.zeros((2, 2)), np.zeros(2)
        for own, width, inside, place in padded:
            matrix = np.zeros(len(own) * width)
            matrix[place] = scores[inside]
            p, a, b = marginals(matrix.reshape(-1, width), own, chain)
            error[inside] -= p.ravel()[place]
            moves, begin = moves + a, begin + b
        slope = np.concatenate([np.bincount(flat, np.repeat(error, counts), size), (seen - moves).ravel(), first - begin]) / len(y) - decay * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Chain(theta[:size].astype(np.float32), theta[size : size + 4].reshape(2, 2), theta[size + 4 :])


def learn(pages: DataFrame, number: int = 400, page_bytes: int = 65_536, laid_out: int = 1200, seed: int = 0) -> Chain:
    """Fit on at most ``number`` pages of the table, drawn by hash, and on ``laid_out`` labelled layouts of their texts."""
    rows = pages.select(F.col("html").cast("string").alias("html")).filter(F.octet_length("html") <= page_bytes)
    share = min(1.0, 4 * number / max(1, rows.count()))  # so that tasks send about four times the sample, however many they are
    rows = rows.withColumn("h", F.xxhash64("html", F.lit(seed))).filter(F.pmod("h", F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    drawn = rows.dropDuplicates(["h"]).orderBy("h").limit(number).collect()
    own = [m for m in (marked(r["html"]) for r in drawn) if m]
    texts = [[(b.tag, b.text) for b, y in zip(*m, strict=True) if y] for m in own]
    anew = [m for m in (marked(page) for page in layouts(texts, laid_out, seed)) if m]
    return fit(own + anew)


def viterbi(scores: list[float], chain: Chain) -> list[int]:
    """The likeliest labels of a chain."""
    if not scores:
        return []
    (stay, enter), (leave, go_on) = chain.move.tolist()
    a, b = chain.start.tolist()
    b += scores[0]
    back = []
    for s in scores[1:]:
        to_0, to_1 = b + leave > a + stay, b + go_on >= a + enter
        back.append((to_0, to_1))
        a, b = max(a + stay, b + leave), max(a + enter, b + go_on) + s
    label = int(b >= a)
    out = [label]
    for step in reversed(back):
        label = int(step[label])
        out.append(label)
    return out[::-1]


def main_text(page: str, chain: Chain, weights: list[float] | None = None) -> str:
    weights = chain.weights.tolist() if weights is None else weights
    found, scores = [], []
    for k, b in enumerate(blocks(page, weights)):
        found.append(b.text)
        scores.append(b.score + sum([weights[f] for f in text_features(b, k)]))
    return "\n".join(t for t, y in zip(found, viterbi(scores, chain), strict=True) if y)


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    batch_bytes(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = chain.weights.tolist()
        for batch in slices(batches, "html"):
            texts = [main_text(page, chain, weights) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(apply, schema)
