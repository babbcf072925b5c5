"""Leaf blocks of a page: runs of text between the starts and ends of block elements, with what their ancestors say.

A scan over tags with a stack, linear in the page: what an element adds to a block (its tag, words of its class, id and
role) is counted when it opens and taken back when it closes, so nothing is looked up through all ancestors."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html import unescape
from zlib import crc32

BITS = 16
#: Elements that begin and end blocks. Fixed values.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is no text of the page. Fixed values.
SKIPPED = frozenset("canvas iframe math noembed noframes object script style svg template textarea title xmp".split())
#: Elements without an end. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a start tag ends, and the elements that this doesn't reach beyond. Fixed values.
ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
#: Tags that say nothing of what they hold.
_PLAIN = frozenset("html body div span b i em strong font center u small p br".split())

_TAG = re.compile(r"""<(?:!--|(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|[!?][^>]*>)""")
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style|data-main)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NOT_LETTERS = re.compile(r"[^a-z]+")


@lru_cache(1 << 16)
def feature(name: str) -> int:
    return crc32(name.encode("utf-8", "replace")) & ((1 << BITS) - 1)


def element_features(tag: str, attributes: str) -> tuple[tuple[int, ...], bool]:
    """What an element says of the blocks in it, and whether it is marked as main text (in labelled pages)."""
    names, main = [] if tag in _PLAIN else [f"t:{tag}"], False
    for key, value in _NAMED.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "data-main":
            main = True
        elif key == "style":
            names += ["hidden"] * ("display:none" in value.replace(" ", "").lower())
        elif key in ("hidden", "aria-hidden"):
            names += ["hidden"] * (value.lower() != "false")
        else:
            kind = "r" if key == "role" else "c"
            names += [f"{kind}:{w}" for w in _NOT_LETTERS.split(_HUMP.sub(" ", value).lower()) if len(w) > 1]
    return tuple(dict.fromkeys(feature(n) for n in names)), main


class _Open:
    __slots__ = ("features", "main", "score", "tag")

    def __init__(self, tag: str, features: tuple[int, ...], score: float, main: bool):
        self.tag, self.features, self.score, self.main = tag, features, score, main


#: Of an element text and its attributes as written; emptied when it has grown.
_known: dict[tuple[str, str], tuple[tuple[int, ...], bool]] = {}


class Block:
    """``score`` is the sum of the ancestors' weights; ``features`` are listed only if no weights were given."""

    __slots__ = ("features", "linked", "main", "score", "tag", "text")

    def __init__(self, text: str, linked: float, tag: str, score: float, features: tuple[int, ...], main: bool):
        self.text, self.linked, self.tag, self.score, self.features, self.main = text, linked, tag, score, features, main


def blocks(html: str, weights: Sequence[float] | None = None) -> Iterator[Block]:
    """The page's blocks in order; white space is one space, character references are decoded."""
    stack, counts, names = [_Open("", (), 0.0, False)], {}, {}
    pieces: list[str] = []
    anchors = linked = 0
    at = 0

    def close() -> None:
        nonlocal anchors
        gone = stack.pop()
        names[gone.tag] -= 1
        anchors -= gone.tag == "a"
        for f in gone.features:
            counts[f] -= 1
            if not counts[f]:
                del counts[f]

    def close_to(tags: frozenset[str], stop: frozenset[str]) -> None:
        """Close the innermost of ``tags`` and what is open in it, unless one of ``stop`` lies between."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                while len(stack) > k:
                    close()
                return
            if stack[k].tag in stop:
                return

    def taken() -> Block | None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        share, linked = min(1.0, linked / len(text)) if text else 0.0, 0
        pieces.clear()
        if not text:
            return None
        tag = next((o.tag for o in reversed(stack) if o.tag in BLOCK), "")
        return Block(text, share, tag, stack[-1].score, () if weights is not None else tuple(counts), stack[-1].main)

    def said(text: str) -> None:
        nonlocal linked
        text = unescape(text) if "&" in text else text
        pieces.append(text)
        if anchors:
            linked += len(text)

    position = 0
    for m in iter(lambda: _TAG.search(html, position), None):
        if m.start() > at:
            said(html[at : m.start()])
        at = position = m.end()
        end, tag = m[1], (m[2] or "").lower()
        if not tag:
            if m[0] == "<!--":
                at = position = _after(html, "-->", position)
            continue
        if tag in SKIPPED and not end:
            if not m[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                found = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, position)
                at = position = found.end() if found else len(html)
            continue
        if tag in BLOCK or tag == "br":
            if tag == "br":
                pieces.append(" ")
                continue
            block = taken()
            if block:
                yield block
        if end:
            if names.get(tag):
                close_to(frozenset((tag,)), frozenset())
            continue
        if tag in VOID:
            continue
        if tag in ENDS:
            close_to(*ENDS[tag])
        elif tag in BLOCK and names.get("p"):
            close_to(frozenset("p"), BLOCK - {"p"})
        own = _known.get((tag, m[3]))
        if own is None:
            if len(_known) > 20_000:
                _known.clear()
            own = _known[tag, m[3]] = element_features(tag, m[3])
        score = stack[-1].score
        for f in own[0]:
            if f in counts:
                counts[f] += 1
            else:
                counts[f] = 1
                if weights is not None:
                    score += weights[f]
        names[tag] = names.get(tag, 0) + 1
        anchors += tag == "a"
        stack.append(_Open(tag, own[0], score, own[1] or stack[-1].main))
    if at < len(html):
        said(html[at:])
    block = taken()
    if block:
        yield block


def _after(html: str, mark: str, position: int) -> int:
    """What is never closed goes on to the end."""
    found = html.find(mark, position)
    return len(html) if found < 0 else found + len(mark)


_WORDS, _DIGITS = re.compile(r"\w+"), re.compile(r"\d")


def text_features(block: Block, index: int) -> list[int]:
    """What the text itself says: lengths, links, punctuation, and the words of short blocks."""
    text = block.text
    words = text.count(" ") + 1
    head = text[-1]
    names = [f"n:{words.bit_length()}", f"l:{int(block.linked * 4)}:{min(words.bit_length(), 4)}", f"b:{block.tag}", f"i:{min(index, 3)}", f"e:{head if not head.isalnum() else 'w'}", f"k:{min(text.count(', ') * 8 // words, 4)}"]
    if words <= 12:
        names += [f"w:{w}" for w in _WORDS.findall(text.lower())]
        names.append(f"d:{min(len(_DIGITS.findall(text)) * 8 // len(text), 4)}")
        if "©" in text:
            names.append("copyright")
    return [feature(n) for n in dict.fromkeys(names)]
