"""Main text of web pages by block rules in two passes.

A page is cut into blocks at block-level elements. Menus, headers, footers, sidebars, notices,
adverts, forms, comments of readers, scripts and styles are left out by element, role, class or
id. The first pass labels what is left: link-dense blocks are bad, long blocks are good or bad by
their share of function words, of which a block inside ``article`` or ``main`` needs less, and short
ones are undecided. In the second pass an undecided block inherits the label of its nearest decided
neighbour on its side of ``article`` or ``main``, the one before on equal distance; without any it is
bad outside. Inside, where no block is good by its words, all that are not link-dense are good.

Each page is handled on its own inside a task; there is no shuffle.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import pieces
from curbstar.llm.quality import FUNCTION_WORDS

LONG_CHARS = 140
GOOD_FUNCTION_SHARE = 0.15
#: Inside ``article`` or ``main`` a long block is bad only below this share.
LEAST_FUNCTION_SHARE = 0.03
MOST_LINK_SHARE = 0.5

# HTML's element kinds, and names by which pages mark what is not the article.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes noscript xmp template svg math".split())
SKIP_TAGS = frozenset("nav header footer aside form head button select dialog menu object canvas audio video datalist".split())
MAIN_TAGS = frozenset(("article", "main"))
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SKIP_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside widget footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login "
    "comment comments disqus respond replies share sharing social related recommended".split()
)

#: Containers of other texts: an ``article`` inside is a comment or a card, not the page's.
HELD_NAMES = frozenset("comment comments disqus respond replies sidebar aside widget related recommended".split())

_TAG = re.compile(r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_FUNCTION = frozenset(FUNCTION_WORDS)


@dataclass
class Block:
    text: str
    link_chars: int
    in_main: bool
    in_list: bool


def _marked(attributes: str) -> bool:
    """Whether class, id or role names something that is not the article."""
    if _HIDDEN.search(attributes):
        return True
    for name, *values in _NAMED.findall(attributes):
        value = html.unescape("".join(values)).lower()
        if name.lower() == "role":
            if value.strip() in SKIP_ROLES:
                return True
        elif any(part in SKIP_NAMES for part in re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def _held(attributes: str) -> bool:
    """Whether a class or id begins with a name of ``HELD_NAMES``; ``with-sidebar`` names a layout."""
    values = [html.unescape("".join(v)).lower() for name, *v in _NAMED.findall(attributes) if name.lower() != "role"]
    return any(re.split(r"[^a-z0-9]+", token)[0] in HELD_NAMES for value in values for token in value.split())


def blocks_of(page: str) -> list[Block]:
    """The page's blocks outside skipped elements, white space made single spaces."""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements, whether they are skipped, and for good
    links = 0
    at, size = 0, len(page)

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                linked = sum(len("".join(t.split())) for t, in_link in pieces if in_link)
                names = {name for name, *_ in stack}
                out.append(Block(text, linked, bool(names & MAIN_TAGS), "li" in names))
            pieces.clear()

    def add(text: str) -> None:
        if text and not any(skip for _, skip, _ in stack):
            pieces.append((html.unescape(text), links > 0))

    while at < size:
        tag = _TAG.search(page, at)
        if not tag:
            add(page[at:])
            break
        add(page[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name, closing = tag[2].lower(), bool(tag[1])
        if name in RAW_TAGS and not closing:
            if not tag[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if name == "a":
            links = max(0, links - 1) if closing else 1
        elif name == "br":
            pieces.append((" ", False))
        if name in BLOCK_TAGS or name in SKIP_TAGS:
            close_block()
        if name in VOID_TAGS:
            continue
        if closing:
            if any(name == open_name for open_name, *_ in stack):
                if name in BLOCK_TAGS:
                    links = 0
                while stack.pop()[0] != name:
                    pass
        elif name in BLOCK_TAGS or name in SKIP_TAGS or _marked(tag[3]):
            # A paragraph ends where a block begins, and no skipped element swallows the article.
            if stack and stack[-1][0] == "p" and name in BLOCK_TAGS:
                stack.pop()
            if name in MAIN_TAGS and not _marked(tag[3]):
                stack[:] = [(n, s and (n in MAIN_TAGS or (held and name != "main")), held) for n, s, held in stack]
            in_main = any(n in MAIN_TAGS for n, *_ in stack)
            skip = name in SKIP_TAGS and not (name == "header" and in_main)
            marked = name not in ("html", "body") and _marked(tag[3])
            stack.append((name, skip or marked, marked and _held(tag[3])))
    close_block()
    return out


def labelled(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    out = [False] * len(blocks)
    for side in (True, False):
        own = [i for i, b in enumerate(blocks) if b.in_main == side]
        labels = {i: _first_label(blocks[i]) for i in own}
        if side and True not in labels.values():
            # No function words anywhere: another language or a table, of which density says nothing.
            labels = {i: _linked(blocks[i]) <= MOST_LINK_SHARE for i in own}
        decided = [i for i in own if labels[i] is not None]
        k = 0
        for i in own:
            while k < len(decided) and decided[k] < i:
                k += 1
            label = labels[i]
            if label is None:
                near = decided[max(0, k - 1) : k + 1]
                label = labels[min(near, key=lambda j: abs(j - i))] if near else side
            out[i] = bool(label)
    return out


def _linked(block: Block) -> float:
    return block.link_chars / max(1, len(block.text.replace(" ", "")))


def _first_label(block: Block) -> bool | None:
    if _linked(block) > MOST_LINK_SHARE:
        return False
    if len(block.text) < LONG_CHARS:
        return None
    words = _LETTERS.findall(block.text.lower())
    least = LEAST_FUNCTION_SHARE if block.in_main else GOOD_FUNCTION_SHARE
    return sum(w in _FUNCTION for w in words) >= least * len(words)


def main_text(page: str | None) -> tuple[str, int, int]:
    """(text, blocks, blocks kept)."""
    blocks = blocks_of(page or "")
    kept = [b.text for b, good in zip(blocks, labelled(blocks), strict=True) if good]
    return "\n\n".join(kept), len(blocks), len(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "html"):
            found = [main_text(page) for page in piece.column("html").to_pylist()]
            texts, n_blocks, n_kept = (list(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(n_blocks, pa.int64()), pa.array(n_kept, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
            )


def extracted_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars, n_blocks, n_kept.

    A null or empty page has an empty text. Character references are decoded once. A page that is
    cut off ends its open elements there. Repeated rows give repeated results; other columns are
    ignored; an empty table gives an empty result.
    """
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    return own.mapInArrow(_extract, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
