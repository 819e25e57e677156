"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text at block-level tags. The first pass decides blocks: containers
that are never article text decide by structure; otherwise length, link density and stop-word
density do, inside an article link density alone. Class and id words count only where they make up a
whole name, and not for an element that holds the page's article or most of its text. The second pass gives each undecided block the label of its nearest decided
neighbours. The text between tags is handled piece by piece; a page is one row's work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spendlake.llm.common import map_arrow
from spendlake.llm.quality import STOP_WORDS

SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP_SHARE = 0.1
HIGH_STOP_SHARE = 0.2
MAX_LINK_SHARE = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][-\w:]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: Closed by the next block of any kind, whether or not the page says so.
_SHORT_LIVED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "li", "option", "td", "th", "tr"}
_NEVER = set("nav aside footer form head menu button select dialog svg math template object canvas audio video".split())
_ALWAYS = {"article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Inside an article these may be all links.
_MAY_LINK = _HEADINGS | {"td", "th", "caption", "figcaption"}
_NEVER_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NEVER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay menu menus nav navbar navigation navi breadcrumb breadcrumbs "
    "sidebar widget widgets footer footnav masthead topbar comment comments commentlist disqus reply replies respond "
    "share sharing social related recommended recommendations subscribe subscription newsletter signup login search "
    "searchbox pagination pager copyright toolbar skip".split()
)
#: Words that may stand beside those in a name without changing what it says.
_NEUTRAL_NAMES = set(
    "list lists item items body container wrapper wrap box block area left right top bottom bar inner outer div link "
    "links button buttons icon icons form site page primary secondary".split()
)
_COMMENT_NAMES = {"comment", "comments", "commentlist", "reply", "replies", "respond", "disqus"}
_STOP = frozenset(STOP_WORDS)


class Block(NamedTuple):
    text: str
    link_chars: int
    never: bool
    always: bool
    tag: str = ""


class _Named:
    """An element whose name says that it holds no article text; what it holds may say otherwise."""

    def __init__(self, parent: _Named | None, comments: bool, around: int):
        self.parent, self.comments, self.around = parent, comments, around
        self.chars = self.articles = 0
        self.never = True

    def settle(self, chars: int, articles: int) -> None:
        """Against the page's text and its articles: one around this element is no other article."""
        others = articles - self.articles - (0 if self.comments else self.around)
        holds = others <= 0 and (self.articles > 0 or (not self.comments and 2 * self.chars > chars))
        self.never = not holds or (self.parent is not None and self.parent.never)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)}


def _has_name(attributes: dict[str, str], listed: set[str]) -> bool:
    """Whether a class or the id consists of listed words, and neutral ones beside them."""
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = {p.lower() for p in _NAME_PART.findall(name)}
        if words & listed and words <= listed | _NEUTRAL_NAMES:
            return True
    return False


def _is_never(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element holds no article text whatever its words are."""
    if tag in _NEVER or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return _has_name(attributes, _COMMENT_NAMES)
    style = attributes.get("style", "").replace(" ", "").lower()
    return (
        attributes.get("role", "").lower() in _NEVER_ROLES
        or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
    )


def _is_named(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element's class or id says that it holds no article text; a heading's is an anchor."""
    if not attributes or tag in ("html", "body", "main", "article") or tag in _HEADINGS:
        return False
    return _has_name(attributes, _NEVER_NAMES if in_article else _NEVER_NAMES | {"header"})


def blocks(html: str) -> list[Block]:
    """Blocks of text in page order, with what their containers say."""
    out: list[Block] = []
    holders: list[_Named | None] = []  # of each block, the innermost named element
    named: list[_Named] = []
    articles = 0
    stack: list[tuple[str, bool, bool, _Named | None, int]] = []  # tag, never, always, named, articles around
    parts: list[str] = []
    link_parts: list[str] = []
    links, breaks, at = 0, 0, 0

    def state() -> tuple[bool, bool, _Named | None, int]:
        return stack[-1][1:] if stack else (False, False, None, 0)

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                link = len(" ".join(unescape(" ".join(link_parts)).split()))
                out.append(Block(text, link, *state()[:2], stack[-1][0] if stack else ""))
                holders.append(state()[2])
            parts.clear()
            link_parts.clear()

    while at < len(html):
        match = _TOKEN.search(html, at)
        piece = html[at : match.start()] if match else html[at:]
        if piece:
            parts.append(piece)
            if links:
                link_parts.append(piece)
            if piece.strip():
                breaks = 0
        if not match:
            break
        at = match.end()
        if not match[2]:
            continue
        tag, closing = match[2].lower(), bool(match[1])
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
            continue
        if tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
            continue
        if tag in _RAW and not closing:
            end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in _BLOCK:
            flush()
            links = 0
            if not closing or tag not in _SHORT_LIVED:
                while stack and stack[-1][0] in _SHORT_LIVED and not (closing and stack[-1][0] == tag):
                    stack.pop()
            if tag == "body":
                while stack and stack[-1][0] == "head":
                    stack.pop()
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                flush()
                del stack[depth:]
        elif tag not in _VOID:
            never, always, holder, around = state()
            attributes = _attributes(match[3]) if match[3].strip() else {}
            own = _is_never(tag, attributes, always)
            if not own and _is_named(tag, attributes, always):
                flush()
                holder = _Named(holder, _has_name(attributes, _COMMENT_NAMES), around)
                named.append(holder)
            if tag in _ALWAYS and not never and not own:
                articles, around = articles + 1, around + 1
                if holder:
                    holder.articles += 1
            if tag in _BLOCK or tag in _NEVER or own or holder is not state()[2]:
                if own:
                    flush()
                stack.append((tag, never or own, always or tag in _ALWAYS, holder, around))
    flush()
    if not named:
        return out
    for block, holder in zip(out, holders):
        if holder and not block.never:
            holder.chars += len(block.text)
    for one in reversed(named):
        if one.parent:
            one.parent.chars += one.chars
            one.parent.articles += one.articles
    chars = sum(len(block.text) for block in out if not block.never)
    for one in named:
        one.settle(chars, articles)
    return [b._replace(never=True) if h and h.never else b for b, h in zip(out, holders)]


def _in_article(block: Block) -> bool:
    """A block inside an article is its text unless it is mostly links."""
    return block.link_chars <= MAX_LINK_SHARE * len(block.text) or block.tag in _MAY_LINK


def _first_pass(block: Block) -> bool | None:
    """True for article text, false for none, null while undecided."""
    if block.never:
        return False
    if block.always:
        return _in_article(block)
    chars = len(block.text)
    if block.link_chars > MAX_LINK_SHARE * chars or "©" in block.text:
        return False
    if chars < SHORT_CHARS:
        return None
    words = block.text.lower().split()
    stop = sum(w.strip(".,;:!?\"'()") in _STOP for w in words) / len(words)
    if stop >= HIGH_STOP_SHARE or (stop >= LOW_STOP_SHARE and chars >= LONG_CHARS):
        return True
    return None if stop >= LOW_STOP_SHARE else False


def classify(page: list[Block]) -> list[bool]:
    """Second pass: undecided blocks take their nearest decided neighbour's label; at equal distance
    one that is article text is enough. A page that decides nothing is all article text.

    An article that is nothing but links stays.
    """
    inside = [b for b in page if b.always and not b.never]
    labels = [_first_pass(block) for block in page]
    if inside and not any(map(_in_article, inside)):
        labels = [not b.never if b.always else label for b, label in zip(page, labels)]
    if all(x is None for x in labels):
        return [True] * len(page)
    decided = np.array([i for i, x in enumerate(labels) if x is not None])
    out = []
    for i, label in enumerate(labels):
        if label is None:
            k = int(np.searchsorted(decided, i))
            before, after = (decided[k - 1] if k else None), (decided[k] if k < len(decided) else None)
            if before is None or (after is not None and after - i < i - before):
                label = labels[after]
            elif after is None or i - before < after - i:
                label = labels[before]
            else:
                label = labels[before] or labels[after]
        out.append(bool(label))
    return out


def main_text(html: str) -> str:
    """Article text of a page, blocks apart by an empty line; empty if there is none."""
    page = blocks(html)
    return "\n\n".join(b.text for b, good in zip(page, classify(page)) if good)


def _text_batches(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x or "") for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    Null, empty and text-free pages give an empty text; broken or cut-off markup never fails, the
    rest of an unclosed script or comment is not text. Repeated rows and null ids keep their rows;
    further columns are ignored; an empty table gives no rows.
    """
    return pages.select("page_id", "url", "html").transform(
        map_arrow, _text_batches, "page_id long, url string, text string, n_chars long"
    )
