"""Leaf blocks of an HTML page: the runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# fixed values: element names of the HTML standard, by their role here
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
SILENT_TAGS = frozenset("script style template noscript iframe object svg math canvas audio video".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# an open element that the start of another closes
CLOSED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
}

# A comment, a tag or another declaration. A quoted value may hold ``>``; a quote that never ends is no quote.
# Nothing is given back once matched, and an open end matches too: each character is looked at a bounded
# number of times.
TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?P<end>>|\Z)"""
    r"""|[!?/][^>]*+(?P<other>>|\Z))""",
    re.DOTALL,
)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PIECE = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: tuple  # (tag, names in class, id and role) of each ancestor, outermost first
    text: str
    linked: int  # characters inside links


def leaf_blocks(html: str | None) -> list[Block]:
    """In page order, with character references decoded and white space made single spaces."""
    found: list[Block] = []
    if not html:
        return found
    stack: list[tuple] = []
    pieces: list[str] = []
    in_link = linked = 0

    def text_until(end: int, begin: int) -> None:
        nonlocal linked
        if end > begin:
            piece = html[begin:end]
            if "&" in piece:
                piece = unescape(piece)
            pieces.append(piece)
            if in_link:
                linked += len(piece)

    def close_block() -> None:
        nonlocal linked, in_link
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                found.append(Block(tuple(stack), text, linked))
            pieces.clear()
        linked = in_link = 0

    at, size = 0, len(html)
    while at < size:
        tag = TAG.search(html, at)
        if tag is None:
            text_until(size, at)
            break
        if "" in (tag["end"], tag["other"]):  # never closed: text to the page's end
            text_until(size, at)
            break
        text_until(tag.start(), at)
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        closing = bool(tag["close"])
        if name in SILENT_TAGS:
            if not closing and not tag["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = end.end() if end else size
        elif name == "a":
            in_link = 0 if closing else 1
        elif name in ("br", "wbr"):
            if name == "br":
                pieces.append(" ")
        elif name in BLOCK_TAGS:
            close_block()
            if closing:
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
                if depth >= 0:
                    del stack[depth:]
            else:
                if stack and stack[-1][0] == "p":
                    stack.pop()  # a paragraph holds no blocks
                ends = CLOSED_BY.get(name)
                while ends and stack and stack[-1][0] in ends:
                    stack.pop()
                if name not in VOID_TAGS:
                    values = " ".join(a or b or c for a, b, c in NAMED.findall(tag["rest"])) if tag["rest"] else ""
                    stack.append((name, tuple(sorted(set(PIECE.findall(values.lower()))))))
    close_block()
    return found
