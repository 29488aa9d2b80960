"""Web pages as sequences of leaf blocks: text with the path of elements around it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements that begin a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that an opening tag of the same kind closes.
CLOSED_BY_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: A paragraph goes on inside these only if it began there.
HOLDS = frozenset("article aside body div dd details dialog fieldset figure footer form header html li main nav section table td th ul ol dl".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|iframe)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Leaf:
    path: tuple[str, ...]
    text: str
    linked: int
    """Characters inside links."""


def _tokens(name: str, attributes: str) -> tuple[str, ...]:
    found = [name]
    if "=" in attributes:
        for _, double, single, bare in MARKED.findall(attributes):
            found += [f".{w}" for w in WORDS.findall((double or single or bare).lower())]
    return tuple(found)


def leaves(page: str) -> list[Leaf]:
    """Blocks in page order, character references decoded, white space runs one space, no empty ones.

    Scripts, styles, form texts, frames, comments and tags are gone; those elements hold raw
    text up to their end tag or the end of the page, also for browsers. Text of formulas,
    drawings and fallbacks stays. Unclosed and stray tags are taken as browsers take them where
    that changes a block.
    """
    found: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append(Leaf(stack[-1][1] if stack else (), text, linked))
            parts.clear()
        linked = 0

    def close(names: set[str] | frozenset[str]) -> None:
        """Close the innermost of ``names`` unless an element that holds its own blocks lies between."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in HOLDS:
                return

    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            text = page[at : token.start()]
            parts.append(text)
            linked += len(text) if in_link else 0
        at = token.end()
        name = (token[3] or token[6] or "").lower()
        if not name:
            continue
        ending = bool(token[2] or token[5])
        if name == "a":
            in_link = not ending
        elif name == "br":
            parts.append(" ")
        elif name == "hr":
            flush()
        elif name in BLOCKS:
            flush()
            if ending:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
            else:
                close({"p"})
                if name in CLOSED_BY_OWN:
                    close(CLOSED_BY_OWN[name])
                above = stack[-1][1] if stack else ()
                stack.append((name, above + _tokens(name, token[4] or token[7] or "")))
    parts.append(page[at:])
    flush()
    return found
