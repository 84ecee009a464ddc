"""Leaf blocks of HTML pages: the text between block boundaries with the open elements around it."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(?P<end>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*+)(?P<rest>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)|(?P<text>[^<]++)|<""", re.S
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))""", re.I)
#: Elements whose content is no markup, elements without content, and elements that start and end a block.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "template", "svg", "math", "object"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open element of the same group within the nearest of the fences.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCES = {"ul", "ol", "menu", "dl", "table", "select", "div", "article", "section", "main", "body", "aside", "nav", "header", "footer", "form"}
#: Open elements whose features are kept; of deeper ones only the number is.
DEEPEST = 256


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, str], ...]  # (tag, class and id words) from the root down
    linked: int  # characters within links


def blocks(html: str | None) -> list[Block]:
    """Blocks in page order. Character references are decoded, white space within a block becomes one
    blank, empty blocks are left out. Unclosed and stray tags are taken as browsers mostly do."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    links = linked = 0
    html = html or ""
    at, size = 0, len(html)
    beyond: Counter[str] = Counter()  # open elements deeper than DEEPEST
    unclosed: set[str] = set()  # elements without markup inside of which no end tag follows

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, tuple(stack), min(linked, len(text))))
            parts, linked = [], 0

    def pop(k: int):
        nonlocal links
        if any(t in BLOCK for t, _ in stack[k:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[k:])
        del stack[k:]
        beyond.clear()

    while at < size:
        m = TOKEN.match(html, at)
        at = m.end() if m else at + 1
        if not m:
            continue
        text = m["text"]
        if text is None and m[0] == "<":
            text = "<"
        if text is not None:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            linked += len(text.strip()) if links else 0
            continue
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            if beyond[name]:
                beyond[name] -= 1
                if name in BLOCK:
                    flush()
                continue
            k = len(stack) - 1
            while k >= 0 and stack[k][0] != name:
                if stack[k][0] in FENCES and name not in FENCES:
                    k = -1
                    break
                k -= 1
            if k >= 0:
                pop(k)
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at) if name not in unclosed and (not m["rest"].rstrip().endswith("/") or name in ("script", "style", "title", "textarea")) else None
            if close is None and not m["rest"].rstrip().endswith("/"):
                unclosed.add(name)
            if close:
                at = close.end()
            elif name in ("script", "style", "title", "textarea", "xmp"):
                at = size
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "wbr"):
                parts.append(" " if name == "br" else "")
            continue
        if name in BLOCK:
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p" or stack[i][0] in FENCES), -1)
            if k >= 0 and stack[k][0] == "p":  # a block ends an open paragraph
                pop(k)
            group = CLOSES.get(name)
            if group:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in group:
                        pop(i)
                        break
                    if stack[i][0] in FENCES and not (name == "tr" and stack[i][0] in ("tbody", "thead", "tfoot")):
                        break
            flush()
        if len(stack) < DEEPEST:
            words = ""
            if m["rest"]:
                words = " ".join((a[1] or a[2] or a[3]) for a in ATTRIBUTE.findall(m["rest"])) if "=" in m["rest"] else ""
            stack.append((name, words))
            links += name == "a"
        else:
            beyond[name] += 1
    flush()
    return out
