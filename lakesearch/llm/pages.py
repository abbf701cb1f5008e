"""HTML pages as a sequence of leaf blocks, and labelled pages to learn from."""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template title svg math iframe object audio video canvas".split())
RAW = frozenset("script style title noscript iframe template textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES = {
    "p": frozenset({"p"}), "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}), "option": frozenset({"option"}),
}
BARRIERS = frozenset("ul ol dl table select div article section main aside body nav form footer header td".split())
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)

TOKEN = re.compile(r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s=/])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
MARK = "data-main"


@dataclass
class Block:
    """Text between two block boundaries, and where it stands."""

    text: str
    linked: int  # characters inside links
    tags: tuple[str, ...]  # open elements, outermost first
    names: frozenset[str]  # words of their classes, ids and roles
    main: bool = False  # in labelled pages: inside a marked element


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order. Tag soup is read as browsers do, roughly; null has none.

    Inline elements do not end a block, all others and line breaks do. Comments and
    the contents of elements that show no text are left out. Character references are
    decoded and white space becomes single spaces.
    """
    if not isinstance(page, str):
        return []
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str], bool, bool]] = []  # tag, names so far, marked, silent
    parts: list[str] = []
    linked, links, at, end = 0, 0, 0, len(page)

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not (stack and stack[-1][3]):
            parts.append(piece)
            if links:
                linked += len(piece.strip())

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack[-1] if stack else ("", frozenset(), False, False)
                out.append(Block(text, min(linked, len(text)), tuple(s[0] for s in stack), top[1], top[2]))
            parts.clear()
        linked = 0

    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, attributes = name.lower(), found[3] or found[6] or ""
        if found[1] or found[4]:
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1)
                continue
            if any(s[0] == tag for s in stack):
                close_block()
                while stack.pop()[0] != tag:
                    pass
                links = 0
            continue
        if tag in INLINE:
            if tag == "a":
                links = 1
            continue
        if tag == "br" or tag in VOID:
            if tag in ("br", "hr"):
                close_block()
            continue
        close_block()
        links = 0
        implied = CLOSES.get(tag, frozenset({"p"}) if tag in PARAGRAPH_ENDS else frozenset())
        while stack and stack[-1][0] in implied and stack[-1][0] not in BARRIERS - implied:
            stack.pop()
        above = stack[-1] if stack else ("", frozenset(), False, False)
        names = above[1]
        if attributes:
            words = [w.lower() for a in ATTRIBUTE.findall(attributes) for w in NAME_PARTS.findall(a[1] or a[2] or a[3])]
            if HIDDEN.search(attributes):
                words.append("_hidden")
            if words:
                names = names | frozenset(words)
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(page, at)
            if tag == "textarea" and not above[3]:
                stack.append((tag, names, above[2], above[3]))
                add(page[at : stop.start()] if stop else page[at:])
                close_block()
                stack.pop()
            at = stop.start() if stop else end
            continue
        stack.append((tag, names, above[2] or MARK in attributes, above[3] or tag in SILENT))
    close_block()
    return out


# What the labelled pages are made of: (opening tag, closing tag) of places, and how their names vary.
MAIN = [
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ('<div class="post-body">', "</div>"), ('<div class="entry-content">', "</div>"),
    ('<div class="article-text">', "</div>"), ('<section class="story">', "</section>"), ('<div role="main">', "</div>"), ('<div class="c12">', "</div>"),
    ("<main><article>", "</article></main>"), ('<article class="post">', "</article>"), ('<div id="main"><div class="text">', "</div></div>"), ("<table><tr><td>", "</td></tr></table>"),
]
LISTS = [
    ("<nav><ul>", "</ul></nav>"), ('<div class="menu"><ul>', "</ul></div>"), ('<ul class="navigation">', "</ul>"), ('<div id="topbar"><ul>', "</ul></div>"), ('<div class="breadcrumbs"><ul>', "</ul></div>"),
    ('<div class="related"><h3>Related</h3><ul>', "</ul></div>"), ('<div class="share-buttons"><ul>', "</ul></div>"), ('<aside><h3>Most read</h3><ul>', "</ul></aside>"), ('<div class="tags"><ul>', "</ul></div>"),
    ('<div class="pagination"><ul>', "</ul></div>"), ("<header><ul>", "</ul></header>"), ('<div role="navigation"><ul>', "</ul></div>"),
]
SIDES = [
    ("<header>", "</header>"), ('<div id="header">', "</div>"), ('<div class="site-header">', "</div>"), ('<div role="banner">', "</div>"), ("<footer>", "</footer>"), ('<div class="footer">', "</div>"),
    ('<div id="site-footer">', "</div>"), ('<div role="contentinfo">', "</div>"), ("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div id="right-sidebar">', "</div>"), ('<div role="complementary">', "</div>"),
    ('<div class="widget">', "</div>"), ('<div class="ad">', "</div>"), ('<div class="advert">', "</div>"), ('<div class="ad-banner">', "</div>"), ('<div class="sponsored">', "</div>"), ('<div class="promo">', "</div>"),
    ('<div class="cookie-notice">', "</div>"), ('<div class="notice">', "</div>"), ('<div role="alert">', "</div>"), ('<div class="newsletter">', "</div>"), ('<div id="gdpr-consent">', "</div>"), ('<div class="disclaimer">', "</div>"),
    ('<section class="comments">', "</section>"), ('<div id="comments"><div class="comment">', "</div></div>"), ('<ol class="commentlist"><li>', "</li></ol>"), ('<div class="reader-comments">', "</div>"), ('<div class="replies">', "</div>"),
    ('<form action="/s">', "</form>"), ('<form class="login"><label>', "</label></form>"), ('<div class="popup">', "</div>"), ('<div hidden>', "</div>"), ('<div class="subscribe">', "</div>"), ('<div class="byline-share">', "</div>"),
]
SHORT = [
    "&copy; 2024 All rights reserved.", "We use cookies. Accept all", "Subscribe to our newsletter", "Share this page", "Sign in", "Search", "Privacy policy &middot; Terms", "Advertisement",
    "Log in to comment", "Read more", "3 comments", "Follow us", "Powered by our sponsors", "Contact us",
]
SYLLABLES = "an be cor de el fi go hu in jo ka lu mer no or pa qui res ti ul ver wen ya zo".split()


def labelled_pages(n: int = 400, seed: int = 42) -> list[list[Block]]:
    """``n`` generated pages whose main blocks are marked: places, their order and their texts vary."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))

    def sentence() -> str:
        words = [word() for _ in range(rng.randint(1, 24))]
        return words[0].capitalize() + "".join(rng.choice([" ", " ", " ", " ", ", "]) + w for w in words[1:]) + rng.choice("....?!")

    def prose(most: int) -> str:
        return " ".join(sentence() for _ in range(rng.randint(1, most)))

    def main_part() -> str:
        kind = rng.random()
        if kind < 0.55:
            return f"<p>{prose(8)}" + rng.choice(["</p>", "</p>", ""])
        if kind < 0.65:
            return f"<h{(n := rng.randint(2, 4))}>{sentence()}</h{n}>"
        if kind < 0.75:
            return f"<p>{sentence()} <a href='/x'>{word()} {word()}</a> {prose(3)}</p>"
        if kind < 0.82:
            return "<ul>" + "".join(f"<li>{sentence()}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.87:
            return f"<blockquote>{prose(3)}</blockquote>"
        if kind < 0.92:
            return "<p>" + "<br>".join(f"<b>{sentence()}" for _ in range(rng.randint(1, 3)))
        if kind < 0.96:
            return f"<div>{prose(3)}</div>"
        return "<table>" + "".join(f"<tr><td>{word()}</td><td>{rng.randint(0, 999)}</td></tr>" for _ in range(3)) + "</table>"

    def aside_part() -> str:
        if rng.random() < 0.4:
            a, b = rng.choice(LISTS)
            return a + "".join(f"<li><a href='/{i}'>{word().capitalize()}</a></li>" for i in range(rng.randint(2, 8))) + b
        a, b = rng.choice(SIDES)
        inner = rng.choice([rng.choice(SHORT), prose(1), prose(4), f"<p>{prose(5)}</p>", f"<h3>{sentence()}</h3><p>{prose(3)}</p>", f"<p>{sentence()}</p><p><a href='/y'>{word()}</a></p>"])
        return a + inner + b

    def marked(opening: str) -> str:
        head, _, rest = opening.rpartition("<")
        return f"{head}<{rest[:-1]} {MARK}>"

    pages = []
    for _ in range(n):
        a, b = rng.choice(MAIN)
        a = marked(a)
        title = f"<h1>{sentence()}</h1>"
        inner = [title] * (rng.random() < 0.8) + [main_part() for _ in range(rng.choice([1, 2, 4, 8, 14]))]
        body = "".join(inner)
        if rng.random() < 0.35:  # something strange inside the article, which ends its marked part
            cut = rng.randint(1, len(inner))
            body = "".join(inner[:cut]) + b + "\0" + a + "".join(inner[cut:])
        page = "".join(aside_part() for _ in range(rng.randint(1, 4))) + a + body + b + "".join(aside_part() for _ in range(rng.randint(0, 4)))
        if "\0" in page:
            outer = rng.choice(["<div>", "<article>", '<div class="page">'])
            page = outer + page.replace("\0", aside_part()) + f"</{NAME_PARTS.search(outer)[0]}>"
        pages.append(blocks_of(f"<html><head><title>{sentence()}</title></head><body>{page}</body></html>"))
    return [p for p in pages if p]
