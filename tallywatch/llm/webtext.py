"""Main text of web pages by two-pass block rules.

The page is read once as tags and text. Block-level tags end a block; a block keeps its text, how much of it
stands in links, and where it stands. First pass: a block in a menu, header, footer, sidebar, notice, advert,
form or comment section is boilerplate, and so is one that is mostly links; blocks of a length and stop-word
density of prose are content; the rest are undecided. Second pass: undecided blocks take the label of the
nearest decided neighbours, inside their own article where the page has one.

Null html counts as empty; a page without main text gives an empty string. Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[^\W\d_]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
#: Elements that never hold main text.
OUTSIDE = frozenset(
    "head nav footer aside form script style noscript template iframe button select textarea svg canvas dialog menu object "
    "audio video map datalist noembed noframes".split())
#: Words of class and id values, and roles, of what stands around the main text.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice newsletter subscribe subscription signup sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead topbar toolbar related recommended share sharing social widget popup modal overlay login search pagination pager "
    "paywall alert disclaimer".split())
TALK = frozenset("comment comments disqus reply replies respond discussion".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Frequent short words of English, German, French and Spanish.
STOP = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you "
    "were her all she there would their we him been has when who will no more if out so what up said its about than into them "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "le la les et des en un une du que est pour qui dans par plus pas au sur ne se ce il sont avec son "
    "el los las y del por con para lo como más su sus al se una no".split())
LINKS, LONG, PROSE, SOME = 0.4, 70, 0.2, 0.1


class Block:
    __slots__ = ("text", "linked", "away", "around", "article", "heading", "label")

    def __init__(self, text: str, linked: int, away: bool, around: tuple[int, ...], article: int, heading: bool):
        self.text, self.linked, self.away, self.around = text, linked, away, around
        self.article, self.heading, self.label = article, heading, ""


def _hint(rest: str, tag: str, nested: bool) -> bool:
    """Whether the attributes say that this element stands around the main text."""
    if "=" not in rest and "hidden" not in rest:
        return False
    found = {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(rest)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", "").lower()):
        return True
    words = {w.lower() for w in PART.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    if words & TALK:
        return True
    if tag == "article" and not nested:
        return False
    return bool(words & AROUND) or found.get("role", "").lower() in ROLES


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    # Open elements: (name, serial if its attributes are a hint, element outside the text, article, is a header)
    stack: list[tuple[str, int, bool, int]] = []
    opened: Counter[str] = Counter()
    hints: list[int] = []
    void_hints: set[int] = set()
    state = {"away": 0, "article": [], "links": 0, "linked": 0, "serial": 0, "articles": 0}

    def flush(heading: bool = False) -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, state["linked"], state["away"] > 0, tuple(hints), state["article"][-1] if state["article"] else 0, heading))
        parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text and not state["away"]:
            text = html.unescape(text)
            parts.append(text)
            if state["links"]:
                state["linked"] += len("".join(text.split()))
        elif text and text.strip():
            parts.append(text)

    def close(name: str) -> None:
        while stack:
            tag, hint, away, article = stack.pop()
            opened[tag] -= 1
            if hint:
                hints.remove(hint)
            state["away"] -= away
            if article:
                state["article"].pop()
            if tag == "a":
                state["links"] -= 1
            if tag == name:
                return

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at: m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        rest = m["rest"] or m["rest2"] or ""
        if m["end"] or m["end2"]:
            if tag not in INLINE:
                flush(len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
            elif tag == "br":
                parts.append(" ")
            if opened[tag] > 0:
                close(tag)
            continue
        if tag in ("br", "wbr"):
            parts.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID or rest.endswith("/") and tag not in INLINE and tag not in ("p", "div", "article"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in ("p", "li") and stack and stack[-1][0] == tag:
            close(tag)
        nested = bool(state["article"])
        main = tag in ("article", "main") or 'role="main"' in rest or "articleBody" in rest
        hint = 0
        if tag not in ("html", "body", "main") and _hint(rest, tag, nested):
            state["serial"] += 1
            hint = state["serial"]
            hints.append(hint)
        elif main:
            void_hints.update(hints)  # what holds the article isn't around it
        away = tag in OUTSIDE or tag == "header" and not nested
        article = 0
        if main and not hint:
            state["articles"] += 1
            article = state["articles"]
            state["article"].append(article)
        state["away"] += away
        if tag == "a":
            state["links"] += 1
        stack.append((tag, hint, away, article))
        opened[tag] += 1
    flush()
    for b in out:
        b.away = b.away or any(h not in void_hints for h in b.around)
    return out


def label(blocks: list[Block]) -> None:
    """good or bad for each block."""
    articles = any(b.article and not b.away for b in blocks)
    for b in blocks:
        size = len(b.text) - b.text.count(" ")
        words = WORD.findall(b.text.lower())
        stop = sum(w in STOP for w in words) / max(1, len(words))
        if b.away or articles and not b.article or size and b.linked > LINKS * size:
            b.label = "bad"
        elif "\xa9" in b.text and len(b.text) < 200 and not b.article:
            b.label = "bad"
        elif len(b.text) >= LONG and stop >= PROSE:
            b.label = "good"
        elif len(b.text) >= LONG and not b.article and stop < SOME:
            b.label = "bad"
    decided = [b.label for b in blocks]
    before: list[tuple[int, str]] = []
    last = (-1, "")
    for i, b in enumerate(blocks):
        before.append(last)
        if decided[i] and (decided[i] == "good" or not b.article):
            last = (i, decided[i])
        elif decided[i]:
            last = last if b.article else (i, decided[i])
    after = (len(blocks), "")
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        if not b.label:
            near = [x for x in (before[i], after) if x[1]]
            if b.article:
                own = [x for x in near if blocks[x[0]].article == b.article]
                b.label = own[0][1] if own else "good"
            elif not near:
                b.label = "good" if len(b.text) >= LONG else "bad"
            elif b.heading and after[1] == "good":
                b.label = "good"
            else:
                b.label = "good" if all(x[1] == "good" for x in near) else "bad"
        if decided[i] and (decided[i] == "good" or not b.article):
            after = (i, decided[i])


def main_text(page: str) -> str:
    """Blocks of the main text, joined by an empty line."""
    blocks = blocks_of(page)
    label(blocks)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def pull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return pages.mapInArrow(pull, "page_id long, url string, text string, n_chars long")
