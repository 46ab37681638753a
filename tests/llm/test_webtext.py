from __future__ import annotations

import pytest

from tallywatch.llm import webtext as w
from tallywatch.llm.common import ready
from tests.llm.helpers import collected

PROSE = "This is a longer piece of the text that was written for the readers of the page, and it goes on for a while."
PAGES = [
    ("<html><body><nav><a href=x>Home</a></nav><article><h1>T &amp; U</h1><p>Short.<p><b>A&nbsp;b<br>c</b></article><footer>&copy; x</footer>", "T & U\n\nShort.\n\nA b c"),
    (f"<div class='cookie-notice'>{PROSE}</div><article><p>One.</p><aside>{PROSE}</aside><form><p>Mail</p></form><p>Two.</p>"
     f"<section id=comments><p>{PROSE}</p></section></article>", "One.\n\nTwo."),
    (f"<body class='has-sidebar'><div class=sidebar><p>{PROSE}</p></div><div class=content><h2>Head</h2><p>{PROSE}</p><p>It is.</p></div>"
     "<div><a href=a>one</a> <a href=b>two</a></div></body>", f"Head\n\n{PROSE}"),
    ("<article><script>if (a < b) { '</p>' }</script><p>x<!-- <p>no</p> -->y</p><style>p{}</style><p title='a > b'>z</p>", "xy\n\nz"),
    ("<article><header><h1>Head</h1></header><p>a &lt;b&gt; &#233; &eacute;</p><article class=comment><p>Talk</p></article></article>", "Head\n\na <b> é é"),
    (f"<main><div><p>{PROSE}</p><p><a href=x>Read more about it</a></p><div class='ad'>Buy</div><p>End.</p></div></main>", f"{PROSE}\n\nEnd."),
    ("<article><p>" + "a <b>" * 3000 + "</article>", " ".join(["a"] * 3000)),
    ("", ""), (None, ""), ("plain", ""), ("<", ""), ("<p", ""), ("<article>&", "&"), ("<!-- open", ""), ("<script>x", ""), ("</article></p>", ""),
    ("<article><p>cut in a <a href='x", "cut in a"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert w.main_text(page or "") == text


def test_query(spark):
    pages = ready(spark).createDataFrame([(i, f"u{i}", p, "t", 1) for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None, None)] + [(0, "u0", PAGES[0][0], "t", 1)],
                                         "page_id long, url string, html string, text string, n_chars int")
    wanted = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(None, None, "", 0), (0, "u0", PAGES[0][1], len(PAGES[0][1]))]
    assert sorted(collected(w.extract(pages)), key=repr) == sorted(wanted, key=repr)
    assert collected(w.extract(pages.limit(0))) == []
