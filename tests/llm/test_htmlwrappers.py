"""Marked wrappers and forms do not silence the article in them."""

import pytest

from orebed.llm.htmlmain import main_text

LONG = " ".join(["This is a long paragraph of the article with many words that say something about the matter."] * 3)
ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p></article>"
TEXT = f"Title {LONG}"


@pytest.mark.parametrize("page", [
    f'<div class="content-sidebar-wrap">{ARTICLE}</div>',
    f'<div class="has-sidebar">{ARTICLE}<div class="sidebar">side</div></div>',
    f'<div class="no-sidebar">{ARTICLE}</div>',
    f'<div class="header-wrap">{ARTICLE}<p>menu text</p></div>',
    f"<form action=/><nav>menu</nav>{ARTICLE}<p>Search here</p></form>",
    f"<main><form>{ARTICLE}</form></main>",
    ARTICLE.replace("<article>", '<article class="no-comments">'),
    ARTICLE.replace("<h1>Title</h1>", '<header class="entry-header"><h1>Title</h1></header>'),
    ARTICLE.replace("<h1>Title</h1>", '<div class="post-header"><h1>Title</h1></div>'),
    f"<form><h1>Title</h1><p>{LONG}</p></form>",
    f'<div class="widget"><h1>Title</h1><p>{LONG}</p></div><nav>menu</nav>',
])
def test_article_in_marked_wrapper(page):
    assert main_text(f"<body>{page}<footer>f</footer></body>") == TEXT


@pytest.mark.parametrize("other", [
    f'<div class="comments">{ARTICLE}</div>', f'<div class="cookie-notice"><p>{LONG}</p></div>', f"<form><p>{LONG}</p></form>",
    f'<article class="comment"><p>{LONG}</p></article>', f'<div class="sidebar-left"><p>{LONG}</p></div>', f"<div hidden>{ARTICLE}</div>",
])
def test_boilerplate_stays_out(other):
    assert main_text(f"<body>{other}{ARTICLE}{other}</body>") == TEXT
    assert main_text(ARTICLE.replace("</article>", '<section class="comments-area">' + other + "</section></article>")) == TEXT
