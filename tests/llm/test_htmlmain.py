from orebed.llm.htmlmain import extract, main_text

LONG = "This is a long paragraph of the article with many words that say something about the matter at hand. " * 3


def test_article_among_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>x";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a>About</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><!-- note --><div class="ad">Buy &amp; save</div>
    <article><h1>Title</h1><p><b>First&nbsp;par &eacute;<br>line</b><p>Sh<i>or</i>t.</p><aside>See also</aside>
    <p>{LONG}</p><form><input><label>Mail</label></form><section id="comments"><p>{LONG}</p></section></article>
    <div class="sidebar">side</div><footer>&copy; us</footer></body></html>"""
    assert main_text(page) == f"Title First par é line Short. {' '.join(LONG.split())}"


def test_pages_without_semantic_elements():
    body = "".join(f"<p>{LONG}</p>" for _ in range(4))
    page = f"<body><div id=menu><a>a</a><a>b</a></div><div><h2>Head</h2>{body}<p>End.</p></div><div class=footer>f</div>"
    assert main_text(page) == " ".join(["Head", *[" ".join(LONG.split())] * 4, "End."])
    assert main_text("just text &lt;b&gt;") == "just text <b>"


def test_broken_markup():
    assert main_text("<nav><a>x</a><article><p>one<p>two") == "one two"
    assert main_text("<article><div><p>a</div></p></article></div>tail<p>") == "a"
    assert main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"
    assert main_text("<p>a<script>if (a<b) x()</script>b</p>") == "ab"
    assert main_text("<") == "<" and main_text("<!-- open") == ""


def test_edges(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (3, "v", "<p>hi</p>"), (4, "w", "<nav>x</nav>"), (5, "x", "a " * 300_000)]
    table = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract(table).collect()))
    assert got == [(0, "", 0), (1, "", 0), (1, "", 0), (3, "hi", 2), (4, "", 0), (5, ("a " * 300_000).strip(), 599_999)]
    assert extract(table.limit(0)).count() == 0


def test_given_pages_hold_their_documents(spark):
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r["doc_id"]: " ".join(r["text"].split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for row in extract(pages).collect():
        doc = int(re.search(r"/(\d+)", row["url"].split("://", 1)[1])[1])
        assert row["text"].endswith(texts[doc]) and len(row["text"]) - len(texts[doc]) <= 61
