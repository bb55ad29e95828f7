import re
from html import unescape

import pytest

from foldspark.llm import html


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>", ""),
        ("plain &amp; simple &lt;", "plain & simple <"),
        ("a < b and c > d <p", "a < b and c > d"),
        ("<p>x" * 3, "x\nx\nx"),
        ("<p>one <b>tw</b>o<br>three&nbsp;\n four</p>", "one two three four"),
        (
            "<body><header><h1>Site</h1></header><nav><a>Home</a></nav><div class='sidebar'>x y z</div>"
            "<div id=main><h2>T</h2><p>One two three four five six.<p>Seven <a href=x>eight</a> nine ten.</div>"
            "<div class=comments><p>nice article indeed</p></div><form>name <input></form><footer>f</footer>",
            "T\nOne two three four five six.\nSeven eight nine ten.",
        ),
        (
            "<article><header><h1>Title</h1></header><p>one</p><div class='share-buttons'><a>fb</a></div><p>two</p>"
            "<section id=comments><p>c1</p></section><footer>by me</footer></article>"
            "<script>if(a<b){document.write('<p>no</p>')}</script><div class='cookie-notice'>We use cookies</div>",
            "Title\none\ntwo",
        ),
        ("<article><h1>T</h1><div><p>long paragraph one</p><p>long paragraph two</p></div></article>", "T\nlong paragraph one\nlong paragraph two"),
        ("<div><ul><li><a>a</a><li><a>b</a><li><a>c</a></ul><p>text text text text</p></div>", "text text text text"),
        ("<main><article><p>text</p></article><article class='comment'><p>reply</p></article></main>", "text"),
        ("<!-- <p>no</p> --><p title='a > b'>yes</p><style>p{}</style>", "yes"),
        ("<nav>menu</article></nav><article><p>body text</p>", "body text"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


_TEXT = "<h1>T</h1><p>One two three four five.</p><p>Six seven eight nine ten.</p>"
_WANT = "T\nOne two three four five.\nSix seven eight nine ten."


@pytest.mark.parametrize(
    "page",
    [
        f"<body><article class='post comments-open'>{_TEXT}</article></body>",
        f"<body class='single comments-open'><div>{_TEXT}</div></body>",
        f"<body class='has-sidebar'><article>{_TEXT}</article></body>",
        f"<body><div class='layout-sidebar-right'>{_TEXT}</div></body>",
        f"<body><div class='sidebar'><article>{_TEXT}</article></div></body>",
        f"<body><form action=x><div>{_TEXT}</div><input></form></body>",
        f"<body><article>{_TEXT}</article><div hidden><p>secret words here</p></div></body>",
        f"<body><article>{_TEXT}</article><div class='share-buttons'>a b</div><div id='cookieNotice'>c</div></body>",
        f"<main>{_TEXT}<article class='comment depth'><p>kept, as its name is its own</p></article></main>".replace(" depth", ""),
        f"<body><div id=wrap><div class=ad-slot>buy</div><div id=content>{_TEXT}</div></div></body>",
    ],
)
def test_wrappers_and_names(page):
    assert html.main_text(page) == _WANT


def test_names_that_only_look_like_other_parts():
    parts = "<p id='related-work'>a b</p><p class='social-science'>c d</p><p class='notice-board'>e f</p><h2 id='sharing'>g</h2>"
    assert html.main_text(f"<article>{parts}<p class='newsletter-signup'>x</p></article>") == "a b\nc d\ne f\ng"
    assert html.main_text("<article><p>one <svg><path d=x></svg>two</p></article>") == "one two"


def test_short_blocks_beside_a_nested_section_without_a_mark():
    inner = "".join(f"<p>{'words ' * 80}</p>" for _ in range(3))
    page = f"<body><div id=wrap><nav>menu</nav><div id=content><h2>Title</h2><p>Short lead.</p><div>{inner}</div><p>The end.</p></div></div></body>"
    found = html.main_text(page).split("\n")
    assert found[:2] == ["Title", "Short lead."] and found[-1] == "The end." and len(found) == 6


@pytest.mark.parametrize("page", ["<" * 50_000, "<a " * 20_000, "<div>" * 20_000 + "deep", "<p class='" * 5_000, "&" * 50_000])
def test_hostile_pages_end(page):
    html.main_text(page)


def test_articles_of_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    found = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        blocks = [re.sub("</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(unescape(x).split()) for x in blocks]
        want = "\n".join(x for x in blocks if x)
        assert (found[r.page_id].text, found[r.page_id].n_chars) == (want, len(want))


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>t</p>", "x"), (1, "u", None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(["(1, 'u', '', 0)"] * 2 + ["(None, None, 't', 1)"])
    assert html.extract(pages.limit(0)).count() == 0


def test_blocks_beside_a_nested_section_and_linked_sources():
    lead, inner = "lead " * 130, ["words " * 100] * 3
    page = f"<body><div><h2>A heading of words</h2><p>{lead}</p><div>" + "".join(f"<p>{t}</p>" for t in inner) + "</div></div>"
    assert lead.strip() in html.main_text(page).split("\n")
    sources = "".join(f"<li><a href=x>source {k} of the article</a>" for k in range(4))
    page = f"<body><article><h1>T</h1><p>{lead}</p><h2>Sources</h2><ul>{sources}</ul></article>"
    assert html.main_text(page).split("\n")[-4:] == [f"source {k} of the article" for k in range(4)]
