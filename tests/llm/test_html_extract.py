import pytest

from stardw.llm.html_extract import extract, main_text

LONG = "A sentence of some length, with commas, that a reader would take for prose. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a", "a"), ("<div><p>x < y &amp; z</p></div>", "x < y & z"),
    ("<script>var a='<p>no</p>'</script><p>yes", "yes"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<p>one  \n two<p>three<br>four", "one two\nthree four"), ("<p>&#233;&eacute;&lt;b&gt;</p>", "éé<b>"),
    ("<nav><a href=x>menu</a></nav>", ""), ("<style>p{}</style>", ""), ("<script>never closed <p>x", "")])
def test_small_pages(page, text):
    assert main_text(page or "") == text


def test_parts_beside_the_article_go():
    page = f"""<html><head><title>t</title></head><body><header><h1>Site name</h1></header>
      <div class="nav-menu"><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div>
      <div id="main"><h1>Title</h1><p>{LONG * 2}<p>{LONG} <a href=x>link</a>
        <blockquote>{LONG}</blockquote><ul><li>first<li>second</ul>
        <div class="ad banner"><p>{LONG * 3}</p></div>
        <form><p>{LONG}</p><input></form><aside><p>{LONG}</p></aside>
        <table><tr><td>cell</td></tr></table></div>
      <section class="comments"><p>{LONG * 9}</p></section>
      <div class="cookie-notice"><p>{LONG}</p></div><footer><p>{LONG}</p></footer></body></html>"""
    line = LONG.strip()
    assert main_text(page) == "\n".join(
        ["Title", f"{line} {line}", f"{line} link", line, "first", "second", "cell"])


def test_link_lists_lose_and_siblings_stay():
    links = "".join(f"<li><a href={i}>A headline, with a comma, of some length {i}</a>" for i in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><p>{LONG * 2}</p><p>{LONG}</p></div><p>{LONG * 2}</p>"
    assert main_text(page).count("\n") == 2 and "headline" not in main_text(page)


def test_edge_rows(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None),
            (2, "v", "<p>" + "<div>" * 3000 + "deep", "y"), (3, "w", "<p>" + "word " * 200_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    found = sorted((r.page_id or 0, r.n_chars) for r in extract(pages).collect())
    assert found == [(0, 0), (1, 1), (1, 1), (2, 4), (3, 999_999)]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("wrapper", [
    "div class='content has-sidebar'", "div class='post type-post tag-legal'",
    "div id='main' class='with-comments'", "div class='rail'", "div class='social wide'",
    "div class='page-notice'", "div class='tags'", "form id='aspnetForm'", "form class='form'"])
def test_wrappers_of_the_article_stay(wrapper):
    tag = wrapper.split()[0]
    page = f"""<body><div class='nav-menu'><a href=1>One</a></div><{wrapper}>
      <header class='entry-header'><h1 class='entry-header'>Title</h1></header><p>{LONG * 2}</p>
      <div class='share-buttons'><p>Share</p></div><p>{LONG}</p></{tag}>
      <div class='comments'><p>{LONG}</p></div></body>"""
    line = LONG.strip()
    assert main_text(page) == "\n".join(["Title", f"{line} {line}", line])


@pytest.mark.parametrize("wrapper", ["div class='content has-sidebar'", "div class='wide with-comments'"])
def test_an_article_shorter_than_its_comments_stays(wrapper):
    page = f"""<body><{wrapper}><h1>Title</h1><p>{LONG * 2}</p><p>{LONG}</p></div>
      <div class='comments'>{f"<p>{LONG}</p>" * 3}</div></body>"""
    line = LONG.strip()
    assert main_text(page) == "\n".join(["Title", f"{line} {line}", line])


def test_a_page_of_parts_beside_has_text():
    page = "".join(f"<div class='{c}'><p>{LONG}</p></div>" for c in ("rail", "notice", "tags"))
    assert LONG.strip() in main_text(page)


def test_inline_parts_beside_go():
    page = f"<div class=post><p>{LONG * 2}<span class='share'>Share this</span> end</p><p>{LONG}</p></div>"
    assert "Share" not in main_text(page) and "end\n" in main_text(page)


LINE = LONG.strip()


def test_link_lists_inside_the_article_stay():
    page = f"""<body><ul><li><a href=0>Home</a></ul><div class=content><ul><li><a href=1>Contents</a></ul><p>{LONG * 2}</p>
      <ul><li><a href=2>First source</a><li><a href=3>Second source</a></ul><p>{LONG}</p></div>
      <ul><li><a href=4>Imprint</a></ul></body>"""
    assert main_text(page) == "\n".join([f"{LINE} {LINE}", "First source", "Second source", LINE])


@pytest.mark.parametrize("article", ["div class=x", "div class=content", "div id='main' class='with-comments'"])
@pytest.mark.parametrize("beside, paragraphs", [
    ("<div id=comments><ol>{}</ol></div>", "<li><p>{}</p></li>"), ("<div class=comments>{}</div>", "<div class=c><p>{}</p></div>"),
    ("<div class=sidebar>{}</div>", "<p>{}</p>"), ("<div class='related widget'>{}</div>", "<div><h3>Other</h3><p>{}</p></div>")])
def test_long_parts_beside_never_win(article, beside, paragraphs):
    page = f"<body><{article}><p>{LONG * 2}</p><p>{LONG}</p></div>" + beside.format(
        paragraphs.format(LONG * 2) * 12) + "</body>"
    assert main_text(page) == f"{LINE} {LINE}\n{LINE}"


def test_one_paragraph_beside_long_comments():
    page = f"<body><div class=x><p>{LONG * 2}</p></div><div id=comments>{f'<p>{LONG}</p>' * 9}</div></body>"
    assert main_text(page) == f"{LINE} {LINE}"
