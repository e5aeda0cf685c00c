"""HTML extraction on pages where text was once lost."""

import pytest

from folioflow.llm import html_text as H


def test_depth_has_no_cap():
    page = "<div><article><h1>H</h1>" + "<div>" * 80 + "<nav>menu</nav><p>deep</p>" + "</div>" * 80 + "<p>after</p></article></div><p>tail</p>"
    assert H.main_text(page, {}) == "H\ndeep\nafter"
    page = "<article>" + "<span>a " * 20000 + "<p>x</p>" + "</b>" * 20000 + "</article><p>tail</p>"
    assert H.main_text(page, {}) == ("a " * 20000).strip() + "\nx"
    w = H.align(H.fold(H.parse(page)), H.fold(H.parse(page.replace("x", "y"))))
    assert H.dump(H.load(H.dump(w))) == H.dump(w) and H.expression(w).count("<span>") == 20000


def _of_host(pages):
    w = None
    for p in pages:
        own = H.fold(H.parse(p))
        w = own if w is None else H.align(w, own)
    return w


def test_what_some_pages_share_is_no_template(spark):
    body = lambda i, more: f"<div class='post'><h1>Title {i}</h1><p>Text {i}</p>{more}<div>Read us daily</div></div>"
    pages = [body(i, "<h2>Conclusion</h2><p>So it is</p>" if i < 3 else "") for i in range(12)]
    pages += [body(99, "<h3>Sub-heading</h3><blockquote>Quote</blockquote>")] * 30
    rows = [(i, f"https://h.example.org/{i}", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Title 0\nText 0\nConclusion\nSo it is" and got[5] == "Title 5\nText 5"
    assert got[12] == got[41] == "Title 99\nText 99\nSub-heading\nQuote"


def test_long_texts_and_groups_are_evidence():
    long = "All rights are with the house. " * 20
    pages = [f"<div class='post'><h1>Title {i}</h1><div>{long}</div><ul><li>Send</li><li>Print</li></ul><ol><li>Point {i}</li><li>Print</li></ol></div>" for i in range(4)]
    fixed = H.fixed_slots(_of_host(pages))
    assert [H.main_text(p, fixed) for p in pages] == [f"Title {i}\nPoint {i}\nPrint" for i in range(4)]


def test_places_of_one_path_keep_their_texts():
    pages = [f"<div class='post'><p>First</p><h2>Title {i}</h2><p>Second</p></div>" for i in range(4)]
    assert H.main_text(pages[0], H.fixed_slots(_of_host(pages))) == "Title 0"


def test_words_alone_drop_no_article():
    prose = "<p>Long text of the article, with all that it says.</p>"
    said = "Long text of the article, with all that it says."
    for name in ("layout has-sidebar", "with-comments", "no-nav", "search-page", "page-sidebar"):
        assert H.main_text(f"<div class='{name}'><article>{prose}</article></div>", set()) == said, name
        assert H.main_text(f"<div class='{name}'>{prose}</div>", set()) == said, name
        assert H.main_text(f"<main><div class='{name}'>{prose}</div></main>", set()) == said, name
    assert H.main_text(f"<main></main><div class='sidebar'><article>{prose}</article></div>", set()) == said
    for name in ("discussion", "legal", "related", "notices"):
        assert H.main_text(f"<article>{prose}{prose}<section id='{name}'><p>We discuss.</p></section></article>", set()).endswith("We discuss."), name
    links = "<div class='related'><a href=1>One other</a> <a href=2>Two others</a></div>"
    comments = "<div class='comments'><article><p>Much longer " + "reader comment " * 20 + "</p></article></div>"
    assert H.main_text(f"<article>{prose}{links}<div class='ad'>Buy</div></article>{comments}", set()) == said


def test_wrapper_decides_on_words():
    pages = [f"<article><p>Text {i}</p><section id='legal'><p>All rights reserved</p></section></article>" for i in range(4)]
    assert H.main_text(pages[0], H.fixed_slots(_of_host(pages))) == "Text 0"
    pages = [f"<article><p>Text {i}</p><section id='legal'><p>Case {i}</p></section></article>" for i in range(4)]
    assert H.main_text(pages[0], H.fixed_slots(_of_host(pages))) == "Text 0\nCase 0"


def texts(spark, *bodies, host="h.example"):
    """The texts of pages of one host, beside what all its pages have."""
    page = '<html><body><nav><a href="/">Home</a></nav><div class="top"><p>Site of the year</p></div>{}<div><p>All rights kept</p></div><footer>End</footer></body></html>'
    rows = [(k, f"http://{host}/{k}", page.format(b)) for k, b in enumerate(bodies)]
    return [r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def test_what_articles_share_stays(spark):
    bodies = [f"<article><h2>Introduction</h2><p>Story {k} says {k * 7}.</p><h2>Conclusion</h2><p>It ends {k}.</p></article>" for k in range(5)]
    assert texts(spark, *bodies) == [f"Introduction\nStory {k} says {k * 7}.\nConclusion\nIt ends {k}." for k in range(5)]
    assert texts(spark, *bodies[:3], host="three.example")[0].startswith("Introduction\n")


def test_all_articles_in_page_order(spark):
    bodies = [f'<article><p>First {k}.</p></article><div><p>between {k}</p></div><article><p>Second and longer one {k}.</p></article><aside><article>Other story {k}</article></aside>' for k in range(4)]
    assert texts(spark, *bodies) == [f"First {k}.\nSecond and longer one {k}." for k in range(4)]


def test_main_keeps_what_stands_around_its_article(spark):
    bodies = [f"<main><h1>Head {k}</h1><p>Lead {k}.</p><article><p>Body {k}.</p><p>Shared line</p></article><p>Read this every day</p></main>" for k in range(4)]
    assert texts(spark, *bodies) == [f"Head {k}\nLead {k}.\nBody {k}.\nShared line" for k in range(4)]


@pytest.mark.parametrize("name", ["comments", "reader-comments", "comment-list", "responses", "opinions", "user-replies section", "disqus_thread"])
@pytest.mark.parametrize("inside", [True, False])
def test_reader_comments_of_any_length_go(spark, name, inside):
    entry = '<div class="entry"><span class="author">Ann {0}</span><time>today</time><p>I think {0} that this is much longer than the story itself, and so on and on.</p><a>Reply</a></div>'
    said = [f'<section class="{name}"><h3>What you say</h3>{"".join(entry.format(10 * k + i) for i in range(6))}</section>' for k in range(4)]
    bodies = [f"<article><p>Short story {k}.</p>{s if inside else ''}</article>{'' if inside else s}" for k, s in enumerate(said)]
    assert texts(spark, *bodies) == [f"Short story {k}." for k in range(4)]


def test_sections_that_readers_did_not_write_stay(spark):
    bodies = [f'<article><h1>On {k}</h1><section class="comments-on-plato"><p>Plato says {k}.</p><p>More of it {k}.</p></section><section class="opinions"><p>The court held {k}.</p><p>It held again {k}.</p></section>'
              f'<section id="discussion"><p>We discuss {k}.</p></section></article>' for k in range(4)]  # fmt: skip
    assert texts(spark, *bodies) == [f"On {k}\nPlato says {k}.\nMore of it {k}.\nThe court held {k}.\nIt held again {k}.\nWe discuss {k}." for k in range(4)]


def test_comments_that_are_articles(spark):
    entry = '<li><article class="comment-body"><b class="author">Bo {0}</b><p>Words of a reader {0}, many of them and more.</p></article></li>'
    bodies = [f'<article class="post"><p>Story {k}.</p></article><ol class="comment-list">{"".join(entry.format(10 * k + i) for i in range(5))}</ol>' for k in range(4)]
    assert texts(spark, *bodies) == [f"Story {k}." for k in range(4)]
