import html as stdlib
import re

from basketlab.llm import html, queries

PARAS = ["Sthe.", "A longer paragraph of the story, with a <a href='/x'>link</a> in it.", "Third &amp; last &lt;one&gt;."]
WANT = "Head line\nSthe.\nA longer paragraph of the story, with a link in it.\nThird & last <one>."


def page(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><article>';</script></head>"
            f"<body>{before}{article}{after}</body></html>")


def article(open_="<article>", close="</article>"):
    return open_ + "<h1>Head  line</h1>" + "".join(f"<p>{p}</p>" for p in PARAS) + close


NAV = "<nav><ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(8)) + "</ul></nav>"
PLAIN_MENU = "<div><ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(8)) + "</ul></div>"


def test_boilerplate_goes():
    before = ["", NAV, PLAIN_MENU, "<header><a href=/>Site</a> name</header>", "<div class='ad'>Buy this now, today.</div>",
              "<div id=cookie-notice>We use cookies on this site, please agree.</div>",
              "<form><label>Name</label><input><button>Go</button></form>", "<aside>Side words here.</aside>",
              "<div class='sidebar'><p>Side words here.</p></div>", "<!-- <p>no</p> -->", "<noscript>Turn it on</noscript>",
              "<svg><text>x</text></svg>", "<div style='display: none'>hidden words</div>"]
    after = ["", "<footer>&copy; site</footer>", "<section class='comments'><article class='comment'><p>" + "I disagree. " * 40
             + "</p></article></section>", "<div role=complementary><p>More words</p></div>"]
    for b in before:
        for a in after:
            for o, c in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post'>", "</div>"),
                         ("<div>", "</div>")):
                assert html.main_text(page(article(o, c), b, a)) == WANT, (b, a, o)


def test_inside_the_article():
    inner = NAV + "<div class='share-buttons'>Share it</div><ul><li>one</li><li>two<p>more</p></ul><br>tail <br>end"
    assert html.main_text(page(article(close=inner + "</article>"))) == WANT + "\none\ntwo\nmore\ntail end"


TEXT = "".join(f"<p>{p}</p>" for p in PARAS)
PLAIN = WANT.split("\n", 1)[1]


def test_nothing_hides_the_only_text():
    for form in ("<form id=aspnetForm>", "<form>"):
        assert html.main_text(page(form + article() + "<input><select><option>a</select></form>")) == WANT
        assert html.main_text(page(form + "<div>" + TEXT + "</div></form>")) == PLAIN
    for name in ("content no-sidebar", "page has-banner", "with-sidebar", "banner", "overlay modal"):
        assert html.main_text(page(f"<div class='{name}'>" + TEXT + "</div>", before=NAV)) == PLAIN, name
    assert html.main_text(page("<div class='comments'><p>All there is.</p></div>")) == "All there is."
    # With an article elsewhere, a long side part stays out.
    long = "<div class='sidebar'><p>" + "Side words here. " * 60 + "</p></div>"
    assert html.main_text(page(article(), before=long)) == WANT


def test_lists_of_links_in_the_article_stay():
    sources = "<ul>" + "".join(f"<li><a href='/s{i}'>Source {i}</a></li>" for i in range(4)) + "</ul>"
    want = WANT + "\n" + "\n".join(f"Source {i}" for i in range(4))
    assert html.main_text(page(article(close=sources + "</article>"))) == want
    assert html.main_text(page(article(close=sources + "</article>"), before=PLAIN_MENU)) == want
    assert html.main_text(page(article(close=f"<div class=related>{sources}</div></article>"))) == WANT


def test_weak_words_keep_paragraphs_of_the_article():
    part = "<div class='overlay-map'><p>The map shows the river and the town.</p></div>"
    assert html.main_text(page(article(close=part + "</article>"))) == WANT + "\nThe map shows the river and the town."
    assert html.main_text(page(article(close="<div class='overlay'>Close it</div></article>"))) == WANT


def test_widened():
    assert html.extracted(page("<div>" + TEXT + "</div>"))[1] is False
    text, widened = html.extracted(page("<article><h1>Head  line</h1><div>" + TEXT * 3 + "</div></article>"))
    assert text.startswith("Head line") and widened


def test_broken_markup():
    assert html.main_text("") == ""
    assert html.main_text("no markup &amp; at   all") == "no markup & at all"
    assert html.main_text("<p>one<p>two <b>bold<br><p>three") == "one\ntwo bold\nthree"
    assert html.main_text("<article><p>cut in a tag <a href='x") == "cut in a tag"
    assert html.main_text("<article><p>a < b and 3<4</p></article>") == "a < b and 3<4"
    assert html.main_text("<script>x") == ""
    assert html.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert html.main_text("<p title='a>b'>x</p><p title=\"never closed>y</p>") == "x\ny"
    assert len(html.main_text("<article>" + "<p>word word</p>" * 20000 + "</article>")) == 10 * 20000 - 1


def test_density():
    assert html.composite_density(0, 3, 0, 0, 0.5) == 0
    assert html.composite_density(100, 2, 0, 0, 0.0) == 50
    assert html.composite_density(100, 5, 0, 0, 0.2) > html.composite_density(100, 5, 90, 4, 0.2)


def reference(source):
    """The generator's layout, read by pattern: the article's h1 and p."""
    inside = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inside)
    blocks = [" ".join(stdlib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_op4_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in queries.op4_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p.page_id].text == reference(p.html), p.page_id
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_nulls_repeats_and_no_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    df = spark.createDataFrame([(1, "u", None, "x", 1), (None, None, page(article()), "x", 1)] * 2, schema)
    assert sorted((str(r.page_id), r.text) for r in html.extract(df).collect()) == [("1", "")] * 2 + [("None", WANT)] * 2
    assert html.extract(spark.createDataFrame([], schema)).count() == 0
