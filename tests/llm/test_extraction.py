import pytest

from depotflow.llm import extraction
from tests.llm.helpers import collected

SCHEMA = "page_id long, url string, html string, text string, host string, page string, n_chars string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def text_of(html):
    page = extraction.parse(html)
    kind = page.declared or extraction.OPEN
    return "\n".join(page.of(kind))


@pytest.mark.parametrize("html, expected", [
    ("<article><h1>T &amp; U</h1><p><b>one\n two<br><p>three</article><footer>f</footer>", "T & U\none two\nthree"),
    ("<nav>n</nav><article>a<nav>in</nav>b<aside>x</aside></article>", "a\nb"),
    ("<div class='ad'>x<div>y</div></div><p>main</p><div id=\"site-footer\">f</div>", "main"),
    ("<main><p>m</p><form><p>f</p></form></main><p>other</p>", "m"),
    ("<script>var t='</p><article>';</script><style>p{}</style><article>a<!-- <p>c</p> --></article>", "a"),
    ("<article><p>1 &lt; 2 &#65;&eacute;</p></article>", "1 < 2 Aé"),
    ("<article><p>body</p><section class=\"comments\"><p>reader</p></section></article>", "body"),
    ("<p>open", "open"), ("", ""), ("no markup at all", "no markup at all"), ("<p hidden>h</p><p>v</p>", "v"),
    ("<article><p title='a>b'>t</p></article>", "t"), ("a < b", "a < b"), ("<!-- never closed <p>x</p>", ""),
    ("<article><article>inner</article>outer</article><p>x</p>", "inner\nouter"),
    ("<header>site</header><article><header><h1>t</h1></header><p>p</p></article>", "t\np"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</tr></table></article>", "a\nb\nc d"),
])
def test_blocks(html, expected):
    assert text_of(html) == expected


@pytest.mark.parametrize("html, expected", [
    ('<div class="content has-sidebar"><nav>n</nav><article><p>a</p></article><p>x</p></div>', "a"),
    ('<p>stray</p><div id="page" class="social-share-on"><div><main><p>m</p><aside>s</aside></main></div></div>', "m"),
    ('<form id="aspnet"><div>menu</div><article>one</article><article>two</article></form><p>x</p>', "one\ntwo"),
    ('<div class="no-sidebar"><div role="main">m</div></div>', "m"),
    ('<div class="share"><p>x</p><div itemprop="articleBody">b</div></div>', "b"),
    ('<article><h1>t</h1><div class="sharing" itemprop="articleBody"><p>b</p></div></article>', "t\nb"),
    ('<div class="has-sidebar"><article><h1>t</h1><div class="share" itemprop="articleBody">b</div></article></div>', "t\nb"),
    ('<main><h1>t</h1><div class="has-sidebar"><article><p>a b c</p></article></div></main>', "a b c"),
    ('<article class="post social-share-on">a b</article>', "a b"),
    ('<main class="has-sidebar">m</main><p>x</p>', "m"),
    ('<div class="has-sidebar"><div class="post-content">a b</div></div>', "a b"),
    ('<article>one two</article><div class="related"><article>teaser</article></div>', "one two"),
    ('<main><p>one two</p><div class="related"><article>teaser</article></div></main>', "one two"),
    ('<p>one two three four five</p><div class="sidebar"><article>open one</article></div>', "one two three four five\nopen one"),
    ('<div class="has-sidebar"><article>a b<div class="related"><article>c</article></div></article></div>', "a b"),
    ('<div class="has-sidebar"><nav><article>n</article></nav><p>c</p></div><p>v</p>', "v"),
    ('<aside class="sidebar"><article>n</article></aside><p>v</p>', "v"),
    ('<form><div class="comments"><article>n</article></div></form><p>v</p>', "v"),
    ('<div class="has-sidebar"><div hidden><article>n</article></div></div><p>v</p>', "v"),
    ('<form><p>f</p><input></form><p>v</p>', "v"),
    ('<div role="main"><article>a<div class="ad">x</div>b</article></div><div>y</div>', "a\nb"),
    ('<div role="main"><section>a<p><span></span></p><div class="ad">x</div></section></div><p>y</p>', "a"),
])
def test_main_regions_in_wrappers_named_like_boilerplate(html, expected):
    assert text_of(html) == expected


def test_wrapped_pages_give_their_article(spark):
    text = "words of the article that only this page has"
    rows = [(1, "http://h/1", f'<div class="content has-sidebar"><article>{text}</article></div>'),
            (2, "http://h/2", f'<p>stray</p><form><div><main>{text}</main></div></form>')]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    assert found == {1: text, 2: text}


def test_repeated_runs_of_a_host_are_boilerplate(spark):
    menu = "home about us contact news sport weather"
    foot = "all rights reserved by the owners of this site"
    rows = [(n, f"http://one.example/{n}", f"<div>{menu}</div><p>{n} tells things of page {n}</p><div>{foot}</div>")
            for n in range(4)]
    rows += [(9, "http://two.example/", f"<div>{menu}</div><p>alone here</p>"),
             (10, "http://one.example/10", f"<article><p>{menu}</p></article>")]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    assert found == {n: f"{n} tells things of page {n}" for n in range(4)} | {
        9: f"{menu}\nalone here", 10: menu}


def test_equal_pages_keep_their_text(spark):
    menu = "home about us contact news sport weather"
    one, two = "<p>the same long story told here under two ids</p>", "<p>a page that was changed since the last visit</p>"
    rows = [(1, "http://h/1", one), (2, "http://h/2", one), (1, "http://h/1", one),
            (3, "http://v/3", two), (3, "http://v/3", two.replace("changed", "rewritten")),
            *((n, f"http://m/{n % 2}{n}", f"<div>{menu}</div><p>{n // 2} story told in few words</p>") for n in range(10, 14))]
    found = {(r.page_id, r.url, r.text) for r in extraction.extract(pages(spark, rows)).collect()}
    assert found == {(1, "http://h/1", one[3:-4]), (2, "http://h/2", one[3:-4]), (3, "http://v/3", two[3:-4]),
                     (3, "http://v/3", two[3:-4].replace("changed", "rewritten")),
                     *((n, f"http://m/{n % 2}{n}", f"{n // 2} story told in few words") for n in range(10, 14))}


def test_shared_prose_of_a_large_host_stays(spark):
    menu, quote = "home about us contact news sport weather", "it was the best of times it was the worst of times " * 3
    texts = [f"{n} begins " + ("on the other side of the " if n % 8 == 0 else "") + (quote if n in (1, 2) else "") + f"{n} ends"
             for n in range(80)]
    rows = [(n, f"http://h/{n}", f"<div>{menu}</div><p>{text}</p>") for n, text in enumerate(texts)]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    assert found == {n: " ".join(text.split()) for n, text in enumerate(texts)}


def test_rows_without_id_and_url_keep_their_own_words(spark):
    menu = "home about us contact news sport weather"
    rows = [(n, None, f"<div>{menu}</div><p>{n} page</p>") for n in (1, 2, 3, None)]
    rows += [(None, None, "<p>this row has words where another row has a menu and keeps them</p>")]
    found = sorted(r.text for r in extraction.extract(pages(spark, rows)).collect())
    assert found == ["1 page", "2 page", "3 page", "None page", "this row has words where another row has a menu and keeps them"]


def test_covered_words_are_those_of_all_long_common_substrings(spark):
    """Against every pair of pages and every start, word by word."""
    streams = ["a b c d e f g h i j", "x a b c d e f y d e f g h i j z", "f g h i j k l m", "q r s"]
    rows = [(n, "http://h/", f"<p>{s}</p>") for n, s in enumerate(streams)]
    rows = [(n, f"{u}{n}", h) for n, u, h in rows]
    found = {r.page_id: r.text for r in extraction.extract(pages(spark, rows)).collect()}
    split, run = [s.split() for s in streams], extraction.RUN
    for n, words in enumerate(split):
        gone = set()
        for i in range(len(words) - run + 1):
            if any(words[i:i + run] == other[j:j + run] for m, other in enumerate(split) if m != n
                   for j in range(len(other) - run + 1)):
                gone |= set(range(i, i + run))
        assert found[n] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_awkward_rows(spark):
    rows = [(1, None, None), (None, "http://h/", "<p>x</p>"), (1, None, None), (2, "", "<article></article>"),
            (3, "http://h/", "<nav>only</nav>"), (4, "no url", "<article>" + "word " * 50_000 + "</article>")]
    found = extraction.extract(pages(spark, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((repr(r.page_id), r.n_chars) for r in found.collect()) == sorted(
        [("1", 0), ("1", 0), ("None", 1), ("2", 0), ("3", 0), ("4", 249_999)])
    assert collected(extraction.extract(pages(spark, []))) == []
