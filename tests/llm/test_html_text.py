import random

import pytest

from tillstar.llm.html_text import Page, _keyed, extract, subtrees, templates


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<p>a<b>b</p>c", "ab\nc"), ("<p>a <br>b\n\tc&nbsp;d</p>", "a b c d"),
    ("<title>t</title><body><nav>n</nav><article><h1>H</h1><p><b>x<br><p>y</article><footer>f</footer>", "H\nx\ny"),
    ("<script>var t='</p>';</script><style>p{}</style><p>z</p>", "z"), ("<script>never closed <p>a</p>", ""), ("<!-- <p>a</p> --><p>b</p><!-- c", "b"),
    ("<div class='ad top'>x</div><div id=cookie-notice>y</div><div class='adult'>z</div>", "z"), ("<article>a<div class='comments'><p>c</p></div>b</article>", "a\nb"),
    ("<main>a</main><div>b</div><article>c</article>", "a\nc"), ("<article> </article><p>b</p>", "b"), ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"), ("<p title='a>b'>c</p>", "c"), ("<p title='a>c</p>", "c"), ("a < b <3 & c", "a < b <3 & c"), ("<p>a</p><div cla", "a"),
    ("<p>x &am</p>", "x &am"), ("<header>h</header><article><header><h1>t</h1></header>b</article>", "t\nb"), ("<div hidden>a</div><p aria-hidden=\"true\">b</p>c", "c"),
    ("<form>f<input>g</form><aside>s</aside><button>k</button>e", "e"), ("&lt;p&gt; &#233; &quot;", '<p> é "'), ("<div>" * 3000 + "deep", "deep"), ("</p></div>a", "a"),
])
def test_blocks(source, text):
    assert Page(source).main_text() == text


def site(body, k):
    return f"<html><body><div><a href='/{k}'>Home of the site</a></div>{body}<div>Imprint and contact</div></body></html>"


def test_templates_are_cut_per_host(spark):
    rows = [(i, f"http://A.example/{i}", site(f"<div><p>own text {i}</p></div>", 1)) for i in range(30)]
    rows += [(100 + i, f"http://b.example/{i}", site(f"<div>rare {i}</div>", i)) for i in range(5)]  # too few pages to tell
    rows += [(200 + i, "http://c.example/", site("<div>same page</div>", 0)) for i in range(40)]  # one page, forty times
    rows += [(300 + i, f"http://d.example/{i}", f"<article><p>shared passage</p><p>own {i}</p></article>") for i in range(30)]
    rows += [(400, None, None), (401, None, ""), (None, "no url", "<p>x</p>"), (402, "http://u@e.example:80/", "<p>y</p>" + "<p>long</p>" * 20000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, cuts int")
    found = extract(frame).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert all(by_id[i].text == f"own text {i}" for i in range(30))
    assert by_id[100].text == "Home of the site\nrare 0\nImprint and contact"
    assert by_id[239].text == "Home of the site\nsame page\nImprint and contact"
    assert by_id[305].text == "shared passage\nown 5"
    assert [by_id[k].text for k in (400, 401, None)] == ["", "", "x"] and by_id[402].text.count("long") == 20000
    assert all(r.n_chars == len(r.text) for r in found) and by_id[3].url == "http://A.example/3"
    assert extract(frame.limit(0)).count() == 0


def test_every_subtree_is_counted():
    page = Page("<html><head><title>t</title></head><body><nav><ul><li><a>x</a></ul></nav><div class=ad>y</div><article><h1>h</h1><ul><li>z</ul><p>p</article><footer>f</footer>")
    assert sorted(inside for inside, _ in page.counted.values()) == [False] * 8 + [True]  # head, title, nav, ul, li, a, ad, footer; the list of the article


def plain_templates(rows):
    """(host, subtree) by counting over the whole small table."""
    on, pages = {}, {}
    for _, url, source in rows:
        host, page = url.split("/")[2], Page(source)
        keys = {False: source, True: page.main_text()}
        for inside in {False, *(flag for flag, _ in page.out if flag)}:
            pages.setdefault((host, inside), set()).add(keys[inside])
        for subtree, (inside, part) in page.counted.items():
            on.setdefault((host, inside, subtree, part), set()).add(keys[inside])
    return {(h, s) for (h, inside, s, part), k in on.items() if len(k) >= 10 and (len(k) >= 0.2 * len(pages[h, inside]) or len(k) >= 100 and not part)}


def test_counts_by_article_texts(spark):
    rows = [(i, f"http://e.example/{i}", f"<nav>menu</nav><article><ul><li>Read more</ul><p>own {i}</p></article><footer>f {i}</footer>") for i in range(30)]
    rows += [(100 + i, f"http://f.example/{i}", f"<p>page {i}</p><article><div><p>copied</p></div></article>") for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    by_id = {r.page_id: r.text for r in extract(frame).collect()}
    assert all(by_id[i] == f"own {i}" and by_id[100 + i] == "copied" for i in range(30))
    got = {(r.host, r.subtree) for r in templates(subtrees(_keyed(frame))).collect()}
    assert got == plain_templates(rows) and len(got) == 2  # the menu and the list


def test_counts_act_on_the_registered_pages(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in frame.collect() if r.url and r.html]
    got = {(r.host, r.subtree) for r in templates(subtrees(_keyed(spark.createDataFrame(rows, "page_id long, url string, html string")))).collect()}
    assert got == plain_templates(rows) and got


def test_many_pages_make_a_template_on_a_host_of_any_size(spark):
    rows = [(i, f"http://g.example/{i}", f"<p>own {i}</p>" + "<div>section menu</div><table><tr><td>0<td>{i}</table>".replace("{i}", str(i)) * (i < 100)) for i in range(1000)]
    rows += [(2000 + i, f"http://h.example/{i}", f"<p>own {i}</p>" + "<div>section menu</div>" * (i < 99)) for i in range(1000)]
    by_id = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(by_id[i] == f"own {i}\n0 {i}" for i in range(100)) and by_id[500] == "own 500"
    assert by_id[2005] == "own 5\nsection menu"


def test_only_subtrees_that_hold_text_are_sent_back_to_their_pages(spark):
    body = "<nav><ul><li>menu</ul></nav><div class='ad'><p>buy</p></div><div><nav>n</nav></div><div><span>site line</span></div><script>s</script>"
    rows = [(i, f"http://i.example/{i}", f"{body}<p>own {i}</p>") for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = subtrees(_keyed(frame))
    live = found.where("live").select("page", "subtree").distinct()
    # the div and the span of the site line, the div whose menu leaves a block end, and the page's own paragraph
    assert live.groupBy("page").count().select("count").distinct().collect() == [(4,)]
    assert {(r.host, r.subtree) for r in templates(found).collect()} == plain_templates(rows)
    assert templates(found).where("rows > 0").count() == 3 and templates(found).count() > 8
    assert {r.text for r in extract(frame).collect()} == {f"own {i}" for i in range(30)}


def test_cuts_of_what_holds_no_text_change_nothing():
    rng = random.Random(5)
    pieces = ["<div>", "</div>", "<span>", "</span>", "<nav>", "</nav>", "<p>", "<ul><li>", "</ul>", "<article>", "</article>", "<div class=ad>", "<table><td>", "</table>", "<br>", "a", "b ", "c"]
    for _ in range(400):
        source = "".join(rng.choices(pieces, k=25))
        page = Page(source)
        live = {value for value, _ in page.held}
        assert live <= set(page.counted)
        for _ in range(5):
            cuts = frozenset(rng.sample(sorted(page.counted), k=len(page.counted) // 2))
            assert Page(source, cuts).main_text() == Page(source, cuts & live).main_text()
