from docspark.llm import html


def text_of(source):
    blocks, _ = html.candidates(html.read(source))
    return "\n".join(t for _, t in blocks)


def test_article_without_its_surroundings():
    page = """<html><head><title>t</title><style>p{}</style><script>if(a<b)"</p>"</script></head><body>
    <nav><ul><li><a href="/a">menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
    <div class="sidebar">side</div><article><h1>Title &amp; more</h1><p><b>One<br>two<p>three
    <span class="ad">BUY</span> four</p><form><input>mail</form><aside>see also</aside>
    <section class="comments"><p>first!</p></section></article><footer>foot</footer>"""
    assert text_of(page) == "Title & more\nOne two\nthree four"


def test_stray_and_unclosed_markup():
    assert text_of("a < b &lt; c &am <!-- x > y --> d <p title=\"unclosed>q</p> z") == "a < b < c &am d\nq\nz"
    assert text_of("</div></p>x<b>y</b>z<table><tr><td>1<td>2</table>") == "xyz\n1\n2"
    assert text_of("<ul><li>a<li>b</ul><div>abc <span class=ad><div>x</div></span> def</div>") == "a\nb\nabc def"
    assert text_of("") == "" and text_of("<!-- open") == ""


def test_main_serves_where_there_is_no_article():
    assert text_of("<div>out</div><main><p>in</p></main>") == "in"
    assert text_of("<p>only</p><ul><li><a>link one</a></ul>") == "only"


def test_classes_of_wrappers_and_articles():
    page = '<div class="page has-sidebar"><article class="post nav-item"><p>in</p></article></div>'
    assert text_of(page) == "in"
    assert text_of('<article><p>in</p><article class="comment"><p>out</p></article></article>') == "in"


def test_tree_removes_what_a_host_repeats(spark):
    rows = [
        (i, f"http://h{i % 2}.example/{i}", f"<div class=top>Same words here</div><p>Text of its own number {i}</p>")
        for i in range(20)
    ]
    rows += [(100, None, None), (101, "no host", ""), (102, "http://h0.example/x", "<p>Text</p>" * 3), (102, "x", "y")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in html.extract(pages).collect()}
    assert len(found) == len(rows)
    for i in range(20):
        text = f"Text of its own number {i}"
        assert found[i, f"http://h{i % 2}.example/{i}"] == (text, len(text))
    assert found[100, None] == ("", 0) and found[101, "no host"] == ("", 0)
    assert found[102, "http://h0.example/x"][0] == "Text\nText\nText"
    low = html.importance(pages).where("pages >= 5 AND importance < 0.35").count()
    assert low >= 2


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(empty).collect() == []


def test_tree_judges_main_outside_its_articles(spark):
    top = "<div class=top>Same words here</div>"
    page = "<main>{}<p>Text of number {}</p><article><p>Same teaser</p></article></main>"
    plain = "<main>{}<p>Text of number {}</p></main>"
    rows = [(i, f"http://h{i % 2}.example/{i}", (page if i % 2 else plain).format(top, i)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html.extract(pages).collect()}
    for i in range(20):
        assert found[i] == f"Text of number {i}" + "\nSame teaser" * (i % 2)


def test_nothing_is_lost_behind_raw_elements():
    assert text_of("<article><p>İİİ</p><script>x</script><p>after</p></article>") == "İİİ\nafter"
    assert text_of("<article><p>a</p><style>x</STYLE ><p>b</p></article>") == "a\nb"
    assert text_of("<title>x</titlefoo></title><p>after</p>") == "after"
    assert text_of('<article><p>a</p><svg viewBox="0"/><p>after</p><svg><text>t</text></svg>end</article>') == "a\nafter\nend"


def test_formulas_stay_in_their_sentence():
    page = "<article><p>Let <math><mi>x</mi><annotation>x_tex</annotation></math> be</p></article>"
    assert text_of(page) == "Let x be"


def test_article_text_is_not_cut_by_words_of_its_ids():
    page = """<article><h2 id="related-work">Related work</h2><section id="discussion"><p>We discuss.</p></section>
    <section id="search-algorithms">Search</section><p class="notice-period">Two weeks</p>
    <div class="comment-list"><p>first!</p></div><div id="comments">second!</div><div class="social share">s</div></article>"""
    assert text_of(page) == "Related work\nWe discuss.\nSearch\nTwo weeks"


def test_deep_nesting_takes_little_room():
    depth = 40_000
    page = html.read("<div class=a>" * depth + "text" + "</div>" * depth)
    assert [b[4] for b in page.blocks] == ["text"]


def test_nodes_differ_in_every_word_of_their_names():
    page = html.read('<div class="a b c d e">x</div><div class="a b c d f">y</div>')
    assert len({b[0] for b in page.blocks}) == 2


def test_a_page_without_id_and_a_long_page(spark):
    rows = [(None, "http://h/1", "<p>one</p>"), (2, "http://h/2", "<p>" + "long " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.n_chars for r in html.extract(pages).collect()}
    assert found == {None: 3, 2: 999_999}
