from helpers import empty

from nearkin.llm import page_template as P

FRAME = ('<html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">{n}</a></li></ul></nav>'
         '<div class="ad">buy {n}</div>{main}<div class="comments"><p>first! {n}</p></div><footer>&copy; site</footer></body></html>')


def text(html, main=None):
    return P.main_text(P.Walker(), html, main)


def test_roles_and_blocks():
    article = "<article><h1>A &amp; B</h1><p>one\n two<br>three <b>bold</b></p><p>four<p>five<aside>not this</aside><form>nor this</form></article>"
    assert text(FRAME.format(n=1, main=article)) == "A & B\n\none two three bold\n\nfour\n\nfive"
    assert text("<main><p>in</p></main><p>out</p>") == "in"
    assert text("<p>a<p>b &lt;c&gt;") == "a\n\nb <c>"
    assert text("<article><p>cut off he<b>re</b> &am") == "cut off here &am"
    assert text("<article><p>cut tag</p><p cla") == "cut tag"
    assert text("<article><header class='post-header'><h1>Title</h1></header><p>x</p></article><header>site</header>") == "Title\n\nx"
    assert text("<article><p>x<!-- <p>no</p> -->y</p><noscript>z</noscript></article>") == "xy"
    assert text("<div class='with-sidebar'><p>kept</p></div><div id='sidebar'>gone</div>") == "kept"
    assert text("") == "" and text("  \n ") == "" and text("<nav>only</nav>") == ""


def test_names_remove_parts_and_never_the_whole():
    article = "<article><h1>Title</h1><p>" + "the story goes on. " * 9 + "</p><aside>not this</aside><div class='share'>nor this</div></article>"
    want = "Title\n\n" + "the story goes on. ".strip() + " the story goes on." * 8
    for wrapped in ("<div class='page-with-sidebar'>{}<div class='sidebar'>beside</div></div>", "<div id='search-results'>{}</div>",
                    "<form id='aspnetForm'><div class='menu'>menu</div>{}<input></form>", "<div class='login-widget'><aside>{}</aside></div>"):
        page = "<html><body><nav>home</nav>" + wrapped.format(article) + "<footer>low</footer></body></html>"
        assert text(page) == want
        walker = P.Walker()
        main = next(e.path for kind, e, _ in walker.walk(page) if kind == "open" and e.name == "article")
        assert text(page, main) == want and not any(v[2] for (path, _), v in P.page_tokens(walker, page).items() if path == main)
    assert text("<form action='/'><p>" + "all of it in a form " * 5 + "</p><select><option>no</select></form>") == ("all of it in a form " * 5).strip()
    # parts stay parts: a few words of an article in a sidebar, a small form, what is hidden
    assert text("<div class='story'>" + "long text " * 9 + "</div><div class='sidebar'><article>teaser</article></div>") == ("long text " * 9).strip()
    assert text("<p>text that is longer</p><form>name</form>") == "text that is longer"
    assert text("<p>seen</p><div hidden><article>a long text that is hidden</article></div>") == "seen"


def test_deep_and_long_pages():
    assert text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    words = "word " * 200_000
    assert text(f"<article><p>{words}</p></article>") == words.strip()
    assert text("<" * 2000) in ("", "<" * 1999, "<" * 2000)


def test_template_finds_the_main_slot_without_names(spark):
    def page(n):
        body = "".join(f"<div class='para'>sentence {n} {i} of the body text, long enough to matter</div>" for i in range(3 + n % 4))
        return f"<html><body><div class='top'><a href='/'>home</a> page {n}</div><div class='story'>{body}</div><div class='low'>number {n}</div></body></html>"

    rows = [(n, f"http://one.example/{n}", page(n)) for n in range(20)] + [(99, "http://two.example/", page(99))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r.page_id: r for r in P.extract(df).collect()}
    for n in range(20):
        want = "\n\n".join(f"sentence {n} {i} of the body text, long enough to matter" for i in range(3 + n % 4))
        assert found[n].text == want and found[n].n_chars == len(want)
    assert "number 99" in found[99].text  # a single page has no template


def test_equal_vectors_make_a_class(spark):
    rows = [(n, "http://h.example/x", FRAME.format(n=n, main="<article>" + "<p>t</p>" * n + "</article>")) for n in range(1, 7)]
    pages = spark.createDataFrame(rows, "page string, url string, html string")
    vectors = P.occurrence_vectors(pages).collect()
    classes = {}
    for v in vectors:
        classes.setdefault((v.pages, v.total, v.vector), []).append((v.kind, v.closing, v.total))
    # article opens and closes once a page, its paragraphs n times
    assert any({(3, False, 6), (3, True, 6)} <= set(c) for c in classes.values())
    assert any({(1, False, 21), (1, True, 21)} <= set(c) for c in classes.values())
    assert not any({(3, False, 6), (1, False, 21)} <= set(c) for c in classes.values())


def test_repeated_text_is_template(spark):
    def page(n):
        notice = "<p>Join our weekly letter for free today.</p>" if n % 2 else ""
        return (f"<html><body><article><p>Story {n} begins <i>with own</i> words.</p>{notice}<p>It ends as number {n}.</p>"
                f"<p>All rights belong to the paper.</p></article></body></html>")

    rows = [(n, f"http://one.example/{n}", page(n)) for n in range(12)]
    # copies of a page are no template of each other, and neither is what two pages say
    rows += [(100 + n, f"http://two.example/{n}", "<article><p>the same story again</p></article>") for n in range(6)]
    rows += [(200 + n, f"http://three.example/{n}", f"<article><p>said by two of them</p><p>part {n}</p></article>") for n in range(2)]
    found = {r.page_id: r.text for r in P.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for n in range(12):
        assert found[n] == f"Story {n} begins with own words.\n\nIt ends as number {n}."
    assert {found[100 + n] for n in range(6)} == {"the same story again"}
    assert {found[200 + n] for n in range(2)} == {f"said by two of them\n\npart {n}" for n in range(2)}


def test_tags_of_one_element_are_no_class_and_small_articles_no_main_slot(spark):
    lone = [(n, "http://h.example/", "<div>" + "<article>" * (n % 3) + "text") for n in range(9)]
    frame = "<body><article>teaser {0}</article><div class='story'><p>" + "the long story of {0} goes on. " * 9 + "</p></div></body>"
    rows = lone + [(n, "http://i.example/", frame.format(n)) for n in range(9, 20)]
    pages = spark.createDataFrame(rows, "page string, url string, html string")
    mains = {r.host: r.main for r in P.templates(P.occurrence_vectors(pages)).collect()}
    walker = P.Walker()
    named = {e.path: e for _ in [list(walker.walk(rows[-1][2]))] for e in walker.seen.values()}
    assert named[mains["i.example"]].name != "article"


def test_odd_rows(spark):
    rows = [(1, None, None, 1, "m"), (None, "nonsense", "<article>a</article>", None, None), (2, "http://h/", "", 1, "m")]
    rows += [(3, "http://h/", "<article>b</article>", 1, "m")] * 3
    df = spark.createDataFrame(rows, "page_id long, url string, html string, _host int, main string")
    found = P.extract(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, (tuple(r)[2:] for r in found.collect()))) == sorted(map(repr, [("", 0), ("a", 1), ("", 0), *[("b", 1)] * 3]))
    assert P.extract(empty(spark, "page_id long, url string, html string")).count() == 0
