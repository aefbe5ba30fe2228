import time

from pyspark.sql import functions as F

from homelake.functions import html as H
from homelake.functions.dom import Page
from homelake.plans import crawl


def one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("v")).first().v


def text_of(spark, page, *selector, **how):
    return one(spark, page, H.text_or_null(H.fields("html", {"t": H.element(*selector, **how)})["t"]))


def test_first_text(spark):
    page = "<!-- <h1>no</h1> --><script>'<h1>no</h1>'</script><H1 id=1>\n a <b>&amp;lt;</b>&nbsp;</H1><h1>second</h1>"
    assert text_of(spark, page, "h1") == "a &lt;"
    assert text_of(spark, "<h1> &nbsp; </h1><h1>second</h1>", "h1") is None
    assert text_of(spark, "<p>x</p>", "h1") is None
    assert text_of(spark, None, "h1") is None and text_of(spark, "", "h1") is None


def test_class_names_are_whole_words(spark):
    page = '<div class="item-title">a</div><div class="x item y">b<div>c</div>d</div>'
    assert text_of(spark, page, "div", "item") == "bcd"
    assert text_of(spark, page, "div", exact_class="item") is None
    assert text_of(spark, page, "div", "item", "y") == "bcd"
    assert text_of(spark, "<div class=a.b>1</div><div class='a+b'>2</div>", "div", "a+b") == "2"


def test_any_depth_and_all_references(spark):
    page = '<div class="i"><div><div>x<div>y</div></div></div>z</div><div class="i">no</div>'
    assert text_of(spark, page, "div", "i") == "xyz"
    assert text_of(spark, "<p>Ph&ograve;ng &#273; &#x1EA5; &lt;b&gt; &copy &nosuch;</p>", "p") == "Phòng đ ấ <b> © &nosuch;"
    assert text_of(spark, "<div class=i><p>open<b>too</div>after", "div", "i") == "opentoo"
    assert text_of(spark, "a < b <br> <i>c</i> </u> d", "i") == "c"


SPEC = '<div class="i"><span class="t">{}</span>{}</div>'
VALUE = '<span class="v">{}</span>'


def items(*pairs):
    return "".join(SPEC.format(t, "" if v is None else VALUE.format(v)) for t, v in pairs)


def labelled(page, spark, **how):
    items = H.Items(H.element("div", "i"), H.element("span", "v"), H.element("span", "t"))
    return one(spark, page, H.value_of(H.fields("html", items={"x": items})["x"], "Giá", **how))


def test_first_label_with_a_value_element_decides(spark):
    assert labelled(items(("Khoảng GIÁ", "5 tỷ"), ("giá", "6")), spark) == "5 tỷ"
    assert labelled(items(("giá", None), ("giá", "6")), spark) == "6"
    assert labelled(items(("giá", " "), ("giá", "6")), spark) == ""
    assert labelled(items(("giá", " "), ("giá", "6")), spark, default=None, skip_blank=True) == "6"
    assert labelled(items(("x", "6")), spark) == ""
    assert labelled(items(("giá", "")), spark, default=None, skip_blank=True) is None


def test_icon_items(spark):
    page = ('<span class="c"><i class="a icon-1--sm"></i><span class="v">one</span></span>'
            '<span class="c"><i class="a icon-1"></i><span class="v"> two </span></span>')
    cards = H.Items(H.element("span", "c"), H.element("span", "v"))
    assert one(spark, page, H.value_of(H.fields("html", items={"x": cards})["x"], " icon-1 ")) == "two"


def test_links(spark):
    page = ('<a href="/a?x=1&amp;y=2" class="l">1</a><a class="m l" href=\'https://h.vn/b\'>2</a><a class="l" href="https://o.vn/c">3</a>'
            '<a class="ll" href="/d">4</a><a class="l" href="/a?x=1&amp;y=2">5</a><a class="l">6</a><a class="l" href="//h.vn/e">7</a>'
            '<a class="l" href="f.html">8</a><a class="l" href="#g">9</a><a class="l" href="mailto:x@h.vn">10</a><a href="/a\'b" class=l>11</a><a class=l href=/d>12</a><a class=\'l\' href="/x/../e">13</a><!--<a class="l" href="/no">-->')
    pages = spark.createDataFrame([("https://h.vn/list/p1?q=1", page)], "url string, html string")
    links = crawl.listing_links(pages, F.lit("https://h.vn"), "l").orderBy("position")
    assert [r.subpage_url for r in links.collect()] == [
        "https://h.vn/a?x=1&y=2", "https://h.vn/b", "https://h.vn/a?x=1&y=2", "https://h.vn/e", "https://h.vn/list/f.html",
        "https://h.vn/list/p1?q=1#g", "https://h.vn/a'b", "https://h.vn/d", "https://h.vn/e",
    ]


def test_payloads_are_split_and_whole(spark):
    items = spark.range(1000).select(
        F.when(F.col("id") < 900, "u/p0").when(F.col("id") < 990, "u/p1").otherwise("elsewhere").alias("main_page_url"),
        F.col("id").alias("post_id"),
    )
    payloads = crawl.page_payloads(crawl.items_per_page(crawl.seed_pages(spark, "u/", 0, 2), items), items, ["post_id"], "post_id", chunk_size=100)
    rows = payloads.collect()
    assert {r.main_page_url: r.subpage_count for r in rows} == {"u/p0": 900, "u/p1": 90, "u/p2": 0}
    assert max(len(r.subpage_data) for r in rows) < 200
    assert sorted(i.post_id for r in rows for i in r.subpage_data) == list(range(990))


def texts(page, tag):
    page = Page(page)
    return [page.text(e) for e in page.find_all(tag)]


def test_end_tags_that_a_page_leaves_out():
    assert texts("<ul><li>one<li>two<ul><li>a<li>b</ul><li>three</ul>", "li") == ["one", "twoab", "a", "b", "three"]
    assert texts("<p>a<p>b<div>c</div>d", "p") == ["a", "b"]
    assert texts("<div><p>a</div>b<p>c<ul><li>d</ul>", "p") == ["a", "c"]
    assert texts("<table><tr><td>1<td>2<tr><td>3<td><table><tr><td>x<td>y</table>z</table>", "td") == ["1", "2", "3", "xyz", "x", "y"]
    assert texts("<table><thead><tr><th>a<tbody><tr><th>b<td>c</table>d", "tr") == ["a", "bc"]
    assert texts("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "dd") == ["b", "d"]
    assert texts("<select><option>a<option>b</select>c", "option") == ["a", "b"]
    assert texts("<h1>a<h2>b</h2>c", "h1") == ["a"]
    assert texts("<head><title>a<b></title><p>c", "head") == ["a<b>"]


def test_end_tags_that_end_nothing():
    assert texts("<div><span>a</div>b</span>c", "div") == ["a"]
    assert texts("<span>a<div>b</span>c</div>d</span>e", "span") == ["abcd"]
    assert texts("<table><tr><td>a</div></p>b</td></tr></table>", "td") == ["ab"]
    assert texts("<div><table><tr><td>a</div>b</table>c</div>d", "div") == ["abc"]


def test_time_grows_with_the_page():
    """Each case took time by the square of its size with a search through what is open."""
    block = '<div class="i"><span class="t">x</span><span class="v">y</span></div>'
    cases = {
        "items": block, "stray": "<div></u>", "open": "<div><b>", "paragraphs": "<p><i>x", "lists": "<ul><li>", "tables": "<table><tr><td>",
    }
    for name, part in cases.items():
        seconds = []
        for n in (3000, 24_000):
            best = []
            for _ in range(3):
                start = time.process_time()
                page = Page(part * n)
                found = sum(1 for e in page.find_all("div", ("i",)) for _ in page.find_all("span", ("v",), inside=e))
                best.append(time.process_time() - start)
            assert found == (n if name == "items" else 0)
            seconds.append(min(best))
        assert seconds[1] < 30 * seconds[0] + 0.2, (name, seconds)


def test_fields_of_pages_with_open_items(spark):
    page = '<ul><li class="i"><span class="t">Giá<span class="v">5</span><li class="i"><span class="t">Khu</span><span class="v">x</ul>after'
    found = one(spark, page, H.fields("html", items={"x": H.Items(H.element("li", "i"), H.element("span", "v"), H.element("span", "t"))})["x"])
    assert [(r.label, r.value) for r in found] == [("Giá5", "5"), ("Khu", "x")]


def test_choices_are_made_while_a_page_is_read_once(spark):
    """The value of the first fitting item with a value element, as ``value_text`` finds it in the list."""
    from homelake.plans.crawl import listing_records

    items = H.Items(H.element("li", "i"), H.element("span", "v"), H.element("b"))
    page = (
        "<li class=i><b>GIÁ</b><li class=i><b>giá x</b><span class=v> </span><li class='i'><b>Giá</b><span class=v> 2&nbsp;</span>"
        "<li class=i><span class=v>no label</span><li class=i><b>Đường</b><span class='v w'>3</span>"
    )
    choices = {"a": H.Choice(items, "Giá"), "b": H.Choice(items, "giá", skip_blank=True), "c": H.Choice(items, "ĐƯỜNG"), "d": H.Choice(items, "none")}
    rows = spark.createDataFrame([(page,), (None,), ("",)], "html string").select(H.fields("html", {"t": H.element("b")}, {"x": items}, choices).alias("f"))
    found = rows.select(*[H.trimmed(f"f.{n}").alias(n) for n in choices], *[H.value_text("f.x", c.label, c.skip_blank).alias(f"{n}2") for n, c in choices.items()])
    assert [tuple(r)[:4] for r in found.collect()] == [tuple(r)[4:] for r in found.collect()]
    assert tuple(found.first())[:4] == ("", "2", "3", None)

    # Records of pages need no list of items, which took most of a record's time outside of the parser.
    pages = spark.createDataFrame([("m", "u", page)], "main_page_url string, url string, html string")
    plan = listing_records(pages, F.lit("t"), F.lit("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and "lambda" not in plan


def test_tags_are_told_by_how_they_are_written():
    from homelake.functions import dom

    page = "<div class='a b' id=1><span class=v>x</span></div>"
    first, second = Page(page * 3), Page(page)
    assert list(first.find_all("div", ("b", "a"))) == [0, 2, 4] and second.first("div", ("c",)) is None
    assert dom._TOKENS["<div class='a b' id=1>"][0] == "div" and dom._READ[" class='a b' id=1"] == {"class": "a b", "id": "1"}
    # What is kept is bounded, in number and in length.
    for n in range(dom._MOST + 10):
        Page(f"<p class=c{n}>").first("p", (f"c{n}",))
    assert len(dom._TOKENS) <= dom._MOST and len(dom._READ) <= dom._MOST and len(dom._MATCHING) <= dom._MOST
    long = f"<p class='{'z' * dom._LONG}'>"
    assert Page(long).first("p", ("z" * dom._LONG,)) == 0 and long not in dom._TOKENS


def found_by_page(page, selectors):
    """For each selector, what ``Marked`` is to find: text, attributes and number of elements inside for each selector."""
    page = Page(page)
    return [
        [("".join(page.texts[page.starts[e] : page.ends[e]]), page._raw[e], [len(list(page.find_all(*s, inside=e))) for s in selectors])
         for e in page.find_all(*selector)]
        for selector in selectors
    ]


def found_by_marked(marked, page):
    marked.read(page)
    inside = lambda numbers, e: sum(e < n <= marked.lasts[e] for n in numbers)
    return [
        [("".join(marked.texts[marked.starts[e] : marked.ends[e]]), marked.raws[e], [inside(numbers, e) for numbers in marked.found])
         for e in found]
        for found in marked.found
    ]


def test_marked_elements_are_those_of_the_page(monkeypatch):
    import random

    from homelake.functions import dom

    pick = random.Random(5)
    tags = "div span b i p li ul table tr td a h1 h2 button option select title textarea script style head body br IMG Tbody".split()
    written = ["", " class=i", " class='v i'", ' data-x="a>b" class="i"', " class='&#105;'", " id=1"]
    other = ["x", " ", "&amp;", "<!-- <b> -->", "a < b", "<", ">", "</", "'", "<!x>", "<!-- c", "</Script >"]

    def part():
        tag, kind = pick.choice(tags), pick.random()
        return f"<{tag}{pick.choice(written)}>" if kind < 0.45 else f"</{tag}>" if kind < 0.75 else pick.choice(other)

    selectors = (("div", ("i",), None), ("span", ("v", "i"), None), ("li", (), "i"), ("b", (), None), ("td", (), None), ("p", (), None),
                 ("textarea", (), None), ("br", (), None), ("h1", ("i",), None), ("head", (), None))
    pages = ["".join(part() for _ in range(pick.randrange(50))) for _ in range(1500)]
    pages += ["<div class=i>" * n + "x" + "</div>" * n + "<b>y" for n in (1, 99, 100, 101, 300)] + ["", ">", "<b>1<b class=i>2</b>"]
    for most, first in ((10_000, 10**6), (200, 300)):
        monkeypatch.setattr(dom, "_MOST", most)
        monkeypatch.setattr(dom, "_FIRST", first)
        marked = dom.Marked(selectors)
        for page in pages + pages[:100]:
            assert found_by_marked(marked, page) == found_by_page(page, selectors), page
        assert len(marked._meanings) <= most


def test_markup_between_texts_is_read_once(monkeypatch):
    """A run of tags met again between other texts is looked up whole; it was read tag by tag on each page."""
    from homelake.functions import dom

    page = '<ul><!-- c --><li class="i"><span class="t">{0}</span><br></li><li class=i><b>{0}</b></li></ul><p>{0}'
    marked = dom.Marked((("li", ("i",), None), ("span", ("t",), None)))
    for text in ("1", "2"):
        marked.read(page.format(text))
    kept = marked._kept

    def fail(*_):
        raise AssertionError

    for name in ("_run", "_step", "_read_whole"):
        monkeypatch.setattr(marked, name, fail)
    marked.read(page.format("3"))
    assert (marked.texts, marked.found, marked.lasts, marked.raws[1]) == (["3", "3"], [[0, 2], [1]], [1, 1, 2], ' class="t"')
    assert marked._kept == kept


def test_tags_that_no_page_repeats_are_not_kept_as_runs():
    from homelake.functions import dom

    marked = dom.Marked((("a", ("i",), None),))
    for n in range(3 * dom._MOST):
        marked.read(f'<p><a class=i href="/{n}">x</a></p>')
    assert marked.found == [[0]] and marked._kept < 50 and len(marked._meanings) <= dom._MOST


def test_time_of_marked_elements_grows_with_the_page():
    from homelake.functions import dom

    block = '<div class="i"><span class="t">x</span><span class="v">y</span></div>'
    cases = {"items": block, "stray": "<div></u>", "open": "<div><b>", "lists": "<ul><li>", "one run": "<div class=i><br></div>", "not tags": "x < y "}
    for name, part in cases.items():
        seconds = []
        for n in (3000, 24_000):
            best = []
            for _ in range(3):
                marked = dom.Marked((("div", ("i",), None), ("span", ("v",), None)))
                start = time.process_time()
                marked.read(part * n)
                best.append(time.process_time() - start)
            assert len(marked.found[0]) == (n if "class" in part else 0)
            seconds.append(min(best))
        assert seconds[1] < 30 * seconds[0] + 0.2, (name, seconds)


def test_blank_pages_are_told_from_their_front(spark):
    pages = [None, "", " \n\u00a0 ", "\u2003", " \n x", "<p>"]
    rows = spark.createDataFrame([("m", str(i), p) for i, p in enumerate(pages)], "main_page_url string, url string, html string")
    records = crawl.listing_records(rows, F.lit("t"), F.lit("s"))
    assert [(r.error, r.crawled_at) for r in records.orderBy("subpage_url").collect()] == [("empty_item", None)] * 4 + [(None, "t")] * 2
    # The whole page was trimmed from both ends for every column.
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ltrim(html") == 1 and "(trim(html" not in plan
