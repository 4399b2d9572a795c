import pytest

from glossa.llm import html_extract as H
from glossa.llm import site_lines as S

PAGE = "page_id long, url string, html string"


def page(body, around=True):
    menu = "<nav><ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul></nav>" if around else ""
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{menu}{body}<footer>&copy; us</footer></body></html>"


@pytest.fixture(scope="module")
def pages(spark):
    words = "river valley stone bridge winter garden market village harbour mountain forest meadow".split()
    rows = []
    for k in range(60):
        text = [" ".join(words[(k * 7 + i * j) % 12] for i in range(14)).capitalize() + "." for j in range(1, 5)]
        rows.append((k, f"https://h{k % 4}.example.org/{k}", page("<article><h1>" + text[0][:20] + "</h1>" + "".join(f"<p>{t}</p>" for t in text) + "</article><div class='ad'>Buy now</div>")))
    return spark.createDataFrame(rows, PAGE)


def test_blocks_of_bad_markup():
    texts = lambda h: [b.text for b in H.blocks(h)]
    assert texts("<p><b>one&amp;two<br>three<p>fo<i>ur</i>\n\n five<div>six") == ["one&two three", "four five", "six"]
    assert texts("<script>if (a < b) '</p>'</script><!-- no <p>x</p> -->a<style>b</style>c &#x41;&eacute;&nbsp;d") == ["ac Aé d"]
    assert texts("") == texts("<p></p>") == texts("<script>never closed") == []
    assert texts("a < b and c > d") == ["a < b and c > d"]
    assert texts("<p title='>'>x</p><p>y<") == ["x", "y<"]
    assert len(texts("<div>" * 3000 + "deep")) == 1


def test_article_blocks_come_out(spark, pages):
    extra = [(100, None, None), (101, "http://a", ""), (102, "", "<p>"), (100, None, None),
             (103, "u", page("<div class='cookie-notice'><p>We use cookies here</p></div><article><h1>T</h1><p>First part of the text.</p><aside class='related'>See also this</aside>"
                             "<p>Second part of the text.</p></article><section id='comments'><div class='comment'><p>I liked the first part very much indeed.</p></div></section>"
                             "<form><label>Mail</label><button>Send</button></form>"))]
    got = {r.page_id: r for r in H.extract(pages.union(spark.createDataFrame(extra, PAGE)).withColumn("text", H.F.lit("clash"))).collect()}
    assert len(got) == 64
    for r in pages.collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        want = " ".join(" ".join(body.replace("<h1>", " ").replace("</h1>", " ").replace("<p>", " ").replace("</p>", " ").split()).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)
    assert all(got[k].text == "" and got[k].n_chars == 0 for k in (100, 101, 102))
    assert got[103].text == "T First part of the text. Second part of the text."
    assert H.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_mean_word_length_is_over_all_words():
    words = ["ab"] * 200 + ["abcdefgh"] * 100
    row, = H.vectors([H.Block(H.Path.of(("body", "p")), " ".join(words), 0.0)])
    assert abs(row[-1] - (200 * 2 + 100 * 8) / 300 / 10) < 1e-6


def test_gradients_of_the_network():
    import numpy as np

    rng = np.random.default_rng(0)
    examples = [(rng.normal(size=(n, H.DIM)).astype(np.float32), (np.arange(n) % 3 == 0).astype(float)) for n in (4, 7, 5, 9)]
    w = H.train(examples, epochs=150)
    for (_, y), p in zip(examples, H.probabilities(w, [x for x, _ in examples])):
        assert ((p > 0.5) == (y > 0.5)).all()  # position in the sequence alone decides: both directions learn


def test_boilerplate_lines_of_a_site(spark):
    rows = [(k, "http://one.example/%d" % k, f"<body><li>Menu</li><p>text {k}</p><p>text {k}</p><p>Half</p></body>" if k % 2 else f"<li>Menu</li><p>text {k}</p>") for k in range(8)]
    rows += [(50, "https://u@two.example:80/x", "<p>Menu</p>"), (51, None, None), (52, "", ""), (53, None, "<p>Menu<p>  a \t b "), (53, None, "<p>Menu<p>c")]
    got = {}
    for r in S.dedup_lines(spark.createDataFrame(rows, PAGE).withColumn("line", S.F.lit("clash"))).collect():
        got.setdefault(r.page_id, []).append((r.host, r.n_lines, r.n_dropped, r.text))
    assert got[1] == [("one.example", 4, 2, "text 1\ntext 1")] and got[2] == [("one.example", 2, 1, "text 2")]
    assert got[50] == [("two.example", 1, 0, "Menu")] and got[51] == got[52] == [("", 0, 0, "")]
    assert sorted(got[53]) == [("", 2, 0, "Menu\na b"), ("", 2, 0, "Menu\nc")]
    assert S.dedup_lines(spark.createDataFrame([], PAGE)).count() == 0


def test_a_page_cut_off_inside_a_tag_takes_no_time():
    import time

    start = time.time()
    cut = "<p>kept</p><div " + " ".join(f"a{k}=\"v{k}\" b='c" for k in range(4000))
    assert [b.text for b in H.blocks(cut)] == ["kept"]
    assert [b.text for b in H.blocks("<p>one</p><p title=\"never closed>two</p><p>three</p>")] == ["one", "two", "three"]
    assert len(H.blocks("<a =\"><p =' >t " * 5000)) > 0
    deep = H.blocks("<div class='a b'>x" * 8000)
    assert len(deep) == 8000 and deep[-1].path.size == 3 * 8000 and len({id(b.path.features) for b in deep}) <= 2
    assert time.time() - start < 5


def test_the_sample_is_of_different_pages(spark, pages):
    html = pages.first().html
    other = page("<article><p>" + "Quite another text of some more words stands here. " * 3 + "</p></article>")
    for id_ in (7, None):  # every row has the same id, most are the same page
        rows = spark.createDataFrame([(id_, "u", html)] * 400 + [(id_, "u", other)], PAGE)
        got = H.extract(rows.unionByName(pages)).where("url = 'u'").distinct().collect()
        assert sorted(r.text.split()[0] for r in got) == sorted([got[0].text.split()[0], got[1].text.split()[0]]) and len(got) == 2
        assert all("Home" not in r.text and "us" not in r.text.split() for r in got)


def test_without_a_page_to_learn_from_the_markup_decides(spark, pages):
    assert H.fit(pages.limit(0)) is None and H.fit(pages.limit(3).withColumn("html", H.F.lit(None).cast("string"))) is None
    got = H.extract(pages.limit(3), bound=0).collect()
    assert all(r.text and "Home" not in r.text for r in got)
    plain = spark.createDataFrame([(1, "u", "<p>one<p>two")], PAGE)
    assert [r.text for r in H.extract(plain, bound=0).collect()] == ["one two"]
