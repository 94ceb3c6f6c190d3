import html as references
import re
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import html

SF = "/root/testdata/sf0.01"


def test_articles_of_the_whole_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in html.op5_html(spark, SF).collect()}
    assert set(got) == set(pages)
    right = 0
    for i, page in pages.items():
        article = page[page.index("<article>") + 9 : page.index("</article>")]
        want = [x for x in (" ".join(references.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?p>|</?h1>|<br>", article)) if x]
        right += got[i].text == "\n".join(want)
        assert got[i].n_chars == len(got[i].text)
    assert right == len(pages)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []),
        ("", []),
        ("plain <b>bold</b> <script>var x='</div>'</script> more <!-- c --> &lt;end&gt;", ["plain bold more <end>"]),
        ("<p>x<a href=\"unclosed", ["x"]),
        ("<div class='cookie-notice'><p>We</p></div><header>H</header><main><header><h1>T</h1></header><p>One<br>two &amp; three<p>four<ul><li>a<li>b</ul><div class=comments>c</div></main><footer>f", ["T", "One two & three", "four", "a", "b"]),
        ("<nav><ul><li>x</nav><article>A<aside>no</aside><form>no</form> B</article><p>after", ["A", "B"]),
        ("<body><p>one<p hidden>two<p>three", ["one", "three"]),
        ("<p>a\xa0 b\n\tc</p><p> </p>", ["a b c"]),
    ],
)
def test_blocks(page, want):
    assert html.blocks(page) == want


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_common_is_a_longest_common_subsequence(a, b):
    hit = html.common(list(a), list(b))
    kept = "".join(x for x, h in zip(a, hit, strict=True) if h)
    subs = lambda s: {"".join(c) for n in range(len(s) + 1) for c in combinations(s, n)}
    both = subs(a) & subs(b)
    assert kept in both and len(kept) == max(map(len, both))


def page(*lines):
    return "".join(f"<p>{x}</p>" for x in lines)


def test_differencing_by_nearest_url(spark):
    rows = [
        (1, "http://h/a/1", page("Our shop", "first story of some length", "Call now"), "x"),
        (2, "http://h/a/2.html", page("Our shop", "second story, longer still", "Call now"), "x"),
        (3, "https://h/b/9/?q=1", page("Our shop", "third story about nothing at all", "Call"), "x"),
        (4, "http://other/a/1", page("Our shop", "alone here"), "x"),
        (5, None, page("Our shop", "no address"), "x"),
        (None, "http://h/a/1", page("Our shop", "no id"), "x"),
        (6, "http://k/1", page("same article, two addresses", "p.s."), "x"),
        (7, "http://k/2", page("same article, two addresses", "p.p.s."), "x"),
        (8, "http://k/3", None, "x"),
        (1, "http://h/a/1", page("Our shop", "first story of some length", "Call now"), "x"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(4)
    got = sorted(((r.page_id, r.text) for r in html.extract(df).collect()), key=str)
    assert got == sorted(
        [
            (1, "first story of some length"), (1, "first story of some length"), (2, "second story, longer still"), (3, "third story about nothing at all\nCall"), (4, "Our shop\nalone here"), (5, "Our shop\nno address"),
            (None, "Our shop\nno id"), (6, "same article, two addresses\np.s."), (7, "same article, two addresses\np.p.s."), (8, ""),
        ],
        key=str,
    )
    assert html.extract(df.where("false")).count() == 0


def test_partners_do_not_depend_on_partitions(spark):
    rows = [(i, f"http://h{i % 2}/d{i % 7}/{i:03d}", page("x")) for i in range(60)]
    found = []
    for n in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        from tidelog.llm.scratch import Scratch

        scratch = Scratch(spark)
        found.append(sorted(map(tuple, html.partners(scratch.save(html.extracted(df), "t"), scratch).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1] and len(found[0]) == 60


def test_a_short_article_under_a_long_menu(spark):
    menu = [f"menu entry number {i} of the shop" for i in range(20)]
    rows = [(i, f"http://h/a/{i}", page(*menu, f"story {i}", "the end")) for i in range(4)]
    rows += [(10 + i, f"http://copies/{i}", page(*menu, "one text at three addresses")) for i in range(3)]
    rows += [(20, "http://two/1", page(*menu, "first")), (21, "http://two/2", page(*menu, "second"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html.extract(df).collect()}
    assert all(got[i] == f"story {i}" for i in range(4))
    whole = "\n".join([*menu, "one text at three addresses"])
    assert all(got[10 + i] == whole for i in range(3))
    assert got[20] == "\n".join([*menu, "first"])  # no third page tells a template from a copy


def test_neighbours_against_a_sorted_list(spark):
    import random

    from tidelog.llm.scratch import Scratch

    rng = random.Random(6)
    rows = [(i, f"http://h{rng.randrange(4)}/{rng.choice('abc')}/{rng.randrange(30):02d}/{i}", page("x")) for i in range(90)] + [(200, "http://alone/1", page("x"))]
    hosts = {}
    for i, u, _ in rows:
        host, path = u[7:].split("/", 1)
        hosts.setdefault(host, []).append(("/" + path, i))
    want = {}
    for own in hosts.values():
        own.sort()
        for j, (path, i) in enumerate(own):
            at = lambda k: own[k] if 0 <= k < len(own) else None  # noqa: E731, B023
            shared = lambda x: html._prefix(path, x[0])  # noqa: E731, B023
            b, a = at(j - 1), at(j + 1)
            near, other, further = (b, a, at(j - 2)) if b and (not a or shared(b) >= shared(a)) else (a, b, at(j + 2))
            if near:
                want[i] = (near[1], (other or further or (None, None))[1])
    for n in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        scratch = Scratch(spark)
        got = {r.page_id: (r.partner, r.witness) for r in html.partners(scratch.save(html.extracted(df), "t"), scratch).collect()}
        assert got == want, n
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_differencing_takes_marked_pages_too(spark):
    offer = "Join our club today and save"
    box, plain = f"<div class=promo><p>{offer}</p></div>", f"<div>{offer}</div>"
    article = lambda i, *more: f"<article><p>story number {i}</p><p>quoted by all</p>{''.join(more)}</article>"
    rows = [
        (1, "http://h/a/1", article(1) + box),
        (2, "http://h/a/2", article(2, plain)),  # both neighbours leave the offer out
        (3, "http://h/a/3", article(3) + box),
        (4, "http://k/1", f"<nav><p>Home of all things</p></nav>{article(4)}"),
        (5, "http://k/2", page("Home of all things", "story with no mark, and longer", "quoted by all")),  # a menu in the marked neighbour, a passage of its article
        (6, "http://l/1", article(6, plain)),
        (7, "http://l/2", article(7) + box),  # one neighbour alone does not take from a marked article
        (8, "http://m/1", article(8, plain) + box),
        (9, "http://m/2", article(9) + box),
        (10, "http://m/3", article(10, plain) + box),  # a page's own advert is what its neighbours share
        (2, "http://h/a/2", article("other", plain)),  # another page under a known id
        (11, "http://n/1", article(11) + box),
        (12, "http://n/2", article(12, f"<p>{offer}</p>", f"<div><p>{offer}</p></div>")),  # an article that quotes an advert
        (13, "http://n/3", article(13) + box),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted((r.page_id, r.text) for r in html.extract(df).collect())
    text = lambda i, *more: (i, "\n".join([f"story number {i}", "quoted by all", *more]))
    want = [text(1), text(2), (2, "story number other\nquoted by all"), text(3), text(4), (5, "story with no mark, and longer\nquoted by all"), text(6, offer), text(7), text(8, offer), text(9), text(10, offer), text(11), text(12, offer, offer), text(13)]
    assert got == sorted(want)
