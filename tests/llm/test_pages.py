import random

import pytest

from revtide.llm import htmltext, urlfilter
from revtide.llm.queries import RULES
from tests.llm import brute

PAGES = "page_id long, url string, html string"


def texts(spark, pages, partitions=3):
    rows = htmltext.extract(spark.createDataFrame(pages, PAGES).repartition(partitions)).collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return {r.page_id: r.text for r in rows}


def test_article_by_markup(spark):
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav>'
        '<div class="cookie-notice">We use cookies</div><header>Site</header><main><header><h1>Head &amp; line</h1></header>'
        "<script>if (a<b) x('</p>')</script><p>One\n  two&nbsp;three<br>four <b>bold</b>face.<p>Next &lt;tag&gt;"
        '<aside>Side</aside><form>Name <input></form><div id="comments"><p>Reader</p><div>x</div></div>'
        "<ul><li>a<li>b</ul></main><!-- <p>no</p> --><footer>&copy; Foot</footer>"
    )
    assert texts(spark, [(1, "http://a.com/x", page)]) == {
        1: "Head & line\nOne two three four boldface.\nNext <tag>\na\nb"
    }


def test_site_lines_go_by_differencing(spark):
    draw = random.Random(1)
    pages, own = [], {}
    for i in range(60):
        host = f"h{i % 3}.com"
        mine = [f"Sentence {draw.random()} of page {i}." for _ in range(draw.randrange(1, 6))]
        block = [f"Welcome to {host}", *mine, f"Imprint of {host}"]
        pages.append((i, f"http://{host}/p/{i:03}", "".join(f"<div>{b}</div>" for b in block)))
        own[i] = "\n".join(mine)
    for partitions in (1, 7):
        assert texts(spark, pages, partitions) == own


def test_class_names_that_mark_no_furniture(spark):
    body = "<p>" + "Own words of the page. " * 5 + "</p>"
    plain = ("Own words of the page. " * 5).strip()
    pages = [
        (1, "http://a.com/1", f'<html class="no-sidebar"><body class="has-sidebar">{body}</body></html>'),
        (2, "http://b.com/2", f'<div class="main no-comments">{body}</div><div class="post comments-list">Reader</div>'),
        (3, "http://c.com/3", f'<article><div class="entry-header"><h1>Title</h1></div>{body}</article>'),
        (4, "http://d.com/4", f'{body}<article><p>Teaser</p></article><div id=site-header>Site</div>'),
        (5, "http://e.com/5", f"<article>{body}<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>"),
    ]
    assert texts(spark, pages) == {1: plain, 2: plain, 3: f"Title\n{plain}", 4: f"{plain}\nTeaser", 5: f"{plain}\nSo x=2 holds"}


def test_mirrors_keep_their_text_and_odd_rows(spark):
    page = "<p>Same words</p><p>on both pages</p>"
    pages = [(1, "http://m.com/a", page), (2, "http://m.com/b", page), (3, None, None), (4, "x", ""), (None, "http://m.com/c", "plain"), (5, "http://q.com/", "<nav><ul><li>x</ul>"), (5, "http://q.com/", "<nav><ul><li>x</ul>"), (6, "http://z.com/", "<p>" + "word " * 60_000)]
    rows = htmltext.extract(spark.createDataFrame([(*p, 1, 2) for p in pages], PAGES + ", key int, host int")).collect()
    assert sorted((str(r.page_id), r.text[:20]) for r in rows) == sorted(
        [("1", "Same words\non both p"), ("2", "Same words\non both p"), ("3", ""), ("4", ""), ("None", "plain"), ("5", ""), ("5", ""), ("6", "word word word word ")]
    )
    assert htmltext.extract(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("held", [htmltext.HELD, 20])
def test_common_lines_are_a_longest_subsequence(held, monkeypatch):
    monkeypatch.setattr(htmltext, "HELD", held)
    draw = random.Random(7)
    for _ in range(300):
        a = [draw.randrange(6) for _ in range(draw.randrange(14))]
        b = [draw.randrange(6) for _ in range(draw.randrange(14))]
        left, right = htmltext.common_lines(a, b)
        assert left == sorted(set(left)) and right == sorted(set(right))
        assert [a[i] for i in left] == [b[j] for j in right]
        assert len(left) == brute.longest_common(a, b)


URLS = [
    "http://x.net/",
    "http://x.net",
    "https://Example.NET/en/1?q=http://a.b/",
    "http://example.net/de/1",
    "http://notexample.net/en/1",
    "http://www.example.com/de/2#x",
    "http://www.example.com/dex",
    "https://a.org/fr/3",
    "org/fr/3",
    "ftp://org/fr/",
    "http://a.org?x=/fr/",
    "http://NÄT.example.com:80/de/",
    "",
    None,
    "://",
    "http://net/a\nb",
]


def expected(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule in RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            best = rule if best is None or len(rule) > len(best) else best
    return host, path, best


def test_rules(spark):
    pages = spark.createDataFrame([(i, u, 1.0) for i, u in enumerate(URLS)], "page_id long, url string, length double")
    rows = {r.page_id: r for r in urlfilter.judge(pages, RULES, None).collect()}
    for i, url in enumerate(URLS):
        host, path, rule = expected(url)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == (RULES[rule] if rule else "allow")
    assert urlfilter.judge(pages.limit(0), RULES, None).collect() == []
    with pytest.raises(ValueError):
        urlfilter.fitting_rule({f"h{i}/": "block" for i in range(urlfilter.MAX_RULES + 1)})


def test_trees_held_out(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        name = "-".join("".join(draw.choices("abcde", k=5)) for _ in range(2)) if bad else "".join(draw.choices("abcdefgh", k=9))
        rows.append((i, f"http://{name}.{draw.choice(['com', 'org'])}/{draw.randrange(999)}", float(bad)))
    frame = urlfilter.with_host_and_path(spark.createDataFrame(rows, "page_id long, url string, blocked double"))
    model = urlfilter.train(frame.filter("page_id < 300"))
    held = urlfilter.judge(frame.filter("page_id >= 300").select("page_id", "url"), {}, model).collect()
    right = sum((r.verdict == "block") == (r.page_id % 4 == 0) for r in held)
    assert len(held) == 100 and right >= 95
    odd = urlfilter.judge(spark.createDataFrame([(None, None), (1, ""), (1, "")], "page_id long, url string"), RULES, model)
    assert odd.count() == 3
    assert urlfilter.train(frame.filter("blocked = 0")) is None
    assert urlfilter.train(frame.limit(0)) is None


def test_suffix_statistics_count_all_labelled_urls(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "SUFFIXES", 5)
    draw = random.Random(4)
    rows = [(i, f"http://h{i}.{draw.choice(['com', f't{i % 150}'])}/{i}", float(i % 2)) for i in range(600)]
    rows += [(i, f"http://again{i}.t7/{i}", 1.0) for i in range(600, 605)]
    frame = urlfilter.with_host_and_path(spark.createDataFrame(rows, "page_id long, url string, blocked double"))
    model = urlfilter.train(frame, sample=100)
    expected = {}
    for _, url, blocked in rows:
        suffix = url.split("/")[2].split(".")[-1]
        seen, bad = expected.get(suffix, (0, 0.0))
        expected[suffix] = (seen + 1, bad + blocked)
    assert model.total == 605
    assert {r["suffix"]: (r.seen, r.bad) for r in model.suffixes.collect()} == expected
    counted = urlfilter._counted(urlfilter._lexical(frame.select("page_id", "url", "host", "path")), model.suffixes).collect()
    assert len(counted) == 605 and all((r.seen, r.bad) == expected[r["suffix"]] for r in counted)
    assert len(urlfilter.judge(frame.select("page_id", "url"), {}, model).collect()) == 605
