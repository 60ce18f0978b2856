"""HTML extraction, WARC archives and the URL filter."""

import base64
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from reachlens.llm import html_text, url_filter, warc
from reachlens.llm.common import written

TREE = html_text.grow(*html_text.labelled_rows())
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{a:b}}</style><script>var x="</p>";</script></head>
<body class="has-sidebar"><header><a href="/">Home of all</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies on this site to count its readers.</p></div><!-- ad <p>no</p> -->
{main}
<aside><p>{long}</p></aside><form><p>Your name and your address, please, for the letter</p></form>
<section class="comments"><article><p>{long}</p></article></section><div class="adBox">{long}</div>
<footer>&copy; all</footer></body></html>"""
LONG = "some words that go on and on until the line is long enough to look like a paragraph of a page " * 2


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text of ten words that stands all alone here", None),
    ("<article><h1>T &amp;  U</h1><p>a&nbsp;b\n\t c<p><b>x</b>y<br>z &lt;p&gt; &#233;&eacute</article>",
     "T & U\na b c\nxy z <p> éé"),
    ("<article><p>one<p>two<ul><li>three<li>four <a href=x>five</a></ul><script>no()</script>six</article>tail",
     "one\ntwo\nthree\nfour five\nsix"),
    ("<article><p class=it's title='a > b'>kept</p><textarea>no</textarea></article>", "kept"),
    ("<main><p>never closed <em>text", "never closed text"),
    (PAGE.format(main="<article><h1>Head</h1><p>Short.</p><div class='share'>Tell all</div></article>", long=LONG),
     "Head\nShort."),
    (PAGE.format(main=f"<div><h2>Head of it all</h2><p>{LONG}</p><p>{LONG}</p></div>", long=LONG),
     f"Head of it all\n{LONG.strip()}\n{LONG.strip()}"),
])
def test_main_text(html, text):
    got = html_text.main_text(html, TREE)
    assert got == (html if text is None else text)


@pytest.mark.parametrize("before,after", [
    ("<article class='post comments-open'>", "</article>"),
    ("<article class='category-social'>", "</article>"),
    ("<article class='teaser' id='promoted'>", "</article>"),
    ("<div id='page' class='has-sidebar'><article>", "</article></div>"),
    ("<div class='layout no-sidebar'><main><article>", "</article></main></div>"),
    ("<div class='content-sidebar'><div class='widget'><article>", "</article></div></div>"),
    ("<div class='contentSidebar'><div class='related-posts'><article>x y</article></div><article>", "</article></div>"),
    ("<div class='layout no-sidebar'>", "</div>"),
])
def test_classes_of_a_page_or_article_drop_no_text(before, after):
    side = f"<div class='share-buttons'>Tell all</div><div class='comment-list'><article>{LONG}</article></div>"
    page = PAGE.format(main=f"{before}<h1>Head of all</h1><p>{LONG}</p><p>{LONG}</p>{side}{after}", long=LONG)
    assert html_text.main_text(page, TREE) == f"Head of all\n{LONG.strip()}\n{LONG.strip()}"


def test_tree_fits_its_table():
    x, y = html_text.labelled_rows()
    assert [round(html_text.likely(TREE, r)) for r in x] == y


def test_extracted_keeps_rows_and_columns(spark):
    long = "<article><p>" + "word &amp; " * 200000 + "</p></article>"
    pages = spark.createDataFrame([(1, "u", None, "t", 5), (1, "u", None, "t", 5), (None, None, "<p>x", None, None),
                                   (2, "v", long, "t", 1)],
                                  "page_id bigint, url string, html string, text string, n_chars int")
    rows = html_text.extracted(pages).collect()
    assert sorted(r.n_chars for r in rows)[:3] == [0, 0, 0] and max(r.n_chars for r in rows) == 7 * 200000 - 1
    assert set(rows[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    assert html_text.extracted(pages.limit(0)).collect() == []


def test_framing_round_trip():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("aé\r\n😀0") for _ in range(rng.randint(0, 60)))
        for limit in (1, 3, 7, 100):
            parts = list(warc.pieces(text.encode(), limit))
            assert b"".join(parts) == text.encode() and all(p.decode() for p in parts)
            assert warc.unchunked(warc.chunked(text.encode(), limit)) == text.encode()
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


@pytest.mark.parametrize("segment,per_file", [(1 << 14, 1024), (40, 3)])
def test_archive_round_trip(spark, scratch, segment, per_file):
    rng = random.Random(segment)
    payloads = [None, "", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "é" * 300, "x\r\n\r\ny", "😀" * 77]
    rows = [(i, rng.choice([None, f"http://h/{i}", "a\r\nb%0A"]), rng.choice(payloads), "z") for i in range(60)]
    rows += [(60, "u", "only one of these", "z"), (61, "u", "r" * 5000, "z")]
    path = f"{scratch}/in"
    spark.createDataFrame(rows, "page_id bigint, url string, html string, record_id string").write.parquet(path)
    warc.write_archive(spark.read.parquet(path), f"{scratch}/warc", segment, 16, per_file)
    records = written(warc.read_archive(spark, f"{scratch}/warc"), "records")
    by_page = {r.page_id: r for r in records.collect()}
    top = {}
    for i, _, html, _ in rows:
        top[html or ""] = max(top.get(html or "", -1), i)
    assert len(by_page) == len(rows)
    for i, url, html, _ in rows:
        assert by_page[i].target_uri == url
        if top[html or ""] == i:
            assert bytes(by_page[i].payload).decode() == (html or "")
    out = {r.page_id: r for r in warc.resolved(warc.index(records)).collect()}
    for i, _, html, _ in rows:
        data = (html or "").encode()
        want = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                "response" if top[html or ""] == i else "revisit",
                None if top[html or ""] == i else top[html or ""])
        assert tuple(out[i])[1:] == want


def test_archive_of_repeated_rows_nulls_and_nothing(spark, scratch):
    rows = [(4, "u", "same"), (4, "u", "same"), (None, None, "same"), (None, None, None)]
    path = f"{scratch}/in"
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(path)
    warc.write_archive(spark.read.parquet(path), f"{scratch}/warc", 20, 7, 2)
    out = warc.resolved(warc.index(warc.read_archive(spark, f"{scratch}/warc"))).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in out) == {
        (4, "response", None, 4): 1, (4, "revisit", 4, 4): 1, (None, "revisit", 4, 4): 1,
        (None, "response", None, 0): 1}
    warc.write_archive(spark.read.parquet(path).limit(0), f"{scratch}/none")
    assert warc.read_archive(spark, f"{scratch}/none").collect() == []


def test_a_lost_segment_is_an_error(spark, scratch):
    path = f"{scratch}/in"
    spark.createDataFrame([(1, "u", "abc" * 100)], "page_id bigint, url string, html string").coalesce(1).write.parquet(path)
    warc.write_archive(spark.read.parquet(path), f"{scratch}/warc", 50, 16, 1)
    files = sorted(r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
                   .load(f"{scratch}/warc").select("path").collect())
    assert len(files) > 3
    import os
    os.remove(files[2].removeprefix("file:"))
    with pytest.raises(Exception, match="missing or do not add up"):
        warc.read_archive(spark, f"{scratch}/warc").collect()


def test_large_pages_make_no_large_files(spark, scratch):
    import gzip
    rng = random.Random(3)
    html = "".join(rng.choice("abcdefgé \n") for _ in range(400_000)) * 60  # 24 MB and a bit
    path = f"{scratch}/in"
    spark.createDataFrame([(1, "u", html), (2, "v", "small")], "page_id bigint, url string, html string").write.parquet(path)
    warc.write_archive(spark.read.parquet(path), f"{scratch}/warc")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{scratch}/warc")
             .select("content").collect())
    sizes = [len(gzip.decompress(r.content)) for r in files]
    assert sum(sizes) > len(html) and max(sizes) <= warc.RECORDS_PER_FILE * (warc.SEGMENT_BYTES + 1024)
    got = {r.page_id: r.payload for r in warc.read_archive(spark, f"{scratch}/warc").collect()}
    assert got == {1: html.encode(), 2: b"small"}


def brute_ratio(texts, order):
    """texts: [(s, verdict or None)] -> ratio(gram) by direct recursion."""
    counts = {v: defaultdict(Counter) for v in ("allow", "block")}
    for s, v in texts:
        if v is None:
            continue
        padded = url_filter.START * order + s + url_filter.END
        for i in range(len(s) + 1):
            gram = padded[i:i + order + 1]
            for k in range(order + 1):
                counts[v][gram[order - k:order]][gram[-1]] += 1

    def p(v, ctx, c):
        low = 1 / url_filter.ALPHABET if not ctx else p(v, ctx[1:], c)
        if not ctx:
            seen = counts[v][""]
        else:
            seen = counts[v][ctx]
        n, t = sum(seen.values()), len(seen)
        return (seen[c] + t * low) / (n + t) if n + t else low

    return lambda gram: round((math.log(p("allow", gram[:-1], gram[-1])) - math.log(p("block", gram[:-1], gram[-1]))) * 1e6)


def test_ratios_are_those_of_the_models(spark):
    texts = [("ab/c", "allow"), ("abc", "allow"), ("bbé", "block"), ("ab", None), ("", "block")]
    rows = [(s, v) for s, v in texts]
    frame = spark.createDataFrame(rows, "s string, verdict string")
    from pyspark.sql import functions as F
    counts = url_filter._grams(frame, 2).groupBy("gram").agg(*[
        F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).alias(v) for v in ("allow", "block")])
    want = brute_ratio(texts, 2)
    got = url_filter.gram_ratios(counts, 2).collect()
    assert got and all(abs(r.ratio - want(r.gram)) <= 1 for r in got)


def test_rules_and_odd_urls(spark):
    cases = {
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://x.WWW.Example.com/en/1?q#f": ("x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://a.example.com/EN/": ("a.example.com", "/EN/", "com/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "x://y://a.net/es/1": ("y:", "//a.net/es/1", None, None),
        "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "http://a.com?x=/": ("a.com", "", None, None),
        "http://a.com#/": ("a.com", "", None, None),
        "no scheme.com/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)] + [(0, next(iter(cases)), "x")],
                                  "page_id bigint, url string, score string")
    got = url_filter.judge_urls(pages).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        host, path, rule, verdict = list(cases.values())[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judge_urls(pages.limit(0)).collect() == []


def test_repeated_rows_count_in_models_and_threshold(spark):
    once = [(f"http://a{i}.com/x", "allow") for i in range(12)] + [(f"http://a{i}.net/es/x", "block") for i in range(12)]
    urls = [u for u, _ in once] + [once[3][0]] * 40 + ["http://a3.org/x"]
    held = {u: hashlib.md5(u[7:].encode()).hexdigest()[0] in url_filter.HELD_OUT for u, _ in once}
    assert not held[once[3][0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}[len(urls) - 1]
    texts = [(u[7:], v) for u, v in once if not held[u]] + [(once[3][0][7:], "allow")] * 40
    ratio = brute_ratio(texts, url_filter.ORDER)
    padded = url_filter.START * url_filter.ORDER + "a3.org/x" + url_filter.END
    want = [ratio(padded[i:i + url_filter.ORDER + 1]) for i in range(len("a3.org/x") + 1)]
    assert abs(got.score - sum(want) / 1e6 / len(want)) < 1e-5
    scores = [(0.1, "allow", 1), (0.5, "allow", 9), (0.3, "block", 1), (0.0, "block", 1)]
    weighed = spark.createDataFrame(scores, "score double, verdict string, pages bigint")
    every = spark.createDataFrame([s[:2] for s in scores for _ in range(s[2])], "score double, verdict string")
    assert url_filter.threshold(weighed) == url_filter.threshold(every)
    assert url_filter.threshold(weighed) != url_filter.threshold(weighed.drop("pages"))


def test_models_follow_the_ruled_urls(spark):
    rng = random.Random(3)
    good, bad = ["garden", "flower", "meadow"], ["casino", "jackpot", "poker"]
    rows = [(i, f"http://{rng.choice(good)}{i}.com/{rng.choice(good)}") for i in range(300)]
    rows += [(300 + i, f"http://{rng.choice(bad)}{i}.net/es/{rng.choice(bad)}") for i in range(300)]
    rows += [(1000 + i, f"http://{w}.org/{w}") for i, w in enumerate(good)]
    rows += [(2000 + i, f"http://{w}.org/{w}") for i, w in enumerate(bad)]
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(
        spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert all(got[1000 + i] == "allow" and got[2000 + i] == "block" for i in range(3))


def test_calibrated_verdicts_of_given_pages(spark):
    """Rules, models, threshold and verdicts of a whole table in plain Python."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").limit(60)
    rows, texts, ruled = [(r.page_id, r.url) for r in pages.collect()], {}, {}
    for _, url in rows:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        s = "".join(c.lower() if c.isascii() else c for c in host) + re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host, path = s[:len(host)], s[len(host):]
        fits = [(len(h + p), v) for v, h, p in url_filter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        texts[url], ruled[s] = s, max(fits)[1] if fits else None
    pages_of = Counter(texts[u] for _, u in rows)
    held = {s: hashlib.md5(s.encode()).hexdigest()[0] in url_filter.HELD_OUT for s in ruled}
    ratio = brute_ratio([(s, v) for s, v in ruled.items() if v and not held[s] for _ in range(pages_of[s])], url_filter.ORDER)
    score = {}
    for s in ruled:
        padded = url_filter.START * url_filter.ORDER + s + url_filter.END
        score[s] = sum(ratio(padded[i:i + url_filter.ORDER + 1]) for i in range(len(s) + 1)) / 1e6 / (len(s) + 1)
    known = [(score[s], v, pages_of[s]) for s, v in ruled.items() if v and held[s]]
    share = {v: sum(n for _, w, n in known if w == v) for v in ("allow", "block")}

    def balanced(at):
        return sum(n / share[v] for x, v, n in known if (math.floor(x * 100) / 100 >= at) == (v == "allow"))
    limit = max((round(balanced(k / 100), 9), -abs(k)) for k in range(-1000, 1001))[1] if all(share.values()) else 0
    limits = {limit / 100, -limit / 100}
    got = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert len(got) == len(rows)
    for page_id, url in rows:
        s = texts[url]
        if ruled[s]:
            assert got[page_id].verdict == ruled[s]
        else:
            assert abs(got[page_id].score - score[s]) < 1e-5
            assert got[page_id].verdict in {"allow" if score[s] >= x else "block" for x in limits}


# -- parts that hold the text, neighbours, hidden elements, broken markup -----

PROSE = "Long words of prose that fill a paragraph of the text here. " * 4
NAV = "<nav><a href=a>One</a> <a href=b>Two</a></nav>"


@pytest.mark.parametrize("html,want", [
    # a part that holds the article, or most of the page, is not beside the text
    (f'<body>{NAV}<form id="aspnetForm"><article><h1>Title</h1><p>{PROSE}</article></form>', ["Title", PROSE]),
    (f'<body>{NAV}<form id="aspnetForm"><h1>Title of it</h1><p>{PROSE}<p>{PROSE}</form>', ["Title of it", PROSE, PROSE]),
    (f'<div class="widget"><article><p>{PROSE}</article></div>', [PROSE]),
    # but reader comments are, even as articles, and forms beside an article
    (f'<div><p>{PROSE}<p>{PROSE}</div><div class="comments"><article class="comment"><p>I like this.</article></div>',
     [PROSE, PROSE]),
    (f'<article><p>{PROSE}</article><form><p>Write to us in some words here, please do.</form>', [PROSE]),
    (f'<article><p>{PROSE}</p><div class="user-feedback"><p>Great piece, thanks a lot.</div></article>', [PROSE]),
    # classes that may mean something else: the words and links of both sides decide
    (f'<article><p>{PROSE}<section class="alert"><p>{PROSE}<p>Short note here.<p>{PROSE}</section></article>',
     [PROSE, PROSE, "Short note here.", PROSE]),
    (f'<article><div class="social-policy"><h2>The policy</h2><p>{PROSE}</div></article>', ["The policy", PROSE]),
    (f'<article><p class="teaser">The lead says in a few words what it is about.</p><p>{PROSE}</article>',
     ["The lead says in a few words what it is about.", PROSE]),
    (f'<article><p>{PROSE}</p><div class="social"><a href=x>Tweet</a></div><div class="teaser"><a href=y>Another story</a>'
     f'</div><p>{PROSE}</article>', [PROSE, PROSE]),
    # not shown
    (f'<article><p>{PROSE}<p hidden>No.<p style="color:red; Display : none">Nor this.<p>{PROSE}</article>', [PROSE, PROSE]),
    # no article: short blocks among plain ones stay, those among links go
    (f'<ul><li><a href=a>Home</a><li><a href=b>News</a></ul><h1>Cake</h1><p>{PROSE}<ul><li>Salt<li>Two eggs<li>Some flour'
     f'</ul><p>{PROSE}<p>"Yes," said he.<p>"No," said she.<p>"Well."<div>© 2024 The Cake Company and its friends, all '
     'rights reserved</div>', ["Cake", PROSE, "Salt", "Two eggs", "Some flour", PROSE, '"Yes," said he.', '"No," said she.',
                               '"Well."']),
])
def test_text_is_kept_by_what_is_around_it(html, want):
    got = html_text.main_text(html, html_text.grow(*html_text.labelled_rows()))
    assert got == "\n".join(" ".join(w.split()) for w in want)


def test_the_tree_decides_by_neighbours():
    rows, labels = html_text.labelled_rows()
    tree, used = html_text.grow(rows, labels), Counter()

    def walk(node):
        if isinstance(node, tuple):
            used[html_text.FEATURES[node[0]]] += 1
            walk(node[2])
            walk(node[3])
    walk(tree)
    assert used["links_before"] and used["words_before"] + used["words_after"] and used["links"] and used["words"]
    assert all((html_text.likely(tree, r) >= 0.5) == bool(v) for r, v in zip(rows, labels))
    # one short block, alike but for its neighbours
    base = dict.fromkeys(html_text.FEATURES, 0) | {"words": 3}
    plain = base | {"words_before": 9, "words_after": 40}
    linked = base | {"words_before": 2, "links_before": 1.0, "words_after": 2, "links_after": 1.0}
    assert [html_text.likely(tree, [r[f] for f in html_text.FEATURES]) for r in (plain, linked)] == [1, 0]


@pytest.mark.parametrize("bad", ["<b>x</i>", "<b><h1>x</h1>", "<nav>x", "<p><b>x", "<article>x", "<li><b>", "</p>x", "<a><div></a>"])
def test_time_is_proportional_to_the_page(bad):
    tree = html_text.grow(*html_text.labelled_rows())

    def seconds(size):
        page, start = bad * (size // len(bad)), time.process_time()
        html_text.main_text(page, tree)
        return time.process_time() - start
    seconds(1000)
    assert seconds(1 << 20) < 20 * seconds(1 << 17) + 1


def test_unmatched_and_crossing_end_tags():
    tree = html_text.grow(*html_text.labelled_rows())
    page = f"<article></i><p><b>{PROSE}</p></b></em><i><p>{PROSE}</i> after</p></article></div><nav>menu</nav>"
    assert html_text.main_text(page, tree) == f"{PROSE.strip()}\n{PROSE}after"
