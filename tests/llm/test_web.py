"""HTML extraction and URL filters."""

import math
import re
import time
from collections import Counter

import numpy as np
import pytest

from taxaspark.llm import html_tagpath as H
from taxaspark.llm import url_charlm as U

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";x(1)</script></head>
<body class="has-sidebar"><header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a><li><a>About</a></ul></nav>
<div class="cookie-notice">We use cookies, as you know.</div><div class=ad>Buy this, now!</div><!-- <p>no</p> -->
%s
<aside>More, to read.</aside><section id="comments"><h3>Comments</h3><p>Nice, very nice text.</p></section>
<form>Name <input value="x > y"> <button>Send</button></form><footer>&copy; us &middot; all rights</footer></body></html>"""
BODY = """<h1>The title</h1><p><b>First para, with <a href=q title="a > b">a link</a>&nbsp;in it.<br><p>Second &lt;ok&gt;
 line\t&amp; more. It goes on, and on.<ul><li>item one, good<li>item two</ul><table><tr><td>a<td>b</table><p>x"""
TEXT = "The title First para, with a link in it. Second <ok> line & more. It goes on, and on. item one, good item two a b x"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<div id=content>%s</div>", "<article>%s"])
def test_main_text(wrap):
    assert H.main_text(PAGE % (wrap % BODY)) == TEXT


@pytest.mark.parametrize("html, text", [
    ("", ""), ("plain words", "plain words"), ("<p>only", "only"), ("<script>x", ""), ("<nav>a</nav>", ""), ("a < b <c", "a < b <c"),
    ("<div class=ad>all there is</div>", "all there is"), ("<p>a</b></i>b</p></p>c", "ab c"), ("&#233;&eacute;&bogus;&amp;amp;", "éé&bogus;&amp;"),
    ("<P>Upper</P><Br/>Case", "Upper Case"), ("<article></article>", ""), ("<p>one<!-- two --> three", "one three"),
])
def test_odd_markup(html, text):
    assert H.main_text(html) == text


def test_paths_add_up():
    page = H.Page("<article><p>ab, c.</p><p>de</p><div><p>f</p></div></article>")
    paths = {p for p, t, _ in page.nodes if p >= 0 and t.strip()}
    assert len(paths) == 2  # both paragraphs share a path, the one in the div has its own
    found, mean, marked = H.scores(page)
    assert marked and set(found) == paths and mean > 0


def test_deep_and_broken_markup_is_linear():
    for html in ("<div>" * 50_000 + "x", '<a title="' * 20_000 + "x", "<div></p>" * 20_000, "<" * 100_000):
        H.main_text(html)


@pytest.mark.parametrize("n", [9_000, 10_500, 300_000])
def test_long_attribute_values(n):
    for q in "\"'":
        html = f"<article><p>before, it.</p><p><img alt={q}{'a' * n} > tail{q} src=x>after, it.</p></article>"
        assert H.main_text(html) == "before, it. after, it."


def test_many_attributes():
    data = " ".join(f"data-a{i}='{{\"k\": \"<b>\"}}'" for i in range(2_000))
    html = f"<div {data} class=\"advert\">Buy this, now!</div><div {data} class=post><p>The text, as it is.</p></div>"
    assert H.main_text(html) == "The text, as it is."


@pytest.mark.parametrize("n", [10, 20_000])
def test_stray_quotes(n):
    """A quote that doesn't open a value hides no text up to the next one."""
    text = "It's a text, " + "a" * n + ", isn't it?"
    assert H.main_text(f"<article><p title=it's>{text}</p><p \">Second, \"one\".</p></article>") == text + ' Second, "one".'


def test_unended_tags_are_linear():
    for piece in ('<a title="', "<a title='\"", "<a", "<a ", "</a ", "<a b='c' \"", "<a 'x' \"<", "<a b=", "<a b='\" c=\""):
        for tail in ("", '"', "'", ">", '">'):
            start = time.process_time()
            H.Page(piece * 30_000 + tail)
            assert time.process_time() - start < 5


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as host", "2 as verdict", "3 as n_chars")


def test_extract_pages(spark):
    df = pages(spark, [(1, "u", PAGE % f"<article>{BODY}</article>"), (2, None, None), (2, None, None), (None, "v", "<p>𝔘é")])
    got = sorted(map(tuple, H.extract_pages(df).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (2, None, "", 0), (2, None, "", 0), (None, "v", "𝔘é", 2)], key=repr)
    assert H.extract_pages(df.limit(0)).count() == 0


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def slow_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for _, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and len(rule) > len(best or ""):
            best = rule
    return host, path, best


def test_rules(spark):
    urls = ["http://a.COM/x", "http://com/", "https://xcom/", "https://www.example.com/en/1?q#f", "https://m.www.example.com/en/", "http://b.example.com/en/x",
            "http://example.com/en", "http://a.net/fr/?x", "http://a.net#/es/", "http://net/es/1", "no scheme.com/", None, "", "http://", "a://b://c.com/en/",
            "HTTP://Ünï.com/Ä", "http://a.com", "http://a.com?x=/"] + [f"http://h{i}.{'net/es' if i % 2 else 'com'}/{i}" for i in range(40)]
    got = U.judge_urls(pages(spark, [(i, u, "") for i, u in enumerate(urls)]), RULES).toPandas()
    verdicts = {r: v for v, r in RULES}
    for r in got.itertuples():
        host, path, rule = slow_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule if isinstance(r.rule, str) else None) == (host, path, rule)
        assert r.verdict == verdicts[rule] if rule else r.verdict in ("allow", "block")


def slow_likelihood(train, url):
    """Witten-Bell mixture over orders 0 to ORDER with exact contexts."""
    n, pairs = Counter(), Counter()
    for u in train:
        b = bytes(U.ORDER) + u.encode() + b"\0"
        for i in range(U.ORDER, len(b)):
            for k in range(U.ORDER + 1):
                n[b[i - k:i], k] += 1
                pairs[b[i - k:i], k, b[i]] += 1
    types = Counter((c, k) for c, k, _ in pairs)
    b, total = bytes(U.ORDER) + url.encode() + b"\0", 0.0
    for i in range(U.ORDER, len(b)):
        p = 1 / 256
        for k in range(U.ORDER + 1):
            c = (b[i - k:i], k)
            if n[c]:
                p = (pairs[(*c, b[i])] + types[c] * p) / (n[c] + types[c])
        total += math.log(p)
    return total


def test_likelihood_equals_brute_force(spark):
    train = [f"http://h{i % 7}.com/a{i}" for i in range(60)]
    df = spark.createDataFrame([(u, "allow") for u in train] + [("http://x.net/es/1", "block")], "url string, verdict string")
    model = U.count_models(df)["allow"]
    for url in ("http://h3.com/a5", "https://zz.org/", ""):
        _, context, pair = U.keys([url.encode()])
        assert model.log_likelihood(context, pair).sum() == pytest.approx(slow_likelihood(train, url), rel=1e-9)


def test_models_separate_and_degenerate_tables(spark):
    rows = [(i, f"http://shop{i}.com/item/{i}") for i in range(300)] + [(1000 + i, f"http://casino{i}.net/es/win{i}") for i in range(300)]
    new = [(5000, "http://shop77.org/item/4"), (5001, "http://casino9.org/es/win1"), (5002, None)]
    got = U.judge_urls(pages(spark, [(i, u, "") for i, u in rows + new]), RULES).toPandas().set_index("page_id")
    assert got.verdict[5000] == "allow" and got.verdict[5001] == "block" and got.verdict[5002] in ("allow", "block")
    only = U.judge_urls(pages(spark, [(1, "http://a.com/", ""), (2, "http://b.org/", "")]), RULES).toPandas().set_index("page_id")
    assert list(only.verdict[[1, 2]]) == ["allow", "allow"]
    assert U.judge_urls(pages(spark, [(1, "x", "")]).limit(0), RULES).count() == 0
    assert np.isfinite(got.difference).all()


def test_ratios_alone_find_the_article(spark):
    """Pages without semantic elements, classes, ids and roles: what is left is the text of plain blocks."""
    import re
    from collections import Counter

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    true = wrong = missed = exact = 0
    for (html,) in rows:
        bare = re.sub(r"<(/?)(?:article|main|header|footer|nav|aside|section)\b", r"<\1div", html)
        bare = re.sub(r"""\s(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", bare)
        want, got = H.main_text(html), H.main_text(bare)
        a, b = Counter(want.split()), Counter(got.split())
        true += sum((a & b).values())
        wrong += sum((b - a).values())
        missed += sum((a - b).values())
        exact += want == got
    assert true / (true + wrong) >= 0.98 and true / (true + missed) >= 0.99
    assert exact >= 0.6 * len(rows)


def test_long_pages():
    for html in ("<p>" + "word, " * 200_000, "<div>" * 100_000 + "text", "x" * 1_000_000, "<p>a. b, c.</p>" * 60_000):
        assert isinstance(H.main_text(html), str)
    assert H.main_text("<p>" + "word, " * 200_000).count("word") == 200_000


def test_held_contexts_have_their_own_counts(spark):
    """More contexts than a model holds: those held are the most frequent, their counts exact, all others unknown."""
    rng = np.random.default_rng(1)
    urls = ["http://" + "".join(chr(97 + c) for c in rng.integers(0, 26, 30)) + ".com/" for _ in range(400)]
    df = spark.createDataFrame([(u, "allow") for u in urls], "url string, verdict string")
    exact = Counter()
    for u in urls:
        _, context, _ = U.keys([u.encode()])
        exact.update(context.ravel().tolist())
    whole, part = U.count_models(df)["allow"], U.count_models(df, most=3000)["allow"]
    assert dict(zip(whole.contexts.tolist(), whole.total[:-1])) == exact
    held = dict(zip(part.contexts.tolist(), part.total[:-1]))
    assert 0 < len(part.pairs) <= 3000 < len(whole.pairs) and all(exact[k] == n for k, n in held.items())
    assert min(held.values()) > max(n for k, n in exact.items() if k not in held)


def test_contexts_that_a_model_does_not_hold_count_all_the_same(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 6, 8))
    ends = [".com/a", ".net/es/b", ".org/c"]
    rows = [(i, f"http://{word()}{ends[i % 3]}{word()}", "") for i in range(600)]
    rows += [rows[2], rows[2], (1000, None, ""), (1001, "", ""), (None, "http://é.org/", "")]
    df = pages(spark, rows)
    key = lambda r: (str(r.page_id), r.difference)
    want = sorted(U.judge_urls(df, RULES).collect(), key=key)
    for most in (3000, 1):
        got = sorted(U.judge_urls(df, RULES, most=most).collect(), key=key)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert np.allclose([r.difference for r in got], [r.difference for r in want], rtol=1e-12, atol=1e-12)


LONG = "A paragraph of the text, which goes on for a while, as such paragraphs do, and then some more. It ends here, at last."


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", "<main><div>%s</div></main>"])
def test_ratios_decide_inside_a_marked_article(wrap):
    """Short blocks of their own paths are dropped there too; headings, lists, tables and quotations go with the text."""
    body = f"""<div class=top><span>12 min</span></div><h1>Title</h1><p>{LONG}</p><div class=in>short one</div><p>{LONG}</p><ul><li>step one<li>step two</ul>
        <blockquote>so they say</blockquote><div class=bottom><div>Read more</div></div>"""
    assert H.main_text(PAGE % (wrap % body)) == f"Title {LONG} short one {LONG} step one step two so they say"
