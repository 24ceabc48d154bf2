from collections import Counter, defaultdict

import numpy as np
import pytest

from rosterlake.llm import page_text
from rosterlake.llm.page_text import main_text, parse_page


def blocks(page):
    return [b.text for b in parse_page(page)[1] if not b.outside]


@pytest.mark.parametrize(
    "page,expected",
    [
        ("<p>One &amp; two&nbsp;three\n four<p>five<br>six", ["One & two three four", "five six"]),
        ("<p><b>open<br><p>next</b></p>", ["open", "next"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<script>var t='</p>';</script><style>p{}</style><title>x</title>y<!-- z -->", ["y"]),
        ("<div>a<nav>b</nav>c<aside>d</aside><form>e<input>f</form></div>", ["a", "c"]),
        ("<header>a</header><article><header><h1>T</h1></header>x<footer>f</footer></article><footer>g</footer>", ["T", "x"]),
        ('<div class="AdBox sidebarRight">a</div><div class="with-sidebar">b</div><div id=comments>c</div>', ["b"]),
        ('<div hidden>a</div><div style="display: none">b</div><p title="a > b">c</p>', ["c"]),
        ("a < b and <unknown-element>c</unknown-element> d", ["a < b and c d"]),
        ("<p>un<i>bro</i>ken &#228;&#x4e2d; &unknown; &lt;p&gt;", ["unbroken ä中 &unknown; <p>"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("</p></b>text</div>", ["text"]),
        ("<script>never closed", []),
        ("", []),
    ],
)
def test_blocks(page, expected):
    assert blocks(page) == expected


def test_unclosed_quotes_and_many_brackets_take_linear_time():
    assert parse_page("<a " * 20_000)[1] is not None
    assert parse_page("<p class='" * 2_000 + ">")[1] is not None


def page(n, host="h.org", extra=""):
    """A page whose template has no telling names."""
    links = "".join(f'<li><a href="/{n}{i}">word{n}{i}</a></li>' for i in range(3 + n % 3))
    return (
        n,
        f"http://{host}/{n}",
        f'<body><div class="c1"><span>Our Site</span></div><div class="c2"><ul>{links}</ul></div>'
        f'<div class="c3"><h1>Title {n}</h1><p>Text of {n}.</p>{extra}<p>Call us today</p></div>'
        f'<div class="c4">All about this site</div></body>',
    )


def texts(frame):
    return {r.page_id: r.text for r in main_text(frame).collect()}


SCHEMA = "page_id bigint, url string, html string"


def test_template_is_found_without_names(spark):
    rows = [page(n) for n in range(12)] + [(100, *page(3)[1:])] * 30  # copies do not change the template
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(found[n] == f"Title {n}\n\nText of {n}." for n in range(12))


@pytest.mark.parametrize("pages", (2, 3, 7, 8))
def test_hosts_with_few_pages_have_a_template(spark, pages):
    found = texts(spark.createDataFrame([page(n) for n in range(pages)], SCHEMA))
    assert all(found[n] == f"Title {n}\n\nText of {n}." for n in range(pages))


def test_one_page_has_no_template(spark):
    found = texts(spark.createDataFrame([page(0), (7, *page(0)[1:])], SCHEMA))
    assert found[0] == found[7] and found[0].startswith("Our Site\n\nword00\n\nword01")


def test_few_pages_do_not_lose_what_their_articles_share(spark):
    """Long texts and those in articles stay, though they are on all of the few pages."""
    shared = "a sentence that both pages have and that goes on for a while " * 5
    rows = [(n, f"http://h.org/{n}", f"<article><h1>Same</h1><p>{shared}</p><p>Page {n}</p></article>") for n in range(3)]
    rows += [(10 + n, f"http://i.org/{n}", f"<div><p>{shared}</p><p>Page {n}</p></div><div>foot</div>") for n in range(3)]
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert all(found[n] == f"Same\n\n{shared.strip()}\n\nPage {n}" for n in range(3))
    assert all(found[10 + n] == f"{shared.strip()}\n\nPage {n}" for n in range(3))


@pytest.mark.parametrize("name", ("social-science", "form-of-life", "menuPlanning", "search-history"))
def test_names_with_other_words_only_weigh(name):
    long = "much text of an article " * 30
    assert blocks(f'<div class="{name}"><h2>Head</h2><p>{long}</p></div>') == ["Head", long.strip()]
    assert blocks(f'<div class="{name}">short</div><p>b</p>') == ["b"]
    assert blocks(f'<div class="{name}"><a href="x">{long}</a></div><p>b</p>') == ["b"]
    assert blocks(f'<div class="{name.split("-")[0].replace("Planning", "")}-box left"><p>{long}</p></div><p>b</p>') == ["b"]


def brute_templates(rows):
    """host -> (skeleton, fixed, sure), from the vectors of all tokens over all pages of a host."""
    hosts = defaultdict(dict)
    for _, url, html in rows:
        hosts[url.split("/")[2]][html] = parse_page(html)
    out = {}
    for host, parsed in hosts.items():
        if len(parsed) < page_text.PAGES:
            continue
        vectors = defaultdict(Counter)
        for html, both in parsed.items():
            tokens, times, *_ = page_text.page_tokens(*both)
            for token, n in zip(tokens, times, strict=True):
                vectors[token][html] += n
        classes = defaultdict(list)
        for token, vector in vectors.items():
            classes[frozenset(vector.items())].append(token)
        sure = len(parsed) >= page_text.SURE
        least = page_text.SHARE * len(parsed) if sure else len(parsed)
        valid = [(v, t) for v, t in classes.items() if len(v) >= least and len(t) > 1]
        if valid:
            skeleton = {t for v, ts in valid if all(n == 1 for _, n in v) for t in ts}
            out[host] = (skeleton, {t for _, ts in valid for t in ts}, sure)
    return out


def test_templates_are_those_of_all_vectors(spark):
    random = np.random.default_rng(4)
    rows = []
    for h, pages in enumerate((1, 2, 3, 9, 15)):
        for n in range(pages):
            parts = [f'<div class="a{random.integers(4)}">t{random.integers(3)}</div>' for _ in range(4)]
            fixed = "".join(f'<div class="f{k}">fixed {k}</div>' * (1 + k % 2) for k in range(3) if random.random() < 0.95)
            rows.append((len(rows), f"http://h{h}.org/{n}", f"{fixed}{''.join(parts)}<p>page {n}</p>"))
    frame = spark.createDataFrame([*rows, rows[5], rows[5]], SCHEMA)
    parsed = page_text.parsed_pages(frame, "page_id", "url", "html")
    names = {r.site: r.host for r in parsed.selectExpr("xxhash64(host) AS site", "host").distinct().collect()}
    found = {names[r.site]: (set(r.skeleton), set(r.fixed), r.sure) for r in page_text.templates(parsed).collect()}
    assert found == brute_templates(rows) and len(found) >= 3


def test_what_many_but_not_all_pages_share_stays(spark):
    rows = [page(n, extra="<p>A passage in half of the pages</p>" if n % 2 else "") for n in range(20)]
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert found[1] == "Title 1\n\nText of 1.\n\nA passage in half of the pages"


def test_odd_rows(spark):
    rows = [
        (1, None, "<article>a</article><p>b</p>"), (1, None, "<article>a</article><p>b</p>"), (2, "no url", None),
        (None, "http://x/", ""), (3, "http://x/", "<p>" + "long " * 100_000 + "</p>"), (4, "http://x/", "plain &lt;text"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", host string, blocks int")
    found = sorted((tuple(r) for r in main_text(frame).collect()), key=str)
    long = ("long " * 100_000).strip()
    assert found == sorted(
        [(1, None, "a", 1)] * 2 + [(2, "no url", "", 0), (None, "http://x/", "", 0), (3, "http://x/", long, len(long)), (4, "http://x/", "plain <text", 11)],
        key=str,
    )
    assert main_text(frame.limit(0)).count() == 0
