"""The best-first crawl against a plain list that is sorted before every step."""

import random
import re

import pytest

from prospectra.functions.vocab import PAGE_KEYWORDS
from prospectra.operators import graph

WORDS = ["a", "contact-us", "Team", "private_events", "menu.pdf", "x.png", "b", "c/d", "weddings"]


def score(url, text=""):
    hay = (url + " " + text).lower().replace("_", "-")
    return next((k for k, w in enumerate(PAGE_KEYWORDS) if w in hay), len(PAGE_KEYWORDS) + min(len(url) // 40, 10))


def is_page(url):
    return not re.search(r"\.(pdf|png)$", url)


def plain(pages, seeds, max_pages, max_depth):
    """For one host: sort, pop, try, append."""
    queue = [(s, d, u) for u, d, s, _ in sorted(seeds, key=lambda x: x[3])]
    seen, steps, got = set(), [], 0
    while queue and got < max_pages and len(steps) < max(4 * max_pages, max_pages + 20):
        queue.sort(key=lambda x: (x[0], x[1], len(x[2])))
        s, d, u = queue.pop(0)
        key = u.split("#")[0]
        if key in seen:
            continue
        seen.add(key)
        if not is_page(key):
            continue
        ok = key in pages
        steps.append((key, d, s, ok))
        got += ok
        if ok and d < max_depth:
            queue += [(score(c, t), d + 1, c) for c, t in pages[key] if is_page(c.split("#")[0]) and c.split("#")[0] not in seen]
    return steps


def made(rng, host, n):
    urls = [f"https://{host}/{rng.choice(WORDS)}" if rng.random() < 0.3 else f"https://{host}/{k}-{rng.choice(WORDS)}{'y' * rng.choice([0, 0, 60])}" for k in range(n)]
    target = lambda: rng.choice(urls) + rng.choice(["", "", "#cta", "#events-form"])
    pages = {u: [(target(), rng.choice(["", "go", "Private Events", "staff"])) for _ in range(rng.randrange(30))] for u in urls if is_page(u) and rng.random() < 0.8}
    seeds = [(urls[0] if is_page(urls[0]) else f"https://{host}/", 0, -1, 0)] + [(u, 1, score(u), k + 1) for k, u in enumerate(rng.sample(urls, min(4, n)))]
    return pages, seeds


@pytest.mark.parametrize(("max_pages", "max_depth"), [(4, 2), (25, 2), (3, 1), (10, 3), (2, 0)])
def test_crawls_are_the_plain_ones(spark, max_pages, max_depth):
    rng = random.Random(max_pages)
    hosts = {f"h{k}.example": made(rng, f"h{k}.example", n) for k, n in enumerate([1, 5, 30, 120, 400])}
    rows = [(u, "".join(f"<A class=x href='{c}'>\n {t} </A>" for c, t in found)) for pages, _ in hosts.values() for u, found in pages.items()]
    rows += [("https://other.example/", "<a href='https://h2.example/9'>x</a>"), (None, "<a href='/'>x</a>"), ("https://h1.example/null", None)]
    df = spark.createDataFrame(rows, "url string, html string")
    seeds = spark.createDataFrame([s for _, found in hosts.values() for s in found] + [("mailto:x", 0, 0, 9)], "url string, depth int, score int, ord int")
    got = {}
    for r in sorted(graph.frontier(df, seeds, max_pages, max_depth).collect(), key=lambda r: (r.site, r.step)):
        got.setdefault(r.site, []).append((r.url, r.depth, r.score, r.ok))
    assert got == {h: steps for h, (pages, found) in hosts.items() if (steps := plain(pages, found, max_pages, max_depth))}


def test_attempts_are_bounded(spark):
    """A front page with thousands of dead links: the crawl gives up, and its task gets no more links than it may try."""
    html = "".join(f'<a href="/p{k:05}">x</a>' for k in range(5000))
    pages = spark.createDataFrame([("https://h.example/", html)], "url string, html string")
    seeds = spark.createDataFrame([("https://h.example", 0, -1, 0)], "url string, depth int, score int, ord int")
    rows = graph.frontier(pages, seeds, 5).collect()
    assert len(rows) == 25 and sum(r.ok for r in rows) == 1
    assert graph.ranked_links(pages, 25).count() == 25


def test_no_pages(spark):
    nothing = spark.createDataFrame([], "url string, html string")
    seeds = spark.createDataFrame([("https://h.example", 0, -1, 0)], "url string, depth int, score int, ord int")
    assert [(r.url, r.ok) for r in graph.frontier(nothing, seeds).collect()] == [("https://h.example/", False)]
    assert graph.frontier(nothing, seeds.limit(0)).collect() == []
