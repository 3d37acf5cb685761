"""Sitemaps of every shape, and a site's queue of them within its limits against a plain queue."""

import random
from collections import deque

from prospectra.functions.vocab import PAGE_KEYWORDS
from prospectra.sources import sitemaps


def frame(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_entries(spark):
    files = [
        ("a", "<urlset><url><loc> x&amp;y\n</loc></url><url><lastmod>1</lastmod></url><url><loc>z</loc></url></urlset>"),
        ("b", "<s:sitemapindex xmlns:s='u'><s:sitemap><s:loc>m1</s:loc></s:sitemap><s:sitemap><s:loc>m2</s:loc></s:sitemap></s:sitemapindex>"),
        ("c", "<urlset><url><loc>one</loc></url><url><loc>https://h/sitemap2.XML?x</loc></url><url>"),
        ("d", None), ("e", ""), ("f", "<html><p>not found</html>"), ("g", "<urlset><url><loc/></url><!-- <loc>no</loc> --></urlset>"),
        ("h", "<sm:urlset><sm:url><SM:LOC>unbound &lt;&amp;</SM:LOC></sm:url>"),
    ]
    got = sorted((r.url, r.kind, r.pos, r["loc"]) for r in sitemaps.sitemap_entries(frame(spark, files, ["url", "xml"])).collect())
    assert got == [("a", "page", 0, "x&y"), ("a", "page", 1, "z"), ("b", "map", 0, "m1"), ("b", "map", 1, "m2"), ("c", "map", 0, "https://h/sitemap2.XML?x"), ("c", "page", 0, "one"), ("h", "page", 0, "unbound <&")]


def test_limits_of_a_file(spark):
    xml = "<urlset>" + "".join(f"<url><loc>u{k}</loc></url>" for k in range(30)) + "</urlset>"
    index = "<sitemapindex>" + "".join(f"<sitemap><loc>m{k}</loc></sitemap>" for k in range(30)) + "</sitemapindex>"
    rows = sitemaps.sitemap_entries(frame(spark, [("a", xml), ("b", index)], ["url", "xml"]), 4, 7).collect()
    assert [sorted(r["loc"] for r in rows if r.url == u) for u in "ab"] == [sorted(f"u{k}" for k in range(7)), sorted(f"m{k}" for k in range(4))]


def plain(origin, robots, files, limit, most_maps, most_nested, most_urls):
    """One site: a queue of files, its addresses with the place where each came first."""
    score = lambda u: next((k for k, w in enumerate(PAGE_KEYWORDS) if w in (u + " ").lower().replace("_", "-")), len(PAGE_KEYWORDS) + min(len(u) // 40, 10))
    first = {origin + p: (0, k) for k, p in enumerate(sitemaps.KNOWN_PATHS)}
    queue, seen = deque([origin + "/sitemap.xml", *robots]), []
    while queue and len(seen) < most_maps:
        m = queue.popleft()
        if m in seen or not m.startswith(origin):
            continue
        seen.append(m)
        kind, found = files.get(m, ("page", []))
        if kind == "map":
            queue.extend(found[:most_nested])
            continue
        for pos, u in enumerate(found[:most_urls]):
            if u.startswith(origin) and (score(u) < len(PAGE_KEYWORDS) or len([x for x in u[len(origin):].split("/") if x]) <= 2 or u.endswith(".pdf")) and not u.endswith(".png"):
                first.setdefault(u, (len(seen), pos))
    ranked = sorted(first, key=lambda u: (score(u), len(u), first[u]))
    pages, pdfs = [u for u in ranked if not u.endswith(".pdf")], [u for u in ranked if u.endswith(".pdf")]
    return pages[:limit], pdfs[: max(10, limit // 3)]


def test_seeds_are_those_of_a_queue(spark):
    rng = random.Random(3)
    sites, robots, files, want = [], [], {}, {}
    limits = dict(limit=33, most_maps=5, most_nested=3, most_urls=12)
    for k in range(12):
        origin = f"https://h{k}.example"
        names = [f"{origin}/m{j}.xml" for j in range(9)]
        ask = rng.sample(names, rng.randrange(4)) + ["https://elsewhere.example/m.xml"][: k % 2]
        make = lambda o=origin: rng.choice([o, o, o, "https://elsewhere.example"]) + rng.choice(["/a", "/a/b", "/a/b/c", "/x/y/weddings", "/d/e/f/g.pdf", "/i.png", "/press_kit"]) + rng.choice(["", "/" + "z" * rng.randrange(50), f"-{rng.randrange(40)}"])
        own = {}
        for name in rng.sample([f"{origin}/sitemap.xml", *names], rng.randrange(10)):
            own[name] = ("map", [rng.choice([*names, "https://elsewhere.example/m.xml"]) for _ in range(rng.randrange(6))]) if rng.random() < 0.5 else ("page", [make() for _ in range(rng.randrange(25))])
        sites += [(origin + "/start",), (origin,)]
        robots.append((origin + "/robots.txt", "User-agent: *\n" + "".join(f"sitemap: {u}\n" for u in ask)))
        files |= own
        want[f"h{k}.example"] = plain(origin, ask, own, **limits)
    wrap = {"map": ("sitemapindex", "sitemap"), "page": ("urlset", "url")}
    xml = [(u, f"<{wrap[kind][0]}>" + "".join(f"<{wrap[kind][1]}><loc>{x}</loc></{wrap[kind][1]}>" for x in found) + f"</{wrap[kind][0]}>") for u, (kind, found) in files.items()]
    got = sitemaps.discover_seeds(frame(spark, sites, ["url"]), frame(spark, robots, ["url", "body"]), frame(spark, xml, ["url", "xml"]), **limits).collect()
    for site, (pages, pdfs) in want.items():
        for kind, urls in (("page", pages), ("pdf", pdfs)):
            assert [r.url for r in sorted(got, key=lambda r: r.place) if r.site == site and r.kind == kind] == urls, (site, kind)


def test_no_sitemaps(spark):
    nothing = frame(spark, [], ["url", "xml"])
    rows = sitemaps.discover_seeds(frame(spark, [("https://h.example/x",), ("nonsense",)], ["url"]), frame(spark, [], ["url", "body"]), nothing).collect()
    assert {r.url for r in rows} == {"https://h.example" + p for p in sitemaps.KNOWN_PATHS}
