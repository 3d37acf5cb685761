"""Web-graph operators over a table of fetched pages (url, html)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import anchors, emails, host, links, normalize_url, resolve, socials, url_class, url_score
from ..sources.shared import cut, settled


def edges(pages: DataFrame) -> DataFrame:
    """Src, dst, fragment of each link that resolves; src and dst are normalised, without fragments."""
    page = settled(pages.select("url", normalize_url("url", False).alias("src"), links("html").alias("hrefs")))
    found = settled(page.select("url", "src", F.explode("hrefs").alias("href")).select("src", resolve("href", "url").alias("target"))).where("target is not null")
    return settled(found.select("src", normalize_url("target", False).alias("dst"), F.regexp_extract("target", r"#(.+)$", 1).alias("fragment"))).where("dst is not null")


def crawl(pages: DataFrame, seeds: DataFrame, depth: int = 3, max_pages: int | None = None) -> DataFrame:
    """G2 by depth: url and the least depth at which links from the seeds reach it, within the seed's host.

    Each level is one join of the last level with the links, less what is reached before. With `max_pages` a host has a
    budget: of a level the best by (score, length, address) enter while there is room. That is best-first within a
    level; an order over all levels would make every step wait for the one before.
    """
    links_ = cut(edges(pages).where(host("src") == host("dst")).select("src", "dst").distinct(), "links")
    reached = front = cut(seeds.select(normalize_url("url", False).alias("url")).distinct().withColumn("depth", F.lit(0)), "front")
    for level in range(1, depth + 1):
        step = front.join(links_, front.url == links_.src).select(F.col("dst").alias("url")).distinct()
        step = step.join(reached.select("url"), "url", "left_anti").withColumn("depth", F.lit(level))
        if max_pages is not None:
            used = reached.groupBy(host("url").alias("_h")).agg(F.count("*").alias("_used"))
            best = F.row_number().over(Window.partitionBy("_h").orderBy(url_score("url"), F.length("url"), "url"))
            step = step.withColumn("_h", host("url")).join(used, "_h", "left").withColumn("_rn", best)
            step = step.where(F.col("_rn") <= max_pages - F.coalesce("_used", F.lit(0))).drop("_h", "_used", "_rn")
        front = cut(step, "front")
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached


def ranked_links(pages: DataFrame, most: int, first: DataFrame | None = None) -> DataFrame:
    """src, key, score, length, pos: of each page its best `most` links to pages of its own host, by (score, length, pos).

    Of pages that share an address only that of `first` (key, url) counts, if it is given.

    `key` is the address without fragment; of several links to one the best counts. Score and length are those of the link
    as it stands, with its fragment and its anchor's text.
    """
    page = settled(pages.select(normalize_url("url", False).alias("src"), "url", "html"))
    if first is not None:
        page = page.join(first.select(F.col("key").alias("src"), "url"), ["src", "url"], "left_semi")
    # One step a column: each is used several times by the next. What is the page's is made once a page.
    page = settled(page.select("src", "url", host("src").alias("site"), anchors("html").alias("all")))
    found = page.select("src", "site", "url", F.posexplode("all").alias("pos", "a"))
    found = settled(found.select("src", "site", "pos", F.col("a.text").alias("said"), resolve("a.href", "url").alias("target"))).where("target is not null")
    found = settled(found.withColumn("child", normalize_url("target")).drop("target")).where("child is not null")
    found = settled(found.select("src", "site", "pos", normalize_url("child", False).alias("key"), url_score("child", "said").alias("score"), F.length("child").alias("length")))
    found = found.where((host("key") == F.col("site")) & (F.col("site") != "") & (url_class("key") == "page")).drop("site")
    # A page's links come from one row: dealt by page, they are moved once for both steps.
    best = found.repartition("src").groupBy("src", "key").agg(F.min(F.struct("score", "length", "pos")).alias("o")).select("src", "key", "o.*")
    place = F.row_number().over(Window.partitionBy("src").orderBy("score", "length", "pos"))
    return best.withColumn("_rn", place).where(F.col("_rn") <= most).drop("_rn")


def frontier(pages: DataFrame, seeds: DataFrame, max_pages: int = 25, max_depth: int = 2) -> DataFrame:
    """G2, best first: site, step, url, depth, score, ok of each attempt of a crawl of each host among seeds.

    pages (url, html) is what can be fetched; seeds (url, depth, score, ord) are what a host's crawl starts with, in order of
    ord. The frontier is ordered by (score, depth, length), then by when an address was found. An address is tried once; one
    that is not among pages is an attempt that fails. A crawl ends with `max_pages` pages fetched or max(4 * max_pages,
    max_pages + 20) attempts; pages deeper than `max_depth` are not entered.

    A host is one crawl, whose steps depend on each other; hosts are spread over tasks, which go through the rows of
    many hosts in order and keep one host's at a time. What is kept of a host is bounded whatever its size: of a page's links (and of the seeds) only the best ones up to the limit of attempts can ever be tried,
    since all better ones of that page are tried before, and only pages within the depth are expanded. So the links of a
    host are those of at most limit ** depth pages, joined level by level.

    Of pages that share an address the first by url counts (all rows of that url); seeds without a host, null links and rows of null html give nothing.
    """
    most = max(4 * max_pages, max_pages + 20)
    # Addresses begin alike, which makes sorting by them slow: joins with all pages go by a hash first.
    hashed = lambda rows: rows.withColumn("h", F.xxhash64("key"))
    named = cut(hashed(settled(pages.select(normalize_url("url", False).alias("key"), "url", "html")).where("key is not null")), "named")
    starts = settled(seeds.withColumns({"key": normalize_url("url", False), "length": F.length(normalize_url("url"))}).withColumn("site", host("key"))).where((F.col("site") != "") & (url_class("key") == "page"))
    best = starts.repartition("site").groupBy("site", "key").agg(F.min(F.struct("score", "depth", "length", "ord")).alias("o")).select("site", "key", "o.*")
    place = F.row_number().over(Window.partitionBy("site").orderBy("score", "depth", "length", "ord"))
    queue = cut(best.withColumn("_rn", place).where(F.col("_rn") <= most).drop("_rn"), "queue")
    # Only pages that a crawl can enter are read: those found at each depth, which are few beside all pages.
    opened, found, known = queue.select("key").limit(0), None, None
    for depth in range(max_depth):
        here = queue.where(F.greatest("depth", F.lit(0)) == depth).select("key")
        if found is not None:
            here = here.unionByName(found.select("key"))
        level = cut(here.distinct().join(opened, "key", "left_anti"), "level")
        opened = opened.unionByName(level)
        read = cut(named.join(hashed(level), ["h", "key"], "left_semi").drop("h"), "read")
        found = cut(ranked_links(read.drop("key"), most, read.groupBy("key").agg(F.min("url").alias("url"))), "links")
        known = found if known is None else known.unionByName(found)
    if known is None:
        known = queue.select(F.col("key").alias("src"), "key", "score", "length", F.lit(0).alias("pos")).limit(0)
    tried = hashed(queue.select("key").unionByName(known.select("key")).distinct())
    there = cut(named.select("h", "key").join(tried, ["h", "key"], "left_semi").select("key").distinct().withColumn("ok", F.lit(True)), "there")
    marked = lambda rows: rows.join(there, "key", "left").na.fill(False, ["ok"])
    queue, known = marked(queue), marked(known).withColumn("site", host("src"))
    begin = queue.select("site", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("src"), "score", "depth", "length", F.col("ord").cast("long").alias("pos"), "key", "ok")
    rows = begin.unionByName(known.withColumns({"kind": F.lit(1), "depth": F.lit(None).cast("int"), "pos": F.col("pos").cast("long")}))

    def crawl_host(site: str, starts: list[tuple], children: dict[str, list[tuple]]) -> list[tuple]:
        heap, n, seen, steps, fetched = [], 0, set(), [], 0
        for score, depth, length, key, ok in starts:
            heapq.heappush(heap, (score, depth, length, n, key, ok))
            n += 1
        while heap and fetched < max_pages and len(steps) < most:
            score, depth, _, _, url, ok = heapq.heappop(heap)
            if url in seen:
                continue
            seen.add(url)
            steps.append((site, len(steps), url, depth, score, ok))
            fetched += ok
            if ok and depth < max_depth:
                for score, length, child, has in children.get(url, ()):
                    if child not in seen:
                        heapq.heappush(heap, (score, depth + 1, length, n, child, has))
                        n += 1
        return steps

    made = pa.schema([("site", pa.string()), ("step", pa.int32()), ("url", pa.string()), ("depth", pa.int32()), ("score", pa.int32()), ("ok", pa.bool_())])
    batch_of = lambda steps: pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*steps, strict=True), made, strict=True)], schema=made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come host by host, starts before links, each in their order."""
        site, starts, children = None, [], {}
        for batch in batches:
            steps = []
            for at, kind, src, score, depth, length, key, ok in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != site:
                    steps += crawl_host(site, starts, children)
                    site, starts, children = at, [], {}
                if kind == 0:
                    starts.append((score, depth, length, key, ok))
                else:
                    children.setdefault(src, []).append((score, length, key, ok))
            if steps:
                yield batch_of(steps)
        if steps := crawl_host(site, starts, children):
            yield batch_of(steps)

    ordered = rows.repartition("site").sortWithinPartitions("site", "kind", "pos", "key")
    return ordered.select("site", "kind", "src", "score", "depth", "length", "key", "ok").mapInArrow(run, "site string, step int, url string, depth int, score int, ok boolean")


def unvisited(pages: DataFrame) -> DataFrame:
    """Linked pages that were never fetched, best keyword first."""
    have = pages.select(normalize_url("url", False).alias("dst")).distinct()
    return edges(pages).groupBy("dst").agg(F.count_distinct("src").alias("n_sources")).join(have, "dst", "left_anti").withColumns({"kind": url_class("dst"), "score": url_score("dst")})


def provenance(pages: DataFrame, listed: int = 20) -> DataFrame:
    """Mailboxes and profiles with the number of pages they stand on, and the first `listed` of these in order."""
    one = lambda kind, c: pages.select("url", F.lit(kind).alias("kind"), F.explode(c("html")).alias("entity"))
    rows = reduce(DataFrame.unionByName, [one("email", emails), one("social", socials)])
    once = rows.distinct().withColumn("_rn", F.row_number().over(Window.partitionBy("kind", "entity").orderBy("url")))
    return once.groupBy("kind", "entity").agg(F.count("*").alias("n_sources"), F.min("url").alias("first_url"), F.array_sort(F.collect_list(F.when(F.col("_rn") <= listed, F.col("url")))).alias("sources"))


def host_coverage(pages: DataFrame) -> DataFrame:
    """Of each host, pages, links, fragments and kinds of linked files."""
    e = edges(pages).groupBy(host("src").alias("host")).agg(F.count("*").alias("n_links"), F.count_if(F.col("fragment") != "").alias("n_fragments"), F.count_if(url_class("dst") != "page").alias("n_files"))
    p = pages.groupBy(host("url").alias("host")).agg(F.count("*").alias("n_pages"))
    return p.join(e, "host", "left").na.fill(0, ["n_links", "n_fragments", "n_files"])
