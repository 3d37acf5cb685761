"""Named queries over pages with nested markup and JSON-LD, one a customer or supplier, each beside its SQL.

The pages are made from the tables; the SQL never reads them: it says what they hold, by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import structured
from ..sources import markup, pdf
from ..sources.projection import pick
from ..sources.shared import spread
from .catalog import Compared
from .queries import table

BOOK = Compared()
QUERIES, ORACLE_SQL = BOOK.queries, BOOK.oracle_sql

# ---------------------------------------------------------------- JSON-LD

LD = """CASE c_custkey % 6
 WHEN 0 THEN '<script type="application/ld+json">{"@context":"x","@graph":[{"@type":"Org","contactPoint":[{"email":"mailto:Ann@H"},{"n":1,"x":[["bo@H, cy@H"]]}]},"di@H"]}</script>'
 WHEN 1 THEN '<script type="application/ld+json">{"email":"no@H", "a": [</script>'
 WHEN 2 THEN '<SCRIPT id=a TYPE=application/ld+json>"only@H"</SCRIPT>'
 WHEN 3 THEN '<script type="application/ld+json">{"email":null,"n":5,"a":[],"o":{},"t":true}</script>'
 WHEN 4 THEN '<script type=''application/ld+json''>{"email":</script><p>no@H</p><script type="application/ld+json">{"a":{"b":{"c":{"d":{"e":["deep@H","deep@H"]}}}}}</script>'
 ELSE '<script>{"email":"no@H"}</script><a href="mailto:no@H">x</a>' END"""


@BOOK.compared("""WITH x AS (SELECT c_custkey AS page_id, 'v' || c_custkey || '.example.org' AS h FROM customer)
SELECT page_id, unnest(CASE page_id % 6 WHEN 0 THEN ['ann', 'bo', 'cy', 'di'] WHEN 2 THEN ['only'] WHEN 4 THEN ['deep'] ELSE [] END) || '@' || h AS email FROM x""")
def structured_mailboxes(s, d):
    """Nested graphs, roots that are strings, broken scripts beside good ones, mailboxes that are in no script."""
    html = F.replace(F.expr(LD), F.lit("@H"), F.concat(F.lit("@v"), F.col("c_custkey").cast("string"), F.lit(".example.org")))
    return structured.structured_mailboxes(spread(table(s, d, "customer")).select(F.col("c_custkey").alias("page_id"), html.alias("html")), "page_id")


# ---------------------------------------------------------------- people

STAFF = """CASE c_custkey % 5
 WHEN 0 THEN '<table><tr><th>Name<th>Role<tr><td>ann <b>LEE</b><td>events manager<td><a href="mailto:Ann@H?subject=x">write</a><tr><td>Bo Moss</td><td>Chef</td><td><a href="mailto:bo@H">write</a></td></tr></table>'
 WHEN 1 THEN '<ul><li>CONTACT<br>(410) 555-0100<br>cy nash<br>director of <i>sales</i><br><a href="mailto:cy@H">cy@H</a><li>Di Oak<p><a href=mailto:di@H>mail</a></ul>'
 WHEN 2 THEN '<div id=top><h2>Our Club</h2><div><p>Ed Page</p><p>Owner &amp; Host</p><span><a data-cfemail="CF" href="/x">hidden</a></span></div></div>'
 WHEN 3 THEN '<div><script>var x = "<div>No Body</div>";</script><style>p {}</style><p>Flo Quill<p>Sommelier<p><a href="mailto:flo@H"></a></div><div>Gus Ray <a href="mailto:flo@H">again</a></div>'
 ELSE '<p>No Name <a href="mailto:nobody">x</a> <a href="/mailto:ann@H">y</a>' END"""


@BOOK.compared("""WITH x AS (SELECT c_custkey AS page_id, 'v' || c_custkey || '.example.org' AS h FROM customer),
y AS (SELECT page_id, h, unnest(CASE page_id % 5 WHEN 0 THEN [['ann', 'Ann Lee', 'Events Manager'], ['bo', 'Bo Moss', 'Chef']] WHEN 1 THEN [['cy', 'Cy Nash', 'Director Of Sales'], ['di', 'Di Oak', 'Mail']]
 WHEN 2 THEN [['ed', 'Ed Page', 'Owner & Host']] WHEN 3 THEN [['flo', 'Flo Quill', 'Sommelier']] ELSE [] END) AS p FROM x)
SELECT page_id, p[1] || '@' || CASE WHEN p[1] = 'ed' THEN 'venue.org' ELSE h END AS email, p[2] AS name, p[3] AS title FROM y""")
def mailbox_people(s, d):
    """Names and titles from the row, item or division round a mailbox, with cells and items left unclosed."""
    code = "".join(f"{b:02x}" for b in (0x21, *(b ^ 0x21 for b in b"Ed@venue.org")))
    html = F.replace(F.replace(F.expr(STAFF), F.lit("@H"), F.concat(F.lit("@v"), F.col("c_custkey").cast("string"), F.lit(".example.org"))), F.lit('"CF"'), F.lit(f'"{code}"'))
    return markup.mailbox_people(spread(table(s, d, "customer")).select(F.col("c_custkey").alias("page_id"), html.alias("html")), "page_id")


# ---------------------------------------------------------------- cards

TOWN, KIND = pick("p", "Easton, MD", "12 Main St, McLean, VA 22101", "Paris", "Reston, VA"), pick("p", "Museum", "Wine bar", "Hotel", "Boutique hotel", "Yacht club")
CARD = f"""concat('<div class="x Nv2PK"><a href="#"><span class="qBF1Pd big">Place <b>', cast(p AS varchar(20)), '</b></span></a>\n<div><span>', CASE WHEN p % 3 = 0 THEN '' ELSE concat('4.', cast(p % 10 AS varchar(20))) END,
 '</span><span>(1,', cast(100 + p % 900 AS varchar(20)), ')</span></div><div>', CASE p % 4 WHEN 0 THEN '' WHEN 1 THEN '$$' WHEN 2 THEN '$$$$' ELSE '3 stars' END, '<br>', {KIND}, ' · Open</div><ul><li>', {TOWN}, '<li>Closed Mondays</ul>',
 CASE WHEN p % 6 = 0 THEN '<div class="Nv2PK"><div class="qBF1Pd">Inner place</div></div>' ELSE '' END, '</div>')"""


@BOOK.compared(f"""WITH x AS (SELECT DISTINCT l_suppkey AS page_id, l_partkey AS p FROM lineitem)
SELECT page_id, 'Place ' || p AS name, CASE WHEN p % 3 <> 0 THEN 4 + (p % 10) / 10.0 END AS rating, CAST(1100 + p % 900 AS bigint) AS reviews, CASE p % 4 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 0 END AS price, {KIND} AS category, CASE WHEN p % 4 = 2 THEN '' ELSE {TOWN} END AS place FROM x""")
def page_cards(s, d):
    """Cards of result pages, with cards in cards, from nested markup."""
    # Only ids move: a page's text is made where the page is read.
    parts = spread(table(s, d, "lineitem").select(F.col("l_suppkey").alias("page_id"), F.col("l_partkey").alias("p")), "page_id").distinct()
    html = F.concat(F.lit('<html><body><h2>Results</h2><div role="feed">'), F.array_join(F.sort_array(F.expr(f"transform(l, p -> {CARD})")), "\n"), F.lit("</div></body>"))
    return markup.card_rows(parts.groupBy("page_id").agg(F.collect_list("p").alias("l")).select("page_id", html.alias("html")), "page_id", ("Nv2PK", "lI9IFe"), ("fontHeadlineSmall", "qBF1Pd"))


# ---------------------------------------------------------------- a directory

HEAD = pick("s_suppkey", "<h1>Blue <em>Ridge</em> Winery</h1><h2>Hours</h2>", "<header><h2>Old Town\n Cellars</h2></header>", "<p>No head</p>")
STREET = pick("s_suppkey", "<p>12 Vine Rd, Mount Airy, MD 21771</p>", "<div>near <span>Ellicott City, MD</span></div>", "<p>by the road</p>", "<ul><li>7 Hill Ln, Easton, MD 21601<li>open</ul>")
SITE = pick("s_suppkey", '<a href="https://list.example/x">Home</a><a href="https://a.example.org/">Partner</a><a href="https://w.example.net/">\n Visit <b>Website</b></a>', '<a href="https://www.facebook.com/list.example">us</a><a href="https://b.example.org/x">b</a><a href="https://c.example.org/">c</a>', '<a href="/about">about</a>', '<a href="/go">visit site</a>', "")
SOCIAL = pick("s_suppkey", '<a href="https://www.Facebook.com/Cellar">f</a><a href="https://facebook.com/second">g</a>', '<a href="https://instagram.com/cellar/">i</a>', "")


@BOOK.compared(f"""SELECT s_suppkey AS page_id, {pick("s_suppkey", "Blue Ridge Winery", "Old Town Cellars", "")} AS name, {pick("s_suppkey", "12 Vine Rd, Mount Airy, MD 21771", "", "", "7 Hill Ln, Easton, MD 21601")} AS address,
 {pick("s_suppkey", "Mount Airy", "Ellicott City", "", "Easton")} AS city, {pick("s_suppkey", "https://w.example.net/", "https://b.example.org/x", "", "/go", "")} AS website, {pick("s_suppkey", "https://www.Facebook.com/Cellar", "", "")} AS facebook, {pick("s_suppkey", "", "https://instagram.com/cellar/", "")} AS instagram FROM supplier""")
def directory_venues(s: SparkSession, d: str) -> DataFrame:
    """Name, address, city, website and profiles of a directory's pages, each by its chain of places."""
    html = F.concat(*[F.expr(x) for x in (HEAD, STREET, SITE, SOCIAL)])
    return markup.directory_rows(spread(table(s, d, "supplier")).select(F.col("s_suppkey").alias("page_id"), html.alias("html")), "page_id", "list.example")


# ---------------------------------------------------------------- documents

SHEET = r"""concat('%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [3 0 R] >> endobj\n3 0 obj << /Type /Page /Contents 4 0 R >> endobj\n4 0 obj << >>\nstream\nBT 72 600 Td (Balance ',
 cast(cast(s_acctbal AS decimal(12, 2)) AS string), ') Tj 0 100 Td (', s_name, ') Tj 200 0 Td (No. ', cast(s_suppkey AS string), ' \\(', cast(s_nationkey AS string), '\\)) Tj -200 -50 Td [(ma) 10 (il) -400 (info@s', cast(s_suppkey AS string), '.example.org)] TJ ET\nendstream\nendobj\n%%EOF')"""


@BOOK.compared("""SELECT s_suppkey AS page_id, s_name || ' No. ' || s_suppkey || ' (' || s_nationkey || ')' || chr(10) || 'mail info@s' || s_suppkey || '.example.org' || chr(10) || 'Balance ' || CAST(CAST(s_acctbal AS decimal(12, 2)) AS varchar) AS shown, 'info@s' || s_suppkey || '.example.org' AS email FROM supplier""")
def document_texts(s, d):
    """One sheet a supplier, whose lines are written in another order than they are read; and the mailboxes in it."""
    sheets = spread(table(s, d, "supplier")).select(F.col("s_suppkey").cast("string").alias("path"), F.expr(SHEET).cast("binary").alias("content"))
    return pdf.pdf_texts(sheets).select(F.col("path").cast("long").alias("page_id"), F.col("text").alias("shown"), F.array_join(text.emails("text"), " ").alias("email"))


# ---------------------------------------------------------------- attributes

PLACE = """CASE c_custkey % 4
 WHEN 0 THEN '<div class="x"><span class="DkEaL">Wine bar</span><span>4.5</span><span> $$$ </span></div><div class="box"><h2>Highlights</h2><ul><li><span><span>Live music</span></span><li><span>Great wine list</span><li><span>12 photos</span><span>Photos</span><li aria-label="Rooftop seats"></ul></div><h3>Other</h3><span>Romantic</span>'
 WHEN 1 THEN '<button jsaction="pane.category">Country club</button><b aria-label="Price: $$">x</b><p class="LTs0Rc">Outdoor seating</p><p class="iP2t7d">Parking</p><p class="wmQCje">a) patio</p><i aria-label="Good for groups of every size and for all kinds of occasions, it says"></i><i aria-label="Sunday Brunch"></i>'
 WHEN 2 THEN '<div role="heading">Amenities</div><span>Wi-Fi</span><span>wi-fi</span><p class="LTs0Rc">Takeout</p>'
 ELSE '<p>Nothing' END"""


@BOOK.compared("""SELECT c_custkey AS page_id, CASE c_custkey % 4 WHEN 0 THEN 'Wine bar' WHEN 1 THEN 'Country club' ELSE '' END AS category, CASE c_custkey % 4 WHEN 0 THEN '$$$' WHEN 1 THEN '$$' ELSE '' END AS price,
 CASE c_custkey % 4 WHEN 0 THEN 'live music, great wine list, rooftop seats' WHEN 1 THEN 'outdoor seating, sunday brunch' WHEN 2 THEN 'wi-fi' ELSE '' END AS attributes FROM customer""")
def place_attributes(s, d):
    """Category, price and attributes of places' pages, by sections, rows and labels."""
    rows = markup.attribute_rows(spread(table(s, d, "customer")).select(F.col("c_custkey").alias("page_id"), F.expr(PLACE).alias("html")), "page_id")
    return rows.withColumn("attributes", F.array_join("attributes", ", "))
