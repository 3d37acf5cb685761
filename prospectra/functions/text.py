"""URLs, mailboxes, social profiles and other strings, as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is made once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def host(url: Column | str) -> Column:
    """The lower-cased host, less one leading `www.`; empty if there is none."""
    found = F.regexp_extract(F.lower(col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(found, r"^www\.", "")


def with_scheme(url: Column | str) -> Column:
    """An address as people write it, with https if it has no scheme."""
    u = F.trim(col(url))
    return F.when(F.contains(u, F.lit("://")), u).otherwise(F.concat(F.lit("https://"), u))


def site_host(url: Column | str) -> Column:
    """The host of a website on file, which may lack a scheme; empty if there is none."""
    u = col(url)
    return F.when(F.trim(u) == "", "").otherwise(host(with_scheme(u)))


def bare_domain(url: Column | str) -> Column:
    """Scheme and every `www.` removed, up to the first slash."""
    plain = F.lower(col(url))
    for part in ("https://", "http://", "www."):
        plain = F.replace(plain, F.lit(part), F.lit(""))
    return F.split_part(plain, F.lit("/"), F.lit(1))


def path(url: Column | str) -> Column:
    return F.regexp_extract(col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def same_origin(a: Column | str, b: Column | str) -> Column:
    """T2."""
    return (host(a) == host(b)) & (host(a) != "")


def unescape_html(c: Column) -> Column:
    def plain_text(x: Column) -> Column:
        out = x
        for name, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            out = F.replace(out, F.lit(name), F.lit(plain))
        return F.when(F.contains(x, F.lit("&")), out).otherwise(x)

    return let(c, plain_text)


def escape_html(c: Column) -> Column:
    """T25."""
    for plain, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(name))
    return c


#: Addresses that are normalised as they stand: lower-case host, no query, no slash at the end of a path, printable ASCII without `&`.
NORMAL_URL = r"""^https?://[a-z0-9.:-]+/(?:[!"$%'->@-~]*[!"$%'-.0->@-~])?(?:#[!-%'-~]+)?\z"""


def normalize_url(url: Column | str, keep_fragment: bool = True) -> Column:
    """T3 for absolute URLs: null unless http(s); tracking parameters, trailing slashes and user-visible case of scheme and host removed."""
    keep = lambda x: (x != "") & ~F.lower(x).rlike("^(utm_[^=]*|" + "|".join(vocab.TRACKING_KEYS) + ")(=|$)")
    led = lambda mark, x: let(x, lambda v: F.when(v != "", F.concat(F.lit(mark), v)).otherwise(""))

    def parts(u: Column) -> Column:
        p = let(F.regexp_replace(path(u), r"/+$", ""), lambda x: F.when(x == "", "/").otherwise(x))
        query = led("?", F.array_join(F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"), keep), "&"))
        out = [p, query, led("#", F.regexp_extract(u, r"#(.+)$", 1))] if keep_fragment else [p, query]
        return let(F.lower(F.regexp_extract(u, r"(?i)^(https?://[^/?#]+)", 1)), lambda base: F.when(base != "", F.concat(base, *out)))

    plain = (lambda u: u) if keep_fragment else (lambda u: F.substring_index(u, "#", 1))
    return let(F.trim(unescape_html(col(url))), lambda u: F.when(u.rlike(NORMAL_URL), plain(u)).otherwise(parts(u)))


def resolve(href: Column | str, page: Column | str) -> Column:
    """A link of a page as an absolute URL: absolute, `//host`, `/path`, `?query` and plain relative ones; null for other schemes."""
    p = col(page)
    origin = F.regexp_extract(p, r"(?i)^(https?://[^/?#]+)", 1)
    folder = let(F.regexp_replace(path(p), r"[^/]*$", ""), lambda x: F.when(x == "", "/").otherwise(x))
    plain = F.regexp_replace(p, r"#.*$", "")
    return let(
        F.trim(unescape_html(col(href))),
        lambda h: F.when(h.rlike(r"(?i)^https?://"), h)
        .when(h.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(h.startswith("//"), F.concat(F.lower(F.regexp_extract(p, r"(?i)^(https?:)", 1)), h))
        .when(h.startswith("/"), F.concat(origin, h))
        .when(h.startswith("#"), F.concat(plain, h))
        .when(h.startswith("?"), F.concat(F.regexp_replace(plain, r"\?.*$", ""), h))
        .otherwise(F.concat(origin, folder, h)),
    )


def extension(url: Column | str) -> Column:
    """T4: what follows the last dot of the last path segment, lower-cased."""
    return F.lower(F.regexp_extract(path(url), r"\.([^./]*)$", 1))


def url_class(url: Column | str) -> Column:
    return let(extension(url), lambda e: F.when(e == "pdf", "pdf").when(e.isin(*vocab.ASSET_EXTENSIONS), "asset").otherwise("page"))


def url_score(url: Column | str, anchor: Column | str | None = None) -> Column:
    """T5: the place of the first keyword found; else past the last, by length. Underscores count as hyphens, so keywords with one never match."""
    u, n = col(url), len(vocab.PAGE_KEYWORDS)
    hay = F.replace(F.lower(F.concat(u, F.lit(" "), col(anchor) if anchor is not None else F.lit(""))), F.lit("_"), F.lit("-"))

    def place(h: Column) -> Column:
        out = None
        for k, word in enumerate(vocab.PAGE_KEYWORDS):
            test = F.contains(h, F.lit(word))
            out = F.when(test, k) if out is None else out.when(test, k)
        return out.otherwise(F.least(F.floor(F.length(u) / 40), F.lit(10)).cast("int") + n)

    return let(hay, place)


def clean_email(c: Column | str) -> Column:
    """Null if it is no usable mailbox."""
    e = F.lower(F.regexp_replace(F.trim(col(c)), r"^[.,;:()\[\]{}<>\"']+|[.,;:()\[\]{}<>\"']+$", ""))
    bad = (F.length(e) > 120) | ~F.contains(e, F.lit("@")) | vocab.any_of(e, vocab.JUNK_MAIL) | e.rlike("^(" + vocab.pattern(vocab.REJECTED_MAIL) + ")")
    return F.when(~(bad | e.rlike(r"\.(png|jpe?g|gif|svg|webp|css|js|pdf|docx?|xlsx?|zip)$")), e)


def decode_cf(c: Column | str) -> Column:
    """Hex digits, each byte xor the first."""
    x = col(c)
    byte = lambda at: F.conv(F.substring(x, at, 2), 16, 10).cast("int")
    key = F.conv(F.substring(x, 1, 2), 16, 10).cast("int")
    places = F.when(F.length(x) >= 4, F.sequence(F.lit(3), F.length(x) - 1, F.lit(2)))
    return F.array_join(F.transform(places, lambda i: F.char(byte(i).bitwiseXOR(key))), "")


def deobfuscate(c: Column | str) -> Column:
    """T8."""
    t = F.regexp_replace(col(c), r"(?i)\s*(?:\[at\]|\(at\)|\{at\})\s*", "@")
    t = F.regexp_replace(t, r"(?i)\s*(?:\[dot\]|\(dot\)|\{dot\})\s*", ".")
    return F.regexp_replace(t, r"(?i)\b([A-Z0-9._%+\-]+)\s+at\s+([A-Z0-9.\-]+)\s+dot\s+([A-Z]{2,})\b", r"$1@$2.$3")


def emails(c: Column | str) -> Column:
    """Distinct clean mailboxes of a text, plain, spelled out or encoded, in order."""
    t = F.coalesce(col(c), F.lit(""))
    plain = F.regexp_extract_all(deobfuscate(t), F.lit(r"(?i)([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})"), 1)
    hidden = F.transform(F.regexp_extract_all(t, F.lit(r"data-cfemail=[\"']([a-fA-F0-9]+)[\"']"), 1), decode_cf)
    return F.array_distinct(F.filter(F.transform(F.concat(plain, hidden), clean_email), lambda e: e.isNotNull()))


def generic_email(c: Column | str) -> Column:
    return col(c).rlike("^(" + vocab.pattern(vocab.GENERIC_MAIL) + ")")


def links(html: Column | str) -> Column:
    """The targets of anchors, in order, with repeats."""
    return F.regexp_extract_all(col(html), F.lit(r"(?i)<a\b[^>]*href=[\"']([^\"']+)[\"']"), 1)


def anchors(html: Column | str) -> Column:
    """T11 with what stands in the anchors: array of (href, text), in order, with repeats; tags in a text are dropped and white space is one blank."""
    found = r"(?is)<a\b[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a\s*>"
    plain = lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, r"<[^>]*>", " "), r"\s+", " "))
    return F.zip_with(F.regexp_extract_all(col(html), F.lit(found), 1), F.regexp_extract_all(col(html), F.lit(found), 2), lambda h, t: F.struct(h.alias("href"), plain(t).alias("text")))


def social_variants(c: Column | str) -> Column:
    """The text, without script escapes, and percent-decoded at most twice."""
    raw = unescape_html(F.coalesce(col(c), F.lit("")))
    plain = F.replace(F.regexp_replace(F.regexp_replace(raw, r"\\u002[fF]", "/"), r"\\u003[aA]", ":"), F.lit("\\/"), F.lit("/"))
    once = F.coalesce(F.try_url_decode(plain), plain)
    return F.array_distinct(F.array(raw, plain, once, F.coalesce(F.try_url_decode(once), once)))


def social_profile(c: Column | str) -> Column:
    """The canonical profile URL of a Facebook or Instagram link, or null."""
    u = F.regexp_replace(F.trim(unescape_html(col(c))), r"[.,;:)\]}\"']+$", "")
    u = F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(u)
    h, parts = host(u), F.filter(F.split(path(u), "/"), lambda p: p != "")
    first, low, last = F.try_element_at(parts, F.lit(1)), F.lower(F.try_element_at(parts, F.lit(1))), F.try_element_at(parts, F.lit(-1))
    page_id = F.regexp_extract(u, r"[?&]id=([0-9]+)(?:&|#|$)", 1)
    fb = (
        F.when((low == "profile.php") & (page_id != ""), F.concat(F.lit("https://www.facebook.com/profile.php?id="), page_id))
        .when(low == "profile.php", F.lit(None).cast("string"))
        .when((low == "pages") & (F.size(parts) >= 3) & last.rlike("^[0-9]+$"), F.concat(F.lit("https://www.facebook.com/"), F.array_join(F.slice(parts, 1, 3), "/")))
        .when(low.isin(*vocab.FB_RESERVED) | low.rlike("^[0-9]+$") | (F.length(low) < 2), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://www.facebook.com/"), first, F.lit("/")))
    )
    ig = F.when(~low.isin(*vocab.IG_RESERVED) & ~low.rlike("^[0-9]+$") & (F.length(low) >= 2) & first.rlike(r"^[A-Za-z0-9._]+$"), F.concat(F.lit("https://www.instagram.com/"), first, F.lit("/")))
    return F.when(first.isNull(), F.lit(None).cast("string")).when(h.endswith("facebook.com"), fb).when(h.endswith("instagram.com"), ig)


def socials(c: Column | str) -> Column:
    """Distinct profiles of a text, in order."""
    found = lambda v: F.regexp_extract_all(v, F.lit(r"(?i)((?:https?:)?//(?:www\.|m\.|web\.)?(?:facebook|instagram)\.com/[^\s\"'<>]+)"), 1)
    return F.array_distinct(F.filter(F.transform(F.flatten(F.transform(social_variants(c), found)), social_profile), lambda x: x.isNotNull()))


def contact_form(url: Column | str, html: Column | str) -> Column:
    """By address, or by a form with a message field."""
    u, h = F.lower(col(url)), F.lower(col(html))
    by_url = u.rlike("contact|inquir|enquir|book") & (url_class(u) == "page")
    return by_url | h.rlike(r"(?s)<form[^>]*(contact|inquir|message)") | h.rlike(r"(?s)<form.{0,2000}<textarea")


def structured_emails(html: Column | str) -> Column:
    """Mailboxes inside JSON-LD scripts."""
    return emails(F.array_join(F.regexp_extract_all(col(html), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), 1), " "))


_ACCENTED, _PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def plain_name(c: Column | str) -> Column:
    """Lower-cased letters and digits, Latin accents removed."""
    return F.regexp_replace(F.translate(F.lower(F.coalesce(col(c), F.lit(""))), _ACCENTED, _PLAIN), "[^a-z0-9]", "")


def display_name(email: Column | str) -> Column:
    """The local part as a name."""
    return F.initcap(F.trim(F.regexp_replace(F.split_part(col(email), F.lit("@"), F.lit(1)), r"[-_.]+", " ")))


def rating(c: Column | str) -> Column:
    """Rating, reviews and price level of a card."""
    t = col(c)
    number = F.replace(F.regexp_extract(t, r"\(([0-9,]+)\)", 1), F.lit(","), F.lit("")).try_cast("long")
    return F.struct(F.regexp_extract(t, r"([0-9]\.[0-9])", 1).try_cast("double").alias("rating"), number.alias("reviews"), F.length(F.regexp_extract(t, r"(?:^|[^$])(\${1,4})(?:[^$]|$)", 1)).alias("price"))


def step_map(c: Column | str) -> Column:
    """`step:STATUS[:detail]` joined by bars as a map; `CHECKED:` parts are skipped, later ones win."""
    parts = F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\|"), lambda p: (p != "") & ~p.startswith("CHECKED:") & F.contains(p, F.lit(":")))
    entry = lambda p: F.struct(F.split_part(p, F.lit(":"), F.lit(1)).alias("step"), F.struct(F.split_part(p, F.lit(":"), F.lit(2)).alias("status"), F.regexp_extract(p, r"^[^:]*:[^:]*:(.*)$", 1).alias("detail")).alias("value"))
    last = lambda all_, e: F.concat(F.filter(all_, lambda x: x.step != e.step), F.array(e))
    kind = "array<struct<step:string,value:struct<status:string,detail:string>>>"
    return F.map_from_entries(F.aggregate(F.transform(parts, entry), F.array().cast(kind), last))


def step_text(m: Column | str) -> Column:
    """The inverse of step_map."""
    part = lambda e: F.concat(e.key, F.lit(":"), e.value.status, F.when(e.value.detail != "", F.concat(F.lit(":"), e.value.detail)).otherwise(""))
    return F.array_join(F.transform(F.map_entries(col(m)), part), "|")


def words(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit("([a-z0-9]+)"), 1)


def slugs(c: Column | str) -> Column:
    """Candidate names of a domain: words joined by nothing, hyphens and dots."""
    w = words(c)
    return F.array_distinct(F.array(F.array_join(w, ""), F.array_join(w, "-"), F.array_join(w, ".")))


def city_state(c: Column | str, states: tuple[str, ...] = ("DC", "MD", "VA", "PA", "DE", "WV")) -> Column:
    """The first state in an address, and the comma part before it."""
    t = F.coalesce(col(c), F.lit(""))
    state = F.regexp_extract(t, r"\b(" + "|".join(states) + r")\b", 1)
    before = F.regexp_extract(t, r"^(.*?)\b(?:" + "|".join(states) + r")\b", 1)
    city = F.trim(F.element_at(F.split(F.regexp_replace(before, r"[\s,]+$", ""), ","), -1))
    return F.struct(F.when(city.rlike("^[0-9]"), "").otherwise(city).alias("city"), state.alias("state"))


def header_key(c: Column | str) -> Column:
    """T30."""
    return F.translate(F.lower(col(c)), "_ ", "")


def hms_seconds(c: Column | str) -> Column:
    part = lambda k: F.split_part(col(c), F.lit(":"), F.lit(k)).try_cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def context_person(c: Column | str) -> Column:
    """Name and title from the lines around a mailbox: the first two that are no address, number or heading."""
    lines = F.transform(F.split(F.coalesce(col(c), F.lit("")), "\n"), lambda x: F.trim(x))
    odd = r"(?i)^[0-9(+]|^(CONTACT|MAIN PHONE|RECIPROCAL|CLUB MANAGEMENT|PLEASE)"
    kept = F.filter(lines, lambda x: (x != "") & ~x.contains("@") & ~x.rlike(odd))
    # Lines before a name are passed over if they are too short or long; the line after it is a title or there is none.
    places = F.filter(F.sequence(F.lit(1), F.size(kept)), lambda i: F.length(F.get(kept, i - 1)).between(3, 49))
    at = F.when(F.size(kept) > 0, F.try_element_at(places, F.lit(1)))
    title = F.try_element_at(kept, at + 1)
    return F.struct(F.coalesce(F.initcap(F.try_element_at(kept, at)), F.lit("")).alias("name"), F.coalesce(F.when(F.length(title).between(3, 79), F.initcap(title)), F.lit("")).alias("title"))


QUERY_WORDS = ("luxury", "hotel", "fine", "dining", "restaurant", "french", "european", "historic", "bistro", "private", "club", "wine", "bar", "country", "winery", "yacht", "upscale", "italian", "boutique", "inn", "museum", "event", "space", "art", "gallery")


def query_place(c: Column | str, states: tuple[str, ...] = ("DC", "MD", "VA", "PA", "DE", "WV")) -> Column:
    """City and state of a search text: the words before the state that name no kind of venue."""
    t = F.coalesce(col(c), F.lit(""))
    any_state = "|".join(states)
    state = F.regexp_extract(t, rf"\b({any_state})\b", 1)
    before = F.regexp_replace(F.regexp_extract(t, rf"^(.*?)\b(?:{any_state})\b", 1), r"[\s,]+$", "")
    words_ = F.filter(F.split(before, r"\s+"), lambda w: (w != "") & ~F.lower(w).isin(*QUERY_WORDS))
    return F.struct(F.array_join(words_, " ").alias("city"), state.alias("state"))


def notes_place(c: Column | str, compat: str = "fixed") -> Column:
    """Capitalised words before a state in notes; `fixed` drops the words `in` and `at` before them, `ref` any leading characters of them."""
    found = F.trim(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"((?:in |at )?[A-Z][a-z]+(?:\s[A-Z][a-z]+)*,?\s*(?:VA|MD|DC|PA))", 1))
    plain = F.regexp_replace(F.regexp_replace(found, "^[in ]+", ""), "^[at ]+", "") if compat == "ref" else F.regexp_replace(found, "^(in|at) ", "")
    return F.nullif(plain, F.lit(""))


def named_segments(c: Column | str, names: Column) -> Column:
    """W-g: for each of the names, in their order, the part of a text from its first place to the next name's."""
    t = col(c)
    starts = F.transform(names, lambda n: F.instr(t, n))
    end = lambda i: F.coalesce(F.array_min(F.filter(starts, lambda s: s > F.get(starts, i))), F.length(t) + 1)
    return F.transform(names, lambda n, i: F.struct(n.alias("name"), F.when(F.get(starts, i) > 0, t.substr(F.get(starts, i), end(i) - F.get(starts, i))).alias("segment")))


PAGE_ORDER = ("contact", "staff", "team", "wedding", "event", "banquet", "cater", "entertain", "music", "party", "book", "rental", "meeting", "corporate", "about", "press", "media")


def subpage_rank(url: Column | str) -> Column:
    """The place of the first keyword of a sub-page's address, or the number of keywords."""
    out = None
    for k, word in enumerate(PAGE_ORDER):
        test = F.contains(F.lower(col(url)), F.lit(word))
        out = F.when(test, k) if out is None else out.when(test, k)
    return out.otherwise(len(PAGE_ORDER))
