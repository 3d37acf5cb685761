"""Pages as trees: one tokenizer with a stack of open elements, and what is read from the tree.

The tokenizer is the standard library's; the tree adds what it leaves out: elements without end tags, end tags that are
implied, and the lines of what a reader sees (a line ends at a block, a break or a table row; scripts and styles show
nothing). Pages are parsed one at a time inside Arrow batches: a page is the unit of work and no page waits for another.

Defined cases: a null or empty page has nothing; broken markup gives the tree that its tags make, unclosed elements end
with their parent; end tags that match nothing are ignored; deep nesting is kept in lists, not on Python's stack.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import takewhile, zip_longest

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Elements of HTML by how they end and show.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article aside blockquote br dd div dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table tbody td th thead title tr ul".split())
HIDDEN = frozenset("script style template noscript".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "p": {"div", "section", "td", "li", "body"}, "option": {"select"}}


# Elements whose content is no markup to the parser, and how plain a tag must be to be known by its text.
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title plaintext".split())
TAG = re.compile(r"""<(?:[a-zA-Z][a-zA-Z0-9]*(?:\s+[a-zA-Z_:][\w:.-]*(?:=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'=<>`/]+))?)*\s*/?|/[a-zA-Z][a-zA-Z0-9]*\s*)>""", re.ASCII)
PIECES, SPACES, BLANKS = re.compile(r"(<[^<>]*>)"), re.compile(r"\s+"), re.compile(" +")


class OneTag(HTMLParser):
    """What the parser makes of one tag: its events."""

    def __init__(self, tag: str):
        super().__init__(convert_charrefs=True)
        self.events: list[tuple] = []
        self.feed(tag)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append(("start", tag, {k: v or "" for k, v in attrs}))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.events.append(("both", tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        self.events.append(("end", tag, {}))


@lru_cache(maxsize=1 << 14)
def one_tag(tag: str) -> tuple[str, str, dict[str, str]] | None:
    """kind, name and attributes of a tag, whose text is the same on many pages; none if what follows could matter."""
    if not TAG.fullmatch(tag):
        return None
    events = OneTag(tag).events
    return events[0] if len(events) == 1 and events[0][1] not in RAW else None


class Tree(HTMLParser):
    """tag, attrs, parent, and the range of text pieces of each element, in order of start tags; 0 is the root.

    A page of plain tags and text only is cut into these at once, and each different tag is parsed once; the first piece that
    could be anything else (comments, scripts, stray brackets, broken tags) leaves the page to the parser.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent, self.begin, self.end = ["#root"], [{}], [-1], [0], [0]
        self.pieces: list[str] = []
        self.open = [0]
        if not self._plain(html):
            self.feed(html)
            self.close()
        while self.open:
            self.end[self.open.pop()] = len(self.pieces)

    def _plain(self, html: str) -> bool:
        pieces = PIECES.split(html)
        texts, tags = pieces[::2], pieces[1::2]
        # Long tags are not kept.
        known = {tag: (one_tag if len(tag) <= 500 else one_tag.__wrapped__)(tag) for tag in set(tags)}
        if None in known.values() or "<" in "".join(texts):
            return False
        shown = {x: SPACES.sub(" ", unescape(x) if "&" in x else x) for x in set(texts)}
        names, open_, out = self.tag, self.open, self.pieces
        for text_, tag in zip_longest(texts, tags):
            if text_ and names[open_[-1]] not in HIDDEN:
                out.append(shown[text_])
            if tag:
                kind, name, attrs = known[tag]
                if kind == "end":
                    if names[open_[-1]] == name:
                        self.end[open_.pop()] = len(out)
                        if name in BLOCK:
                            out.append("\n")
                    else:
                        self.handle_endtag(name)
                else:
                    self._start(name, attrs)
                    if kind == "both" and name not in VOID:
                        self._shut()
        return True

    def _shut(self) -> None:
        k = self.open.pop()
        self.end[k] = len(self.pieces)
        if self.tag[k] in BLOCK:
            self.pieces.append("\n")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, {k: v or "" for k, v in attrs})

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in CLOSES and len(self.open) > 1:
            for k in reversed(range(1, len(self.open))):
                name = self.tag[self.open[k]]
                if name in SCOPES[tag]:
                    break
                if name in CLOSES[tag]:
                    while len(self.open) > k:
                        self._shut()
        if tag in BLOCK:
            self.pieces.append("\n")
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.parent.append(self.open[-1])
        self.begin.append(len(self.pieces))
        self.end.append(len(self.pieces))
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._shut()

    def handle_endtag(self, tag: str) -> None:
        if len(self.open) > 1 and self.tag[self.open[-1]] == tag:
            self._shut()
        elif any(self.tag[k] == tag for k in self.open[1:]):
            while self.tag[self.open[-1]] != tag:
                self._shut()
            self._shut()

    def handle_data(self, data: str) -> None:
        if self.tag[self.open[-1]] not in HIDDEN:
            self.pieces.append(SPACES.sub(" ", data))

    # What is asked of a tree.

    def all(self, test: Callable[[str, dict[str, str]], bool]) -> list[int]:
        return [k for k in range(1, len(self.tag)) if test(self.tag[k], self.attrs[k])]

    def lines(self, k: int) -> str:
        """What shows of an element: trimmed lines that are not empty."""
        shown = "".join(self.pieces[self.begin[k] : self.end[k]])
        return "\n".join(x for x in ((BLANKS.sub(" ", line) if "  " in line else line).strip() for line in shown.split("\n")) if x)

    def closest(self, k: int, *tags: str) -> int:
        """The nearest element of the first of these tags that has k in it; else the parent."""
        for tag in tags:
            up = k
            while up > 0:
                if self.tag[up] == tag:
                    return up
                up = self.parent[up]
        return self.parent[k]

    def within(self, k: int, top: int) -> bool:
        while k > top:
            k = self.parent[k]
        return k == top

    def has_class(self, k: int, names: frozenset[str]) -> bool:
        of = self.attrs[k].get("class")
        return bool(of) and not names.isdisjoint(of.split())


def per_page(pages: DataFrame, id_: str, html: str, read: Callable[[Tree], list[tuple]], schema: str) -> DataFrame:
    """id and the columns of schema, for each row that `read` makes of a page's tree."""
    names = [id_, *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *r) for k, page in zip(batch[id_], batch[html], strict=True) if page for r in read(Tree(page))]
            yield pd.DataFrame(rows, columns=names)

    kind = dict(pages.dtypes)[id_]
    return pages.select(id_, html).mapInPandas(run, f"{id_} {kind}, {schema}")


def mailbox_contexts(pages: DataFrame, id_: str, html: str = "html", longest: int = 300) -> DataFrame:
    """Id, email, context of each mailbox that is linked (or guarded by a code) on a page, the first link of each; `context`
    has the lines of the nearest table row, else list item, else division around it, up to `longest` characters."""

    def decoded(code: str) -> str:
        try:
            key, *rest = bytes.fromhex(code)
        except ValueError:
            return ""
        return bytes(b ^ key for b in rest).decode("latin-1")

    def read(tree: Tree) -> list[tuple]:
        found: dict[str, str] = {}
        guarded = [(k, decoded(tree.attrs[k]["data-cfemail"])) for k in tree.all(lambda _, a: bool(a.get("data-cfemail")))]
        linked = [(k, tree.attrs[k]["href"][7:].split("?")[0]) for k in tree.all(lambda t, a: t == "a" and a.get("href", "").startswith("mailto:"))]
        for k, address in linked + guarded:
            email = address.strip().lower()
            if email.find("@") > 0 and len(email) <= 60 and email not in found:
                found[email] = tree.lines(tree.closest(k, "tr", "li", "div"))[:longest]
        return list(found.items())

    return per_page(pages, id_, html, read, "email string, context string")


def mailbox_people(pages: DataFrame, id_: str, html: str = "html") -> DataFrame:
    """Id, email, name, title, from the lines around each linked mailbox."""
    who = text.context_person("context")
    return mailbox_contexts(pages, id_, html).where(text.clean_email("email").isNotNull()).select(id_, "email", who["name"].alias("name"), who["title"].alias("title"))


def card_rows(pages: DataFrame, id_: str, card: tuple[str, ...], headline: tuple[str, ...], html: str = "html", longest: int = 80) -> DataFrame:
    """Id, name, rating, reviews, price, category, place of each card of a page, the first of each name.

    Cards and headlines are elements with one of the classes given; a card within a card is part of the outer one. A name has 3
    to `longest` characters. The category is the first line (or part between middle dots) of 3 to 44 characters that is no
    name, number, bracket, price or star; the place is the first line with a state.
    """
    cards_, heads = frozenset(card), frozenset(headline)

    def read(tree: Tree) -> list[tuple]:
        rows: dict[str, str] = {}
        last = 0
        for k in range(1, len(tree.tag)):
            if not tree.has_class(k, cards_) or (last and tree.within(k, last)):
                continue
            last = k
            inner = takewhile(lambda j, k=k: tree.within(j, k), range(k + 1, len(tree.tag)))
            head = next((j for j in inner if tree.has_class(j, heads)), None)
            name = "" if head is None else tree.lines(head).replace("\n", " ")
            if 3 <= len(name) <= longest and name not in rows:
                rows[name] = tree.lines(k)
        return list(rows.items())

    found = per_page(pages, id_, html, read, "name string, text string")
    r = text.rating("text")
    lines = F.filter(F.transform(F.split("text", "[\n·]"), lambda x: F.trim(x)), lambda x: (x != F.col("name")) & F.length(x).between(3, 44))
    plain = F.filter(lines, lambda x: ~x.rlike(r"^[0-9(]|^\$+$") & ~F.contains(x, F.lit("star")) & ~x.rlike(STATE))
    place = F.filter(F.split("text", "\n"), lambda x: x.rlike(STATE) & F.length(x).between(3, 80) & (x != F.col("name")) & ~x.rlike(r"^[0-9]\.[0-9]|^\([0-9]|·"))
    first = lambda a: F.coalesce(F.try_element_at(a, F.lit(1)), F.lit(""))
    return found.select(id_, "name", r.rating.alias("rating"), r.reviews.alias("reviews"), r.price.alias("price"), first(plain).alias("category"), first(place).alias("place"))


# The states of an address.
STATE = r"\b(?=[A-Z]{2}\b)(AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY|DC)\b"


def directory_rows(pages: DataFrame, id_: str, own: str, html: str = "html", state: str = "MD") -> DataFrame:
    """Id, name, address, city, website, facebook, instagram of a directory's page of one venue; `own` is a part of the directory's own addresses.

    The name is the first h1's, else the first h2's. The address is a street with city, state and five digits; the city is its last
    part but one, else the capitalised words before the state. The website is where a link says to visit it, else the first
    link that leaves the directory and is no profile. Profiles of the directory itself are passed over.
    """

    def read(tree: Tree) -> list[tuple]:
        heads = [k for tag in ("h1", "h2") for k in tree.all(lambda t, _, tag=tag: t == tag)]
        shown = tree.lines(0)
        street = re.search(rf"(\d+[^,\n]+, *[A-Za-z ]+, *{state} *\d{{5}})", shown)
        address = street[1] if street else ""
        city = address.split(",")[-2].strip() if address else ""
        if not city and (near := re.search(rf"([A-Z][a-z]+(?: [A-Z][a-z]+)*),? *(?:{state})\b", shown)):
            city = near[1]
        website = facebook = instagram = ""
        named = False
        for k in tree.all(lambda t, a: t == "a" and "href" in a):
            href, label = tree.attrs[k]["href"], tree.lines(k).lower()
            low = href.lower()
            if not named and ("visit website" in label or "visit site" in label):
                website, named = href, True
            elif not website and low.startswith("http") and own not in low and "facebook" not in low and "instagram" not in low:
                website = href
            if "facebook.com" in low and own not in low:
                facebook = facebook or href
            if "instagram.com" in low and own not in low:
                instagram = instagram or href
        return [(tree.lines(heads[0]).replace("\n", " ") if heads else "", address, city, website, facebook, instagram)]

    return per_page(pages, id_, html, read, "name string, address string, city string, website string, facebook string, instagram string")


# What a place's page says of the place, by section heads and by words; and what of the page's own controls is no attribute.
SECTIONS = ("highlight", "popular", "amenit", "atmospher", "service option", "planning", "accessibility", "dining option", "offering", "payment")
GOOD_ATTRIBUTES = ("dine-in", "takeout", "delivery", "outdoor seating", "rooftop", "fireplace", "romantic", "live music", "live entertainment", "fine dining", "casual dining", "cozy", "upscale", "elegant", "trendy", "wine", "cocktail", "full bar", "beer", "patio", "terrace", "garden", "historic", "waterfront", "scenic", "intimate", "private dining", "private event", "banquet", "catering", "brunch", "lunch", "dinner", "breakfast", "late night", "valet", "reservation", "accepted", "required", "free parking", "street parking", "parking lot", "good for groups", "good for kids", "dog-friendly", "wi-fi", "comfort food", "farm-to-table", "organic", "vegetarian", "gluten-free", "prix fixe", "tasting menu", "wine list", "sommelier", "craft cocktails", "happy hour", "sunday brunch", "views", "courtyard", "lounge")
OWN_WORDS = ("review", "direction", "photo", "send to", "share", "save", "add a", "write", "claim", "overview", "about", "nearby restaurants", "nearby hotels", "hotels", "things to do", "bars", "coffee", "takeout", "groceries", "attractions", "more places", "explore", "plan", "suggest an edit", "own this business", "questions", "updates", "see more", "show less", "menu", "order online", "order now", "see photos", "all reviews", "sort", "newest", "open now", "closed", "hours might differ")
TYPE_LABEL, ROW_CLASSES = frozenset({"DkEaL"}), frozenset({"LTs0Rc", "iP2t7d", "wmQCje"})


def attribute_rows(pages: DataFrame, id_: str, html: str = "html") -> DataFrame:
    """Id, category, price, attributes of a place's page.

    Attributes come three ways, in order: innermost spans and labels in the nearest classed element round a section's head; rows
    of icons with a known word; labels with a known word. They are lower-cased, of 3 to 40 characters, distinct, and none of
    the page's own controls (whose words open them, or a digit, or a letter and a bracket).
    """

    def read(tree: Tree) -> list[tuple]:
        n, found = len(tree.tag), {}
        shown = lambda k: tree.lines(k).replace("\n", " ")
        inner = lambda k: takewhile(lambda j: tree.within(j, k), range(k + 1, n))
        label = lambda k: tree.attrs[k].get("aria-label", "")
        good = lambda x: any(w in x for w in GOOD_ATTRIBUTES)

        def add(x: str) -> None:
            x = x.strip().lower()
            if 3 <= len(x) <= 40 and not x.startswith(OWN_WORDS) and not re.match(r"\d|[a-z]\)", x):
                found.setdefault(x)

        kinds = [k for k in range(1, n) if tree.has_class(k, TYPE_LABEL)] or tree.all(lambda t, a: t == "button" and "category" in a.get("jsaction", ""))
        price = ""
        for k in tree.all(lambda t, a: t == "span" or "Price" in a.get("aria-label", "")):
            m = re.fullmatch(r"\${1,4}", shown(k)) or ("Price" in label(k) and re.search(r"\${1,4}", label(k)))
            if m:
                price = m[0]
                break
        for h in tree.all(lambda t, a: t in ("h2", "h3") or a.get("role") == "heading"):
            head = shown(h).lower()
            if any(s in head for s in SECTIONS):
                box = h
                while box > 0 and "class" not in tree.attrs[box]:
                    box = tree.parent[box]
                box = box or tree.parent[h]
                for k in inner(box):
                    if tree.tag[k] == "span" and not any(tree.tag[j] == "span" for j in inner(k)) and shown(k) != head:
                        add(shown(k))
                for k in inner(box):
                    add(label(k))
        for k in range(1, n):
            if tree.has_class(k, ROW_CLASSES) and 3 <= len(shown(k)) <= 40 and good(shown(k).lower()):
                add(shown(k))
        for k in range(1, n):
            if len(label(k)) < 60 and good(label(k).lower()):
                add(label(k))
        return [(shown(kinds[0]) if kinds else "", price, list(found))]

    return per_page(pages, id_, html, read, "category string, price string, attributes array<string>")
