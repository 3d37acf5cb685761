"""Keyword vocabularies folded to one regular expression each."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def pattern(words: Iterable[str]) -> str:
    return "|".join(re.escape(w).replace("\\ ", " ") for w in words)


def any_of(c: Column | str, words: Iterable[str]) -> Column:
    """Whether any of the words occurs in c as it stands: one match instead of one test a word."""
    return (F.col(c) if isinstance(c, str) else c).rlike(pattern(words))


def first_match(rules: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """An ordered rule table as one CASE WHEN."""
    out = None
    for test, label in rules:
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


# What the rules must know for right results, in natural order.
BOOST_NAMES = ("french", "bistro", "brasserie", "boucherie", "chaumiere", "auberge", "la ferme", "le chat", "le comptoir", "le refuge", "petit louis", "european", "portuguese", "italia", "trattoria", "ristorante", "osteria")
GOOD_NAMES = ("fine dining", "steakhouse", "prime", "chophouse", "grille", "tavern", "inn ", " inn", "manor", "estate")
JUNK_NAMES = ("ice cream", "gelato", "frozen", "toast", "bakery", "pastry", "slice", "cupcake", "smoothie", "juice", "bagel", "donut", "cafe", "coffee", "deli", "sandwich", "pizza", "taco", "burger", "pub", "irish", "beer garden", "sports bar", "hookah", "sweets", "candy", "dessert", "acai", "poke", "bubble tea", "chicken", "ramen", "noodle", "kebab", "gyro", "sushi", "clubhouse", "pool", "swim", "tennis", "golf", "recreation", "liquor", "wine shop", "wine store", "spirits")
FRENCH_NAMES = ("french", "bistro", "brasserie", "provenc", "lyon", "paris", "chez", "la ", "le ", "les ", "l'", "au ", "aux ", "du ", "des ", "trattoria", "osteria", "ristorante", "enoteca", "european", "mediterranean", "portuguese")
GOOD_TITLES = ("event", "manager", "director", "coordinator", "owner", "general manager", "marketing", "hospitality")
CITY_GARBAGE = ("and ", "prices", "best ", "top ", "finest", "genuine", "famous", "historic ", "restaurant", "review", "rating", "menu", "hours", "delivery", "near me", "open now", "reserv", "book a", "order", "http", "www.", ".com", "@", "phone", "email", "contact")
PAGE_KEYWORDS = ("private-event", "private_event", "private event", "events", "event", "wedding", "cater", "banquet", "group-dining", "group dining", "private-dining", "private dining", "meeting", "corporate", "sales", "book", "inquiry", "enquiry", "contact", "team", "staff", "people", "leadership", "about", "press", "media", "rental", "party", "celebration", "hospitality", "venue", "groups", "special-events", "special events")
ASSET_EXTENSIONS = ("css", "js", "png", "jpg", "jpeg", "gif", "svg", "ico", "webp", "woff", "woff2", "ttf", "eot", "map", "zip", "mp3", "mp4", "mov", "avi", "json", "xml", "txt")
TRACKING_KEYS = ("fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "ref", "source")
JUNK_MAIL = ("example.com", "yourdomain", "sentry.io", "wixpress.com", "mailchimp.com", "sendgrid.net", "googleapis.com", "gstatic.com", "schema.org", "w3.org")
REJECTED_MAIL = ("noreply@", "no-reply@", "mailer-daemon@", "postmaster@", "webmaster@")
GENERIC_MAIL = ("info@", "hello@", "contact@", "sales@", "reservations@", "booking@", "enquiries@", "inquiries@", "office@", "general@", "frontdesk@", "reception@", "support@", "admin@", "events@", "event@", "catering@", "privateevents@")
BLOCKED_DOMAINS = ("facebook.com", "instagram.com", "x.com", "twitter.com", "linkedin.com", "youtube.com", "tiktok.com", "yelp.com", "tripadvisor.com", "opentable.com", "resy.com", "zomato.com", "foursquare.com", "mapquest.com", "yellowpages.com", "bbb.org", "chamberofcommerce.com", "manta.com", "eventbrite.com", "meetup.com", "theknot.com", "weddingwire.com", "partyslate.com", "doordash.com", "grubhub.com", "ubereats.com", "seamless.com", "toasttab.com", "booking.com", "expedia.com", "hotels.com", "travelocity.com", "kayak.com", "priceline.com", "airbnb.com", "vrbo.com", "google.com", "wikipedia.org", "patch.com", "visitmaryland.org", "dcpreservation.org", "washington.org")
STOP_WORDS = ("the", "a", "an", "and", "of", "at", "in", "by", "on", "for", "to", "from", "with", "hotel", "hotels", "inn", "resort", "lodge", "restaurant", "restaurants", "winery", "vineyard", "vineyards", "club", "country", "golf", "bar", "bistro", "cafe", "tavern", "grill", "grille", "pub", "lounge", "spa", "marina", "museum", "gallery", "event", "events", "venue", "venues", "fine", "dining", "kitchen", "house", "company", "co")
SMALL_WORDS = ("the", "a", "an", "and", "of", "at", "in", "by", "on", "for", "to")
PLACE_WORDS = ("washington", "maryland", "virginia", "baltimore", "annapolis", "bethesda", "alexandria", "georgetown", "leesburg", "middleburg", "easton", "wilmington", "potomac", "mclean", "fairfax", "arlington", "reston")
TYPE_WORDS = ("hotel", "inn", "resort", "lodge", "restaurant", "winery", "vineyard", "club", "golf", "bar", "bistro", "spa", "marina", "museum", "gallery", "estate", "manor", "chateau", "tavern", "grill", "grille")
PARENT_DOMAINS = ("marriott.com", "hilton.com", "hyatt.com", "ihg.com", "fourseasons.com", "rosewoodhotels.com", "mandarinoriental.com", "fairmont.com", "accor.com", "omnihotels.com", "loewshotels.com", "kimptonhotels.com", "ritzcarlton.com", "preferredhotels.com", "leadinghotels.com")
HOTEL_BRANDS = ("waldorf", "conrad", "sofitel", "pendry", "salamander", "ritz-carlton", "four seasons", "fairmont", "mandarin", "st. regis", "westin", "hyatt", "marriott", "hilton", "intercontinental", "kimpton", "rosewood", "peninsula", "langham", "omni", "loews")
FB_RESERVED = ("tr", "pixel", "plugins", "sharer", "share", "login", "dialog", "policy.php", "policy", "terms", "terms.php", "about", "legal", "cookies", "r.php", "recover", "help", "privacy", "settings", "ads", "business", "watch", "marketplace", "events", "wix", "wixstudio", "squarespace", "wordpress", "shopify", "godaddy", "weebly", "webflow", "carrd", "linktree", "linktr")
IG_RESERVED = ("p", "reel", "reels", "explore", "stories", "accounts", "developer", "about", "legal", "privacy", "terms", "share", "embed", "direct", "tv", "wix", "wixstudio", "squarespace", "wordpress", "shopify", "godaddy", "weebly", "webflow", "carrd", "linktree", "linktr")
FIT_STOP_WORDS = ("the", "and", "bar", "inn", "club", "farm", "restaurant", "grille", "grill", "lounge", "bistro", "cafe", "hotel", "wine", "winery", "vineyard", "country", "yacht", "art", "gallery", "museum", "event", "private", "inc", "llc", "little", "italy", "old", "new", "great", "big", "east", "west", "north", "south", "port", "washington", "virginia", "maryland", "delaware", "pennsylvania")
GROUP_DOMAINS = ("aramark", "marriott", "hilton", "hyatt", "guestservices", "compass", "sodexo", "macsthospitality", "rwrestaurantgroup", "titanhosp", "clydescorp")
ORG_STOP_WORDS = ("the", "a", "an", "and", "of", "at", "in", "by", "hotel", "collection")
ORG_KINDS = ("bar", "grill", "bistro", "cafe", "restaurant", "kitchen", "tavern", "pub", "lounge", "house", "club", "wine", "brewing", "inn", "suites", "resort", "lodge", "manor", "estate")
CHAIN_ORGS = ("intercontinental", "ihg", "hilton worldwide", "marriott international", "hyatt hotels", "wyndham", "accor", "choice hotels", "best western", "radisson", "aimbridge hospitality", "highgate hotels")
LUXURY_WORDS = ("luxury", "five star", "5-star", "ritz-carlton", "four seasons", "rosewood", "st. regis", "waldorf", "fairmont", "pendry", "salamander", "mandarin")
FINE_WORDS = ("fine dining", "michelin", "tasting menu", "french", "brasserie", "ristorante", "steakhouse", "chophouse")
BAD_TITLES = ("housekeep", "security", "loss prevention", "accounting", "accountant", "finance", "payroll", "laundry", "steward", "engineer", "maintenance", "it ", "information technology", "purchasing", "procurement", "human resource", " hr ", "recruiter", "recruitment", "talent acquisition", "spa ", "spa manager", "spa director", "esthetician", "massage")
DECISION_WORDS = ("owner", "founder", "president", "partner", "director", "manager", "general manager", "gm", "ceo", "coo", "events", "entertainment", "booking", "operations", "chef", "proprietor", "managing", "beverage")
HARD_REJECT_MAIL = ("noreply@", "no-reply@", "webmaster@", "billing@", "dataremoval@", "privacy@", "careers@", "jobs@", "hr@", "mailer-daemon@", "postmaster@")
ROLE_LOCALS = ("info", "manager", "admin", "office", "contact", "sales", "events", "event", "privateevents", "private-events", "hello", "support", "reservations", "booking", "bookings", "frontdesk", "catering", "groups", "weddings", "meetings", "eat", "dine", "host", "general", "mail")
ROLE_NAMES = ("manager", "admin", "owner", "chef", "host", "staff", "catering", "events", "private events", "general", "front desk", "reception")
LOW_TITLES = ("server", "waiter", "waitress", "hostess", "host", "busser", "bartender", "dishwasher", "line cook", "prep cook", "barback")
JUNK_WEBSITES = ("facebook.com", "instagram.com", "yelp.com", "tripadvisor.com", "google.com", "wikipedia.org", "twitter.com", "youtube.com", "linkedin.com", "zoominfo.com", "wix.com", "squarespace.com", "fandom.com", "res-menu.net")
SLUG_STOP_WORDS = ("the", "and", "bar", "inn", "club")
REPORT_FREE_MAIL = ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "aol.com")
SAFE_CATEGORIES = ("hotel", "country_club", "private_club", "yacht_club", "wine_bar", "winery")
FREE_MAIL = ("gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "aol.com", "icloud.com")
ROOM_NAMES = ("cottage", "apartment", "vacation rental", "retreat", "bedroom", "airbnb", "vrbo", "walk to", "screened porch", "historic house", "king room", "queen room", "deluxe room", "suite -", "one-bedroom", "ice cream", "gelato", "frozen yogurt", "toastique", "sweets", "clubhouse and pool", "clubhouse & pool", " pub", "irish pub", "liquor", "wine & spirits", "wine and spirits", "spirits", " cafe", "cafe ", "bakery", "pastry", "patisserie", "slice", "cupcake", "donut", "bagel", "smoothie", "juice bar", "acai", "poke bowl", "bubble tea", "boba")
SWEET_CITIES = ("washington", "georgetown", "dupont", "alexandria", "mclean", "great falls", "bethesda", "chevy chase", "potomac", "annapolis", "easton", "st. michaels", "st michaels", "charlottesville", "middleburg", "leesburg", "wilmington", "greenville")
