"""What the named queries must return, as SQL for DuckDB over the same tables, written apart from the operators."""

from __future__ import annotations

from ..functions import vocab
from ..sources.projection import sql


def typed(*more: str) -> str:
    """The projections, with venues and contacts typed as `v` and `c`, past gigs as `g`."""
    return sql("venues", "contacts", "outreach", "gigs").rstrip() + """,
v AS (SELECT * REPLACE (CASE WHEN zone_priority = '' THEN 'default' ELSE zone_priority END AS zone_priority),
  coalesce(nullif(try_cast(trim(raw_upscale) AS double), 0), 3) AS upscale FROM venues),
c AS (SELECT * REPLACE (CASE WHEN lower(email_sent) IN ('true', 'skipped') THEN lower(email_sent) ELSE 'false' END AS email_sent) FROM contacts),
g AS (SELECT *, floor((coalesce(nullif(rating_tips, 0), 5) + coalesce(nullif(rating_rebooked, 0), 5) + coalesce(nullif(rating_audience, 0), 5) + coalesce(nullif(rating_venue_quality, 0), 5)) / 4.0 * 10 + 0.5) / 10 AS overall FROM gigs)""" + "".join(f",\n{m}" for m in more) + "\n"


def likes(column: str, words: tuple[str, ...]) -> str:
    """Whether one of the words occurs in the column."""
    return "(" + " OR ".join("contains({}, '{}')".format(column, w.replace("'", "''")) for w in words) + ")"


def names(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


FLAGS = """f AS (SELECT venue_id, bool_or(channel IN ('contact_form', 'contact_form_skip')) AS contact_form_sent, bool_or(channel IN ('instagram', 'instagram_skip')) AS ig_dm_sent,
 bool_or(channel IN ('facebook', 'facebook_skip')) AS fb_msg_sent FROM outreach GROUP BY venue_id)"""
COUNTS = """k AS (SELECT venue_id, count(*) AS n_contacts, count(*) FILTER (WHERE verified IN ('valid', 'catch-all', 'unknown') AND email_sent = 'false') AS n_sendable, bool_or(verified = 'valid') AS has_valid FROM c GROUP BY venue_id)"""
PLAYED = """p AS (SELECT * FROM v WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.venue_id = v.venue_id)
 AND NOT EXISTS (SELECT 1 FROM g WHERE contains(lower(trim(v.name)), lower(trim(g.venue_name))) OR contains(lower(trim(g.venue_name)), lower(trim(v.name)))))"""
ACTION = """a AS (SELECT p.*, coalesce(n_sendable, 0) AS n_sendable, length(instagram) > 5 AND NOT coalesce(ig_dm_sent, false) AS ig_pending, length(facebook) > 5 AND NOT coalesce(fb_msg_sent, false) AS fb_pending
 FROM p LEFT JOIN f USING (venue_id) LEFT JOIN k USING (venue_id) WHERE status NOT IN ('contacted', 'untouched', 'needs_review'))"""
NEEDED = "SELECT * FROM a WHERE n_sendable > 0 OR ig_pending OR fb_pending"
RECOMMENDED = f"""cats AS (SELECT lower(category) AS cat, avg(overall) AS cat_avg FROM g GROUP BY 1),
prof AS (SELECT avg(overall) AS avg_overall, avg(coalesce(nullif(rating_venue_quality, 0), 3)) AS avg_upscale FROM g),
q AS (SELECT venue_id, count(*) AS n_contacts, 3 + max(CASE WHEN verified = 'valid' THEN 4 ELSE 0 END) + max(CASE WHEN {likes("lower(title)", vocab.GOOD_TITLES)} THEN 3 ELSE 0 END) AS contact_pts FROM c GROUP BY venue_id),
r AS (SELECT p.venue_id, p._ord,
 CAST(CASE WHEN cat_avg IS NOT NULL THEN floor(cat_avg / 10 * 40 + 0.5) ELSE floor(avg_overall / 10 * 20 + 0.5) END AS bigint) AS category_pts,
 CAST(floor(greatest(0, 30 * (1 - abs(upscale - avg_upscale) / 5)) + 0.5) AS bigint) AS upscale_pts,
 CAST(CASE zone_priority WHEN 'green' THEN 10 WHEN 'yellow' THEN 5 ELSE 0 END AS bigint) AS zone_pts,
 CAST(CASE WHEN distance_miles IS NULL THEN 10 WHEN distance_miles <= 30 THEN 25 WHEN distance_miles <= 60 THEN 20 WHEN distance_miles <= 90 THEN 15 WHEN distance_miles <= 120 THEN 10
  ELSE floor(greatest(0, 5 * (1 - (distance_miles - 120) / 30)) + 0.5) END AS bigint) AS distance_pts,
 CAST(coalesce(contact_pts, 0) AS bigint) AS contact_pts, CAST(CASE WHEN venue_vote = 'up' THEN 20 ELSE 0 END AS bigint) AS vote_pts,
 CAST(CASE lower(category) WHEN 'winery' THEN 20 WHEN 'wine bar' THEN 20 WHEN 'hotel' THEN 10 WHEN 'restaurant' THEN 10 WHEN 'gym' THEN -20 WHEN 'spa' THEN -20 ELSE 0 END AS bigint) AS taste_pts,
 CAST(CASE WHEN lower(trim(city)) IN ('annapolis', 'easton', 'mclean') THEN 15 ELSE 0 END AS bigint) AS location_pts,
 CAST(CASE WHEN upper(state) IN ('DC', 'MD', 'VA') THEN 20 ELSE 0 END AS bigint) AS state_pts, coalesce(n_contacts, 0) AS n_contacts
 FROM p CROSS JOIN prof LEFT JOIN cats ON cat = lower(category) LEFT JOIN q USING (venue_id)
 WHERE status <> 'needs_review' AND venue_vote <> 'down' AND (distance_miles IS NULL OR distance_miles <= 150) AND NOT {likes("lower(name)", ("market", "theater"))}),
s AS (SELECT *, greatest(0, least(100, category_pts + upscale_pts + zone_pts + distance_pts + contact_pts + vote_pts + taste_pts + location_pts + state_pts)) AS score FROM r)"""
DOMAIN = "split_part(replace(replace(replace(lower(website), 'https://', ''), 'http://', ''), 'www.', ''), '/', 1)"
BASE = f"split_part({DOMAIN}, '.', 1)"
FLAT_NAME, FLAT_BASE = "regexp_replace(lower(name), '[^a-z0-9]', '', 'g')", f"regexp_replace({BASE}, '[^a-z0-9]', '', 'g')"
FITS = f"""({DOMAIN} = '' OR length({BASE}) < 3 OR contains({FLAT_NAME}, {FLAT_BASE}) OR contains({FLAT_BASE}, {FLAT_NAME})
 OR len(list_filter(regexp_extract_all(lower(name), '[a-z]{{3,}}'), lambda w: w NOT IN {names(vocab.FIT_STOP_WORDS)} AND contains({FLAT_BASE}, w))) > 0
 OR len(list_filter(regexp_extract_all({BASE}, '[a-z]{{3,}}'), lambda w: w NOT IN ('com', 'org', 'net', 'www', 'the') AND contains({FLAT_NAME}, w))) > 0 OR {likes(FLAT_BASE, vocab.GROUP_DOMAINS)})"""
BAD_CITY = f"(trim(city) = '' OR {likes('lower(trim(city))', vocab.CITY_GARBAGE)} OR length(trim(city)) > 30 OR regexp_matches(trim(city), '[0-9]{{3,}}') OR regexp_matches(trim(city), '[\"'']'))"
FUNNEL = f"""few AS (SELECT * FROM c WHERE verified = 'do_not_mail' AND email_sent = 'skipped'),
d AS (SELECT *, {DOMAIN} AS domain FROM v),
e AS (SELECT *, CASE WHEN status <> 'untouched' THEN 'status' WHEN EXISTS (SELECT 1 FROM g WHERE lower(trim(g.venue_name)) = lower(trim(d.name))) THEN 'past_gig'
 WHEN venue_id IN (SELECT venue_id FROM outreach WHERE sent_at IS NULL AND channel = 'contact_form') THEN 'in_report' WHEN venue_id IN (SELECT venue_id FROM few) THEN 'has_contacts' WHEN website = '' THEN 'no_site'
 WHEN {likes("domain", ("facebook.com", "instagram.com", "yelp.com"))} OR regexp_matches(domain, '\\.(edu|gov|mil)$') THEN 'junk_site'
 WHEN length(domain) > 3 AND domain IN (SELECT domain FROM d WHERE status IN ('pipelined', 'contacted')) THEN 'already_reported' ELSE '' END AS early FROM d),
h AS (SELECT *, row_number() OVER (PARTITION BY split_part(domain, '.', 1), early = '' ORDER BY _ord) AS claim FROM e),
w AS (SELECT *, CASE WHEN early <> '' THEN early WHEN claim > 1 THEN 'duplicate_site' WHEN state NOT IN ('', 'DC', 'MD', 'VA', 'PA', 'DE', 'WV') THEN 'state'
 WHEN trim(city) = '' OR state = '' THEN 'blank_city' WHEN {BAD_CITY} THEN 'malformed_city'
 WHEN lower(trim(city)) NOT IN ('annapolis', 'baltimore', 'reston', 'easton', 'mclean', 'leesburg', 'alexandria', 'bethesda') AND (length(city) > 25 OR lower(trim(city)) = lower(name)
  OR len(list_filter(string_split_regex(lower(name), '\\s+'), lambda x: length(x) > 3 AND x NOT IN ('club', 'farm') AND contains(lower(trim(city)), x))) > 0) THEN 'blank_city'
 WHEN lower(trim(city)) = 'leesburg' THEN 'too_far'
 WHEN replace(lower(category), ' ', '_') NOT IN ('restaurant', 'winery', 'hotel', 'museum', 'wine_bar', 'event_venue', 'art_gallery', 'private_club', 'country_club') THEN 'category'
 WHEN {likes("lower(name)", ("church", "library", "market"))} THEN 'junk_name' WHEN {likes("lower(name)", ("spanish gate",))} THEN 'chain' WHEN NOT {FITS} THEN 'website_mismatch' END AS reason FROM h)"""
URL_PARTS = r"""u AS (SELECT page_id, url, html, trim(replace(replace(url, '&amp;', '&'), '&quot;', '"')) AS x FROM pages),
n AS (SELECT page_id, url, html, lower(regexp_extract(x, '^((?i)https?://[^/?#]+)', 1)) AS base, regexp_replace(regexp_extract(x, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
 array_to_string(list_filter(string_split(regexp_extract(x, '^[^?#]*\?([^#]*)', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(utm_[^=]*|fbclid|gclid|msclkid|mc_cid|mc_eid|ref|source)(=|$)')), '&') AS query,
 regexp_extract(x, '#(.+)$', 1) AS fragment FROM u),
m AS (SELECT page_id, url, html, base || CASE path WHEN '' THEN '/' ELSE path END || CASE query WHEN '' THEN '' ELSE '?' || query END AS plain, fragment FROM n)"""
REQUESTS = """q AS (SELECT CAST(user_id % 8 AS varchar) AS account, event_id AS seq, ts, 'u' || (event_id % 700) || '@example.org' AS email, 'run' || (event_id // 500) AS run_id,
 CASE event_id % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'invalid' WHEN 2 THEN 'timeout' ELSE 'catch-all' END AS outcome, event_id % 9 = 0 AS retry_unknown FROM events)"""
N, C = "(' ' || lower(name) || ' ')", "lower(category)"


def canonical() -> str:
    hotel = (" hotel ", " inn ", " resort ", " lodge ", *vocab.HOTEL_BRANDS)
    clubs = ("country club", "golf club", "golf & country", "golf and country", "hunt club", "field club")
    rules = [
        (likes(N, clubs), "country_club"),
        (likes(N, (" city club", " town club", "cosmos club", "university club", "army navy club", "metropolitan club", "social club")), "private_club"),
        (likes(N, ("yacht club", " yacht ")), "yacht_club"),
        (f"regexp_matches({N}, '\\bwine\\s*bar\\b')", "wine_bar"),
        (likes(N, hotel), "hotel"),
        (likes(C, ("country club", "golf club")), "country_club"),
        (likes(C, ("private club", "social club", "civic club", "fraternal")), "private_club"),
        (likes(C, ("yacht", "sailing")), "yacht_club"),
        (likes(C, ("wine bar",)), "wine_bar"),
        (likes(C, ("hotel", "inn", "resort", "lodge")), "hotel"),
        (likes(C, ("winery", "vineyard")), "winery"),
        (likes(C, ("restaurant", "fine dining", "steakhouse", "brasserie", "bistro")), "restaurant"),
        (likes(C, ("brewery", "brewpub")), "brewery"),
        (likes(C, ("art gallery",)), "art_gallery"),
        (likes(C, ("museum", "gallery")), "museum"),
        (likes(C, ("event", "banquet", "wedding", "party", "catering")), "event"),
        (likes(C, ("spa",)) + " AND NOT " + likes(C, ("spanish",)), "spa"),
        (likes(C, ("gym", "pool", "tennis", "marina")), "recreation"),
        (likes(C, ("theater", "cinema")), "theater"),
        (f"regexp_matches({N}, '\\b(winery|wineries|vineyards?)\\b')", "winery"),
        (f"regexp_matches({N}, '\\b(brewery|breweries|brewing)\\b')", "brewery"),
        (f"regexp_matches({N}, '\\b(gallery|galleries)\\b')", "art_gallery"),
        (f"regexp_matches({N}, '\\bmuseum\\b')", "museum"),
        (f"regexp_matches({N}, '\\b(theater|theatre|cinema)\\b')", "theater"),
        (likes(f"replace({N}, 'falls church', ' ')", (" church ", " cathedral ")), "church"),
        (f"regexp_matches({N}, '\\blibrary\\b')", "library"),
        (f"regexp_matches({N}, '\\bspa\\b') AND NOT contains({N}, 'spanish')", "spa"),
        (likes(N, (" restaurant ", " bistro ", " steakhouse ")), "restaurant"),
    ]
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in rules) + " ELSE 'other' END"


#: The ledgers folded a request at a time: what is known of a mailbox, counts by run and by day, open reservations.
LEDGER = """q AS (SELECT CAST(user_id AS varchar) AS account, event_id AS seq, ts, epoch_us(ts) / 1000000.0 AS now, CAST(floor(epoch_us(ts) / 86400000000) AS bigint) AS today,
  CASE WHEN event_id % 29 = 0 THEN 'nobody' ELSE 'u' || (event_id % 7) || '@example.org' END AS email, 'run' || (day(ts) // 5) AS run_id, ['valid', 'invalid', 'timeout', 'catch-all', 'open'][event_id % 5 + 1] AS outcome,
  event_id % 9 = 0 AS again, event_id % 31 <> 0 AS enabled, event_id % 37 <> 0 AS has_key, CASE WHEN event_id % 13 <> 0 THEN floor(value * 20) END AS balance, event_id % 2 AS venue, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
f AS (SELECT account, CAST(0 AS bigint) AS k, CAST(NULL AS bigint) AS seq, CAST(NULL AS timestamp) AS ts, '' AS email, '' AS run_id, '' AS reason, '' AS status,
  CAST(map {} AS map(varchar, struct(s varchar, t double))) AS cache, CAST(map {} AS map(varchar, bigint)) AS runs, CAST(map {} AS map(varchar, bigint)) AS venues, CAST(map {} AS map(bigint, bigint)) AS days, CAST([] AS struct(e varchar, t double, r varchar)[]) AS held FROM (SELECT DISTINCT account FROM q)
 UNION ALL SELECT account, k, seq, ts, email, run_id, reason, CASE WHEN reason = 'cached' THEN known.s WHEN reason = 'charged' THEN outcome ELSE 'deferred' END,
  CASE WHEN reason IN ('charged', 'call_failed') THEN map_concat(cache, map {email: {'s': CASE WHEN outcome = 'timeout' THEN 'unknown' ELSE outcome END, 't': now}}) ELSE cache END,
  CASE WHEN reason IN ('charged', 'call_failed') THEN map_concat(runs, map {run_id: used + 1}) ELSE runs END, CASE WHEN reason IN ('charged', 'call_failed') THEN map_concat(venues, map {run_id || venue: there + 1}) ELSE venues END,
  CASE WHEN reason IN ('charged', 'call_failed') THEN map_concat(days, map {today: spent + 1}) ELSE days END,
  CASE WHEN reason = 'reserved' THEN list_append(held, {'e': email, 't': now, 'r': run_id}) ELSE held END
 FROM (SELECT *, CASE WHEN there >= 2 THEN 'venue_cap_reached' WHEN NOT contains(email, '@') THEN 'invalid_email_input'
   WHEN known IS NOT NULL AND now - known.t <= CASE known.s WHEN 'unknown' THEN 3 ELSE 10 END * 86400 AND NOT (known.s = 'unknown' AND again) THEN 'cached'
   WHEN NOT enabled THEN 'disabled' WHEN NOT has_key THEN 'no_api_key' WHEN used + len(list_filter(held, lambda h: h.r = run_id)) >= 3 THEN 'run_budget_reached' WHEN spent + len(held) >= 2 THEN 'day_budget_reached'
   WHEN len(list_filter(held, lambda h: h.e = email)) > 0 THEN 'already_inflight' WHEN balance IS NULL THEN 'credit_check_failed' WHEN balance <= 100 THEN 'reserve_reached'
   WHEN outcome = 'open' THEN 'reserved' WHEN outcome = 'timeout' THEN 'call_failed' ELSE 'charged' END AS reason
  FROM (SELECT q.*, f.cache, f.runs, f.venues, f.days, coalesce(map_extract(f.venues, q.run_id || q.venue)[1], 0) AS there, list_filter(f.held, lambda h: q.now - h.t <= 86400) AS held, map_extract(f.cache, q.email)[1] AS known, coalesce(map_extract(f.runs, q.run_id)[1], 0) AS used, coalesce(map_extract(f.days, q.today)[1], 0) AS spent
   FROM f JOIN q ON q.account = f.account AND q.k = f.k + 1)))"""

ORACLE_SQL: dict[str, str] = {
    "breakdown_by_state": typed() + "SELECT CASE state WHEN '' THEN 'Unknown' ELSE state END AS state, count(*) AS total, count(*) FILTER (WHERE status = 'contacted') AS contacted, count(*) FILTER (WHERE status <> 'contacted') AS pending FROM v GROUP BY 1",
    "breakdown_by_category": typed() + "SELECT CASE category WHEN '' THEN 'other' ELSE category END AS category, count(*) AS total, count(*) FILTER (WHERE status = 'contacted') AS contacted, count(*) FILTER (WHERE status <> 'contacted') AS pending FROM v GROUP BY 1",
    "dashboard_stats": typed(FLAGS) + """SELECT *, emails_sent + ig_dms_sent + fb_msgs_sent AS total_outreach FROM
 (SELECT count(*) AS total_contacts, count(*) FILTER (WHERE email_sent <> 'false') AS emails_sent, count(*) FILTER (WHERE verified = 'valid' AND email_sent = 'false') AS pending_emails, count(*) FILTER (WHERE verified = 'pending') AS pending_verify FROM c),
 (SELECT count(*) AS total_venues, count(*) FILTER (WHERE ig_dm_sent) AS ig_dms_sent, count(*) FILTER (WHERE fb_msg_sent) AS fb_msgs_sent FROM v LEFT JOIN f USING (venue_id))""",
    "outreach_by_channel": typed() + "SELECT CASE channel WHEN '' THEN 'unknown' ELSE channel END AS channel, count(*) AS n FROM outreach GROUP BY 1",
    "outreach_by_day": typed() + "SELECT strftime(sent_at, '%Y-%m-%d') AS day, count(*) AS n FROM outreach WHERE sent_at IS NOT NULL GROUP BY 1",
    "outreach_week_to_date": typed() + """SELECT CASE channel WHEN 'instagram' THEN 'ig' WHEN 'facebook' THEN 'fb' ELSE 'email' END AS kind, count(*) AS weekly, count(*) FILTER (WHERE sent_at >= timestamp '2024-01-24') AS daily
 FROM outreach WHERE sent_at >= timestamp '2024-01-22' AND channel IN ('email', 'contact_form', 'instagram', 'facebook') GROUP BY 1""",
    "sent_flags": typed(FLAGS) + "SELECT * FROM f",
    "recent_outreach": typed() + "SELECT venue_id, channel, _ord FROM (SELECT * FROM outreach ORDER BY _ord DESC LIMIT 20) WHERE sent_at IS NOT NULL",
    "venue_contacts_summary": typed(COUNTS) + "SELECT venue_id, coalesce(n_contacts, 0) AS n_contacts, coalesce(n_sendable, 0) AS n_sendable, coalesce(has_valid, false) AS has_valid FROM v LEFT JOIN k USING (venue_id)",
    "venue_detail": typed() + "SELECT v.venue_id, v.name AS venue, c.contact_id, c.email, c.verified, c.email_sent FROM v LEFT JOIN c USING (venue_id) WHERE v.venue_id = 'V-7'",
    "venue_filter_params": typed() + "SELECT venue_id, name, city, state FROM v WHERE upper(state) = 'MD' AND contains(lower(city), 'es') AND status = 'untouched'",
    "venue_coercions": typed() + "SELECT venue_id, upscale, nullif(try_cast(raw_upscale AS double), 0) AS upscale_or_null, CAST(floor(distance_miles - 60 + 0.5) AS bigint) AS rounded FROM v",
    "action_needed": typed(FLAGS, COUNTS, PLAYED, ACTION) + f"SELECT venue_id, n_sendable, ig_pending, fb_pending FROM ({NEEDED})",
    "top_picks": typed(FLAGS, COUNTS, PLAYED, ACTION, f"x AS ({NEEDED})", f"""y AS (SELECT *, CASE WHEN {likes("lower(name)", vocab.JUNK_NAMES)} OR venue_vote = 'down' THEN 99
 WHEN lower(category) = 'restaurant' THEN CASE WHEN upscale >= 4 AND {likes("lower(name)", vocab.BOOST_NAMES)} THEN 1 WHEN upscale >= 4 AND {likes("lower(name)", vocab.GOOD_NAMES)} THEN 5 ELSE 99 END
 WHEN lower(category) = 'country_club' THEN 3 WHEN lower(category) = 'hotel' THEN CASE WHEN upscale >= 4 THEN 3 ELSE 99 END WHEN lower(category) = 'winery' THEN CASE WHEN upscale >= 4 THEN 5 ELSE 99 END
 WHEN lower(category) = 'museum' THEN 5 ELSE 99 END AS base FROM x)""", "z AS (SELECT *, CASE WHEN venue_vote = 'up' AND base > 1 THEN greatest(1, base - 2) ELSE base END AS taste_rank FROM y)")
    + """SELECT venue_id, taste_rank, round(CASE WHEN taste_rank >= 99 THEN 0 ELSE greatest(0, (8 - taste_rank) / 7 * 100) END + greatest(0, 100 - coalesce(nullif(distance_miles, 0), 50)) + CASE WHEN upper(state) IN ('DC', 'MD', 'VA') THEN 50 ELSE 0 END, 6) AS score
 FROM z ORDER BY score DESC, _ord LIMIT 10""",
    "gig_profile": typed() + """SELECT count(*) AS n_gigs, round(avg(overall), 6) AS avg_overall, list_sort(list(distance_miles) FILTER (distance_miles IS NOT NULL))[count(distance_miles) // 2 + 1] AS median_distance,
 greatest((max(distance_miles) - min(distance_miles)) / 2, 15) AS spread, round(avg(coalesce(nullif(rating_venue_quality, 0), 3)), 6) AS avg_upscale,
 (SELECT category FROM g GROUP BY category ORDER BY avg(overall) DESC, min(_ord) LIMIT 1) AS best_category FROM g""",
    "gig_category_scores": typed() + "SELECT lower(category) AS category, round(avg(overall), 6) AS cat_avg, count(*) AS cat_gigs FROM g GROUP BY 1",
    "recommendations": typed(PLAYED, RECOMMENDED) + "SELECT * EXCLUDE (_ord) FROM s",
    "recommendations_top": typed(PLAYED, RECOMMENDED) + "SELECT venue_id, score FROM s ORDER BY score DESC, _ord LIMIT 25",
    "taste_report": typed(PLAYED, RECOMMENDED) + "SELECT count(*) FILTER (WHERE taste_pts >= 15) AS tier1, count(*) FILTER (WHERE taste_pts BETWEEN 5 AND 14) AS tier2, count(*) FILTER (WHERE taste_pts BETWEEN -9 AND 4) AS tier3, count(*) FILTER (WHERE taste_pts <= -10) AS tier4, count(*) FILTER (WHERE location_pts > 0) AS location_matches FROM s",
    "actionability": typed() + f"""SELECT venue_id, CASE WHEN lower(category) = 'country_club' THEN 35 WHEN lower(category) IN ('hotel', 'restaurant', 'winery', 'museum') THEN 15 ELSE 0 END + 8 * floor(upscale)
 + CASE WHEN {likes("lower(city)", vocab.SWEET_CITIES)} THEN 10 ELSE 0 END + CASE WHEN state = 'DC' THEN 10 ELSE 0 END + 3 * (length(instagram) > 5)::int + 2 * (length(website) > 5)::int + (state <> '')::int + (city <> '')::int AS score FROM v""",
    "backfill_candidates": typed() + f"""SELECT venue_id, name FROM v WHERE status IN ('untouched', 'needs_review') AND website = '' AND state <> '' AND category <> '' AND NOT {BAD_CITY} ORDER BY upscale DESC, lower(name), _ord LIMIT 100""",
    "candidate_prescore": """WITH t AS (SELECT p_partkey, p_size / 10 AS stars, floor(p_retailprice) AS reviews, p_partkey % 5 AS price, p_partkey % 6 AS cat, p_partkey % 3 <> 1 AS near, p_partkey % 7 = 0 AS sweet FROM part)
SELECT p_partkey, greatest(0, least(100, CASE cat WHEN 0 THEN 20 WHEN 1 THEN 30 WHEN 2 THEN 20 WHEN 3 THEN 10 WHEN 4 THEN -60 ELSE 30 END + CASE WHEN near THEN 10 ELSE -50 END + CASE WHEN sweet THEN 10 ELSE 0 END
 + CASE WHEN stars >= 4.7 THEN 20 WHEN stars >= 4.4 THEN 15 WHEN stars >= 4.0 THEN 10 WHEN stars >= 3.5 THEN 5 ELSE 0 END + CASE WHEN reviews > 1000 THEN 5 WHEN reviews > 500 THEN 3 ELSE 0 END
 + CASE price WHEN 4 THEN 15 WHEN 3 THEN 10 WHEN 1 THEN -5 ELSE 0 END)) AS score,
 greatest(CASE WHEN cat = 5 THEN 4 ELSE 0 END, CASE price WHEN 4 THEN 5 WHEN 3 THEN 4 WHEN 2 THEN 3 WHEN 1 THEN 2 ELSE CASE WHEN stars >= 4.7 THEN 4 WHEN stars >= 4.4 THEN 3 WHEN stars > 0 THEN 2 ELSE 3 END END) AS upscale FROM t""",
    "batch_funnel": typed(FUNNEL) + "SELECT venue_id, reason FROM w",
    "skip_reason_histogram": typed(FUNNEL) + "SELECT coalesce(reason, 'selected') AS reason, count(*) AS n FROM w GROUP BY 1",
    "batch_pool": typed(FUNNEL) + f"""SELECT venue_id, confidence, round(confidence * upscale, 6) AS composite, CASE state WHEN 'DC' THEN 0 WHEN 'VA' THEN 1 WHEN 'MD' THEN 2 WHEN 'DE' THEN 3 WHEN 'WV' THEN 4 WHEN 'PA' THEN 5 ELSE 9 END AS state_rank
 FROM (SELECT *, round(greatest(0, 1.0::double - CASE WHEN NOT {FITS} THEN 0.5 ELSE 0 END - CASE WHEN city <> '' AND lower(city) NOT IN ('annapolis', 'baltimore', 'reston', 'easton', 'mclean', 'leesburg', 'alexandria', 'bethesda') THEN 0.1 ELSE 0 END
 - CASE WHEN length(name) < 4 THEN 0.2 ELSE 0 END - CASE WHEN length(regexp_replace(regexp_replace(lower(website), 'https://|http://|www\\.', '', 'g'), '[^/]', '', 'g')) > 2 THEN 0.1 ELSE 0 END), 6) AS confidence FROM w WHERE reason IS NULL)""",
    "category_canonical": typed() + f"SELECT venue_id, {canonical()} AS canonical FROM v",
    "venue_duplicates": typed(f"x AS (SELECT venue_id, name, _ord, lower(trim(name)) AS n, lower(trim(city)) AS t, {DOMAIN} AS d FROM v)") + "SELECT x.venue_id, x.name, min(y._ord) AS first_ord FROM x JOIN x y ON x.n = y.n AND y._ord < x._ord AND (x.t = y.t OR (x.d = y.d AND x.d <> '')) GROUP BY 1, 2",
    "contact_duplicates": typed() + "SELECT contact_id, venue_id, first_ord FROM (SELECT *, min(_ord) OVER (PARTITION BY venue_id, lower(email)) AS first_ord FROM c) WHERE first_ord < _ord",
    "mailboxes_named_first": typed() + "SELECT lower(email) AS email, (list(contact_id ORDER BY (name = '')::int, _ord))[1] AS contact_id, count(*) AS n FROM c WHERE email <> '' GROUP BY 1",
    "renumber_duplicates": """WITH o AS (SELECT o_orderkey - CASE WHEN o_orderkey % 10 = 3 THEN 1 ELSE 0 END AS id, o_orderkey AS _ord FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _ord) AS nth FROM o)
SELECT id, _ord, CAST(CASE WHEN nth = 1 THEN id ELSE (SELECT max(id) FROM o) + sum((nth > 1)::int) OVER (ORDER BY _ord) END AS bigint) AS new_id FROM r""",
    "keyword_profile": "WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_rows FROM w WHERE length(word) >= 4 GROUP BY 1 ORDER BY n DESC, word LIMIT 30",
    "url_normalized": "WITH " + URL_PARTS + r""" SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\.', '') AS host,
 plain || CASE fragment WHEN '' THEN '' ELSE '#' || fragment END AS normal, plain, lower(regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '\.([^./]*)$', 1)) AS extension,
 CASE WHEN regexp_matches(lower(url), '^[a-z]+://[^/?#]*[^?#]*\.pdf([?#]|$)') THEN 'pdf' ELSE 'page' END AS kind FROM m""",
    "url_scores": "SELECT page_id, CASE " + " ".join(f"WHEN contains(replace(lower(url), '_', '-'), '{w}') THEN {k}" for k, w in enumerate(vocab.PAGE_KEYWORDS)) + f" ELSE {len(vocab.PAGE_KEYWORDS)} + least(length(url) // 40, 10) END AS score FROM pages",
    "page_links": "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\b[^>]*href=[\"'']([^\"'']+)[\"'']', 1)) AS href FROM pages) SELECT page_id, count(*) AS n, count(DISTINCT href) AS n_distinct FROM l GROUP BY 1",
    "step_audit": typed("""m AS (SELECT venue_id, list_filter(string_split(check_status, '|'), lambda x: NOT starts_with(x, 'CHECKED:')) AS parts FROM v WHERE status = 'pipelined')""", """t AS (SELECT venue_id, s.step, s.i, (SELECT split_part(p, ':', 2) FROM (SELECT unnest(parts) AS p) WHERE split_part(p, ':', 1) = s.step LIMIT 1) AS st
 FROM m, (VALUES ('website', 1), ('emails', 2), ('social', 3), ('form', 4), ('people', 5), ('location', 6)) s(step, i))""")
    + """SELECT venue_id, coalesce(string_agg(step, ',' ORDER BY i) FILTER (st IN ('DONE', 'SKIPPED')), '') AS done, coalesce(string_agg(step, ',' ORDER BY i) FILTER (st = 'FAILED'), '') AS failed,
 coalesce(string_agg(step, ',' ORDER BY i) FILTER (st IS NULL OR st NOT IN ('DONE', 'SKIPPED', 'FAILED')), '') AS missing, count(*) FILTER (WHERE st IN ('DONE', 'SKIPPED')) = 6 AS complete FROM t GROUP BY 1""",
    "pending_enrichment": typed() + "SELECT contact_id, venue_id FROM c WHERE name <> '' AND email IN ('', 'undefined')",
    "log_sessions": r"""WITH l AS (SELECT conv_id, turn, upper(role) || ': ' || regexp_replace(text, '\s+', ' ', 'g') AS line FROM conversations),
h AS (SELECT *, regexp_extract(line, '^USER: (\S+)', 1) AS head, regexp_extract(line, '^ASSISTANT: (\S+)', 1) AS a, regexp_extract(line, '^SYSTEM: (\S+)', 1) AS b FROM l),
s AS (SELECT *, count(*) FILTER (WHERE head <> '') OVER (PARTITION BY conv_id ORDER BY turn) AS session FROM h)
SELECT conv_id, session, max_by(head, turn) FILTER (head <> '') AS title, count(*) AS n_lines, min_by(a, turn) FILTER (a <> '') AS reply, min_by(b, turn) FILTER (b <> '') AS system FROM s WHERE session > 0 GROUP BY 1, 2""",
    "event_streaks": """WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events)
SELECT user_id, min(event_id) AS from_ord, event_type AS value, count(*) AS length FROM e GROUP BY user_id, event_type, k HAVING count(*) >= 2""",
    "ledger_cache_hits": "WITH " + REQUESTS + """, l AS (SELECT email, max_by(CASE outcome WHEN 'timeout' THEN 'unknown' ELSE outcome END, seq) AS st, max(ts) AS seen FROM q WHERE ts < timestamp '2024-01-24 13:00:00' GROUP BY 1),
j AS (SELECT seq, st, coalesce(date_diff('microsecond', seen, ts) / 86400000000.0 <= CASE st WHEN 'unknown' THEN 3 ELSE 10 END AND NOT (st = 'unknown' AND retry_unknown), false) AS hit FROM q LEFT JOIN l USING (email) WHERE ts >= timestamp '2024-01-24 13:00:00')
SELECT seq, hit, CASE WHEN hit THEN st END AS status FROM j""",
    "ledger_budget": "WITH " + REQUESTS + """, r AS (SELECT strftime(ts, '%Y-%m-%d') AS day, run_id, count(*) AS run_used FROM q GROUP BY 1, 2), t AS (SELECT *, CAST(sum(run_used) OVER (PARTITION BY day) AS bigint) AS day_used FROM r)
SELECT *, CASE WHEN run_used >= 200 THEN 'run_budget_reached' WHEN day_used >= 320 THEN 'day_budget_reached' ELSE 'ok' END AS reason FROM t""",
    "ledger_decisions": "WITH RECURSIVE " + LEDGER + " SELECT account, seq, status, reason = 'cached' AS cached, reason IN ('charged', 'call_failed') AS charged, reason FROM f WHERE k > 0",
    "ledger_budgets": "WITH RECURSIVE " + LEDGER + """, w AS (SELECT *, reason IN ('charged', 'call_failed') AS charged FROM f WHERE k > 0 AND ts <= timestamp '2024-01-24 13:00:00'),
h AS (SELECT *, reason = 'reserved' AND ts >= timestamp '2024-01-23 13:00:00' AND NOT EXISTS (SELECT 1 FROM w x WHERE x.account = w.account AND x.email = w.email AND x.seq > w.seq AND (x.charged OR x.reason = 'reserved')) AS open FROM w),
r AS (SELECT account, run_id, count(*) FILTER (charged) AS run_used, count(*) FILTER (open) AS run_reserved, count(*) FILTER (charged AND ts >= timestamp '2024-01-24') AS today FROM h GROUP BY 1, 2),
t AS (SELECT account, sum(today) AS day_used, sum(run_reserved) AS day_reserved FROM r GROUP BY 1)
SELECT account, run_id, run_used, run_reserved, CAST(day_used AS bigint) AS day_used, CAST(day_reserved AS bigint) AS day_reserved, CASE WHEN CAST(account AS bigint) % 4 = 3 THEN 'credit_check_failed' WHEN CAST(account AS bigint) % 4 = 1 THEN 'reserve_reached'
 WHEN run_used + run_reserved >= 3 THEN 'run_budget_reached' WHEN day_used + day_reserved >= 2 THEN 'day_budget_reached' ELSE 'ok' END AS reason FROM r JOIN t USING (account)""",
    "snapshot_merge": typed("""x AS (SELECT contact_id, venue_id, email, _ord FROM c)""", """y AS (SELECT CASE WHEN _ord % 2 = 0 THEN contact_id ELSE 'N-' || (_ord % 50) END AS contact_id, venue_id, 'new@site.example.org' AS email, _ord FROM c WHERE verified = 'unknown')""",
        "z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY _ord DESC) = 1)") + "SELECT * FROM x WHERE contact_id NOT IN (SELECT contact_id FROM z) UNION ALL SELECT * FROM z",
    "insert_absent": typed().replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + """,
o AS (SELECT lower(trim(name)) AS n, lower(trim(city)) AS t, lower(split_part(regexp_replace(regexp_replace(website, '^https?://', ''), '^www\\.', ''), '/', 1)) AS d, upper(state) || '-' || substr(upper(category), 1, 4) || '-' || _ord AS id, * FROM v),
x AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY _ord) AS k FROM o WHERE status = 'untouched'),
r AS (SELECT n, 0 AS k, coalesce((SELECT list(t) FROM o WHERE o.n = y.n AND status <> 'untouched'), []) AS ts, coalesce((SELECT list(d) FROM o WHERE o.n = y.n AND status <> 'untouched'), []) AS ds, CAST(NULL AS bigint) AS kept FROM (SELECT DISTINCT n FROM x) y
 UNION ALL SELECT x.n, x.k, CASE WHEN list_contains(ts, x.t) OR (x.d <> '' AND list_contains(ds, x.d)) THEN ts ELSE list_append(ts, x.t) END, CASE WHEN list_contains(ts, x.t) OR (x.d <> '' AND list_contains(ds, x.d)) THEN ds ELSE list_append(ds, x.d) END,
  CASE WHEN list_contains(ts, x.t) OR (x.d <> '' AND list_contains(ds, x.d)) THEN NULL ELSE x._ord END FROM r JOIN x ON x.n = r.n AND x.k = r.k + 1),
i AS (SELECT x.*, coalesce(nullif(upper(state), ''), 'XX') || '-' || substr(coalesce(nullif(upper(category), ''), 'OTHER'), 1, 4) || '-' AS p FROM x WHERE _ord IN (SELECT kept FROM r)),
h AS (SELECT regexp_extract(id, '^(.*-)[0-9]+$', 1) AS p, max(CAST(regexp_extract(id, '([0-9]+)$', 1) AS bigint)) AS top FROM o WHERE status <> 'untouched' GROUP BY 1),
j AS (SELECT i.*, CAST(coalesce(top, 0) + row_number() OVER (PARTITION BY i.p ORDER BY _ord) AS varchar) AS num FROM i LEFT JOIN h ON h.p = i.p)
SELECT p || CASE WHEN length(num) >= 3 THEN num ELSE lpad(num, 3, '0') END AS venue_id, upper(name) AS name, city, upper(state) AS state, zone_priority, _ord FROM j""",
    "cascade_delete": typed("x AS (SELECT venue_id FROM v WHERE status = 'closed')") + "SELECT (SELECT count(*) FROM v WHERE venue_id NOT IN (SELECT venue_id FROM x)) AS n_venues, count(*) AS n_contacts, CAST(sum(_ord) AS bigint) AS ord_sum FROM c WHERE venue_id NOT IN (SELECT venue_id FROM x)",
    "change_log_fold": typed("""l AS (SELECT 'V-' || user_id AS venue_id, CASE event_id % 3 WHEN 0 THEN 'status' WHEN 1 THEN 'city' ELSE 'nonsense' END AS field, CASE event_id % 2 WHEN 0 THEN 'contacted' ELSE 'pipelined' END AS value, event_id AS o FROM events)""",
        "m AS (SELECT venue_id, max_by(value, o) FILTER (field = 'status') AS s, max_by(value, o) FILTER (field = 'city') AS t, bool_or(field = 'status' AND value = 'contacted') AS mark FROM l GROUP BY 1)") + "SELECT venue_id, coalesce(s, status) AS status, coalesce(t, city) AS city, coalesce(mark, false) AS stamped FROM v LEFT JOIN m USING (venue_id)",
    "contact_rejects": typed() + """SELECT email_sent = 'skipped' AS marked, CASE WHEN email_sent = 'skipped' THEN 'accepted'
 WHEN lower(split_part(email, '@', 1)) IN ('info', 'manager', 'admin', 'office', 'contact', 'sales', 'events', 'event', 'privateevents', 'private-events', 'hello', 'support', 'reservations', 'booking', 'bookings', 'frontdesk', 'catering', 'groups', 'weddings', 'meetings', 'eat', 'dine', 'host', 'general', 'mail') THEN 'role mailbox'
 WHEN trim(name) = '' THEN 'no name' WHEN lower(trim(name)) IN ('manager', 'admin', 'owner', 'chef', 'host', 'staff', 'catering', 'events', 'private events', 'general', 'front desk', 'reception') THEN 'role as name' ELSE 'accepted' END AS reason, count(*) AS n FROM c GROUP BY 1, 2""",
    "next_ids": typed("x AS (SELECT venue_id AS id FROM v UNION ALL SELECT contact_id FROM c)") + "SELECT regexp_extract(id, '^(.*?)[0-9]*$', 1) AS prefix, max(CAST(regexp_extract(id, '([0-9]+)$', 1) AS bigint)) AS top FROM x GROUP BY 1",
    "taste_query_plan": "SELECT k || ' in ' || n_name AS q FROM (VALUES ('winery'), ('hotel'), ('museum')) t(k), nation WHERE lower(k || ' in ' || n_name) NOT IN (SELECT 'winery in nation_' || r_regionkey FROM region)",
    "ext_rollup_region": typed() + "SELECT county, state, count(*) AS n, count(*) FILTER (WHERE status = 'contacted') AS contacted FROM v GROUP BY ROLLUP (county, state)",
    "ext_outreach_grouping_sets": typed() + "SELECT channel, strftime(sent_at, '%Y-%m-%d') AS day, count(*) AS n FROM outreach WHERE sent_at IS NOT NULL GROUP BY GROUPING SETS ((channel), (strftime(sent_at, '%Y-%m-%d')))",
    "ext_tumbling": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS decimal(18,4))) AS double) AS total FROM events GROUP BY 1, 2",
    "ext_session": """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS opens FROM events), s AS (SELECT user_id, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e),
t AS (SELECT user_id, k, count(*) AS n FROM s GROUP BY 1, 2) SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM t GROUP BY 1""",
}
#: C4 over names and hosts of the projection, whose only parent or directory sites are facebook pages.
SCORED = f"""t AS (SELECT *, regexp_replace(split_part(regexp_replace(lower(website), '^https?://', ''), '/', 1), 'www\\.', '', 'g') AS h, regexp_extract_all(lower(name), '[a-z0-9]+') AS w FROM v),
t2 AS (SELECT *, regexp_replace(h, '[^a-z0-9]', '', 'g') AS dom, regexp_replace(h || regexp_extract(website, '^(?:https?://)?[^/]*(.*)$', 1), '[^a-z0-9]', '', 'g') AS hay,
 list_filter(list_distinct(w), lambda x: length(x) >= 4 AND x NOT IN {names(dict.fromkeys((*vocab.STOP_WORDS, *vocab.PLACE_WORDS)))}) AS toks FROM t),
t3 AS (SELECT *, list_filter(toks, lambda x: contains(dom, x)) AS ind, len(list_filter(toks, lambda x: contains(hay, x))) AS hit,
 array_to_string(list_transform(list_filter(w, lambda x: x NOT IN {names(vocab.SMALL_WORDS)}), lambda x: x[1]), '') AS acr, array_to_string(list_filter(w, lambda x: list_contains(toks, x)), '') AS joined FROM t2),
t4 AS (SELECT *, 5 * len(ind) + 2 * greatest(0, hit - len(ind)) + CASE WHEN length(joined) >= 7 AND contains(hay, substr(joined, 1, 8)) THEN 7 ELSE 0 END
 + CASE WHEN length(acr) >= 3 AND split_part(h, '.', 1) IN (acr, acr || 'club', acr || 'cc') THEN 8 ELSE 0 END + CASE WHEN len(list_filter(w, lambda x: x IN {names(vocab.TYPE_WORDS)} AND contains(hay, x))) > 0 THEN 2 ELSE 0 END AS raw,
 coalesce(list_max(list_transform(ind, lambda x: length(x))), 0) AS longest FROM t3),
t5 AS (SELECT *, CASE WHEN name = '' OR website = '' OR contains(website, 'facebook.com') THEN -100 WHEN longest >= 7 THEN greatest(raw, 7) WHEN longest >= 5 THEN greatest(raw, 6) ELSE raw END AS score FROM t4)"""
ORACLE_SQL["website_match"] = typed(SCORED) + f"SELECT venue_id, score, {FITS} AS fits, website = '' OR contains(website, 'facebook.com') AS blocked FROM t5"
ORACLE_SQL["quality_issues"] = typed(SCORED, f"x AS (SELECT *, {canonical()} AS canon, replace(lower(coalesce(nullif(category, ''), 'other')), ' ', '_') AS cur FROM t5)") + f"""SELECT venue_id, 'category' AS issue, cur AS current, canon AS suggested, 'high' AS confidence FROM x
 WHERE canon <> 'other' AND canon <> cur AND (cur IN ('restaurant', 'rest', 'other', 'recreation') OR canon IN ('hotel', 'country_club', 'private_club', 'yacht_club', 'wine_bar', 'winery'))
UNION ALL SELECT venue_id, 'website_directory', website, '', 'high' FROM x WHERE contains(website, 'facebook.com') UNION ALL SELECT venue_id, 'website_mismatch', website, 'recheck', 'review' FROM x WHERE website <> '' AND score BETWEEN -99 AND 5"""
ORACLE_SQL["quality_issue_counts"] = f"SELECT issue, count(*) AS n FROM ({ORACLE_SQL['quality_issues']}) GROUP BY 1"
ORACLE_SQL["step_summary"] = f"""WITH a AS ({ORACLE_SQL["step_audit"]}), s AS (SELECT complete, 'done' AS kind, unnest(string_split(done, ',')) AS step FROM a UNION ALL SELECT complete, 'failed', unnest(string_split(failed, ',')) FROM a
UNION ALL SELECT complete, 'missing', unnest(string_split(missing, ',')) FROM a)
SELECT step, count(*) FILTER (WHERE kind = 'done') AS done, count(*) FILTER (WHERE kind = 'failed') AS failed, count(*) FILTER (WHERE kind = 'missing') AS missing FROM s WHERE step <> '' AND complete = (kind = 'done') GROUP BY 1"""

T = "lower(title)"
ORACLE_SQL |= {
    "ranked_recommendations": typed(PLAYED, RECOMMENDED, f"""w AS (SELECT v.*, s.score FROM v JOIN s USING (venue_id)),
y AS (SELECT *, lower(category) AS k, {likes("lower(name)", ("bistro", "steakhouse", "brasserie"))} AS fine, {likes("lower(name)", ("grand", "inn"))} AS lux, {likes("lower(name)", ("ridge", "estate"))} AS est, floor(upscale) AS up FROM w)""")
    + f"""SELECT venue_id, CASE WHEN venue_vote = 'up' THEN 0 WHEN k = 'country_club' THEN 1 WHEN k = 'hotel' AND lux THEN 2 WHEN k = 'restaurant' AND fine THEN 3 WHEN k = 'winery' THEN 4 ELSE 9 END AS taste_rank, score FROM y
 WHERE status NOT IN ('pipelined', 'contacted', 'needs_review') AND venue_vote <> 'down' AND NOT {likes("lower(name)", vocab.JUNK_NAMES)}
 AND (venue_vote = 'up' OR k = 'country_club' OR (k = 'restaurant' AND up >= 4 AND fine) OR (k = 'hotel' AND (up >= 5 OR (up >= 4 AND lux))) OR (k = 'winery' AND up >= 4 AND est))""",
    "contact_routes": typed() + f"""SELECT CASE WHEN {likes(T, vocab.BAD_TITLES)} THEN 'skip' WHEN contains(email, '@') THEN 'enrich' WHEN {likes(T, vocab.DECISION_WORDS)} THEN 'pending' ELSE 'none' END AS route,
 CASE WHEN {T} IN ('server', 'waiter', 'waitress', 'hostess', 'host', 'busser', 'bartender', 'dishwasher', 'line cook', 'prep cook', 'barback') THEN 'SKIP' WHEN contains(email, '@') THEN 'ENRICH' ELSE 'LOG' END AS value, count(*) AS n FROM c GROUP BY 1, 2""",
    "candidate_dispositions": typed("x AS (SELECT contact_id, lower(trim(email)) AS e, 'v' || (_ord % 5) || '.example.org' AS d FROM c WHERE email_sent = 'false' AND email <> '')", "l AS (SELECT lower(email) AS e, min(verified) AS st FROM c WHERE verified <> 'pending' GROUP BY 1)",
        "o AS (SELECT DISTINCT lower(email) AS e FROM c WHERE email_sent <> 'false' AND verified = 'valid' AND email <> '')")
    + f"""SELECT contact_id, CASE WHEN e IN (SELECT e FROM o) THEN 'known' WHEN e = 'ann.lee@v1.example.org' THEN 'owner' WHEN {" OR ".join(f"starts_with(e, '{p}')" for p in vocab.HARD_REJECT_MAIL)} THEN 'hard_reject' ELSE coalesce(st, 'unverified') END AS disposition,
 ({" OR ".join(f"starts_with(e, '{p}')" for p in vocab.GENERIC_MAIL)}) AS generic,
 split_part(e, '@', 2) <> '' AND split_part(e, '@', 2) NOT IN {names(vocab.FREE_MAIL)} AND split_part(e, '@', 2) <> d AND NOT contains(split_part(split_part(e, '@', 2), '.', 1), split_part(d, '.', 1)) AND NOT contains(split_part(d, '.', 1), split_part(split_part(e, '@', 2), '.', 1)) AS off_domain
 FROM x LEFT JOIN l USING (e)""",
    "resolved_ids": typed("h AS (SELECT *, regexp_replace(split_part(regexp_replace(lower(website), '^https?://', ''), '/', 1), '^www\\.', '') AS host FROM v WHERE website <> '')")
    + "SELECT a._ord, (SELECT b.venue_id FROM h b WHERE b.host = a.host ORDER BY b._ord LIMIT 1) AS venue_id FROM h a",
    "gig_distances": typed() + "SELECT g.gig_id, coalesce(g.distance_miles, v.distance_miles) AS distance_miles FROM g LEFT JOIN v USING (venue_id)",
    "attached_titles": typed() + "SELECT contact_id, coalesce(nullif(title, ''), (SELECT min_by(p.title, p._ord) FROM c p WHERE p.verified = 'valid' AND p.title <> '' AND p.venue_id = c.venue_id AND lower(p.email) = lower(c.email))) AS full_title FROM c",
    "venue_flags": typed("x AS (SELECT venue_id, CASE WHEN contains(website, '//') THEN lower(replace(split_part(split_part(website, '//', 2), '/', 1), 'www.', '')) ELSE '' END AS s FROM v)", "y AS (SELECT c.*, s, CASE WHEN contains(email, '@') THEN lower(split_part(email, '@', 2)) ELSE '' END AS d FROM c JOIN x USING (venue_id))",
        """z AS (SELECT venue_id, CASE WHEN NOT bool_or(verified = 'valid') THEN 'No verified emails — only ' || string_agg(DISTINCT verified, ', ' ORDER BY verified) END AS none,
 string_agg('Off-domain email: ' || email || ' (venue: ' || s || ')', '; ' ORDER BY _ord) FILTER (s <> '' AND d <> '' AND d <> s AND regexp_replace(d, '\\.[^.]*$', '') <> regexp_replace(s, '\\.[^.]*$', '') AND d NOT IN ('gmail.com', 'yahoo.com', 'outlook.com', 'hotmail.com', 'aol.com')) AS odd FROM y GROUP BY 1)""")
    + "SELECT venue_id, CASE WHEN z.venue_id IS NULL THEN 'No contacts found' ELSE concat_ws('; ', none, odd) END AS flags FROM x LEFT JOIN z USING (venue_id) WHERE z.venue_id IS NULL OR none IS NOT NULL OR odd IS NOT NULL",
    "report_totals": typed() + """SELECT count(DISTINCT venue_id) AS venues, count(*) AS contacts, count(*) FILTER (WHERE verified = 'valid') AS valid,
 (SELECT CAST(sum(u) AS bigint) FROM (SELECT max(CAST(floor(value) AS bigint)) AS u FROM events GROUP BY event_id % 40)) AS credits FROM c""",
    "region_progress": typed("n AS (SELECT county AS region, city, bool_or(status = 'contacted') AS swept, count(*) AS n FROM v GROUP BY 1, 2)")
    + "SELECT region, count(*) FILTER (WHERE swept) AS swept, count(*) AS cities, CAST(sum(n) AS bigint) AS venues, CAST(floor(100.0 * count(*) FILTER (WHERE swept) / count(*) + 0.5) AS bigint) AS percent FROM n GROUP BY ROLLUP (region)",
    "channel_totals": typed() + "SELECT 'count_' || channel AS key, count(*) AS value FROM outreach WHERE channel <> '' GROUP BY 1",
    "within_credits": """WITH e AS (SELECT user_id % 50 AS run_id, sum(floor(value)) OVER (PARTITION BY user_id % 50 ORDER BY event_id) - floor(value) AS used FROM events) SELECT run_id, count(*) AS n FROM e WHERE used < 300 GROUP BY 1""",
    "log_sections": "SELECT conv_id, turn FROM conversations c WHERE turn > 0 AND turn <> 3 AND turn < coalesce((SELECT min(turn) FROM conversations d WHERE d.conv_id = c.conv_id AND turn = 3), 1000000000) AND EXISTS (SELECT 1 FROM conversations d WHERE d.conv_id = c.conv_id AND turn = 0)",
}

#: Links of pages are relative to the host's root here, so their targets need no general resolution.
LINKS = URL_PARTS + r""", l AS (SELECT plain AS src, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*href=["'']([^"'']+)["'']', 1)) AS href, base FROM m JOIN n USING (page_id, url, html)),
e AS (SELECT src, base || CASE rtrim(split_part(replace(href, '&amp;', '&'), '#', 1), '/') WHEN '' THEN '/' ELSE rtrim(split_part(replace(href, '&amp;', '&'), '#', 1), '/') END AS dst FROM l WHERE starts_with(href, '/'))"""
ORACLE_SQL |= {
    "emails_in_documents": f"""WITH e AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}'))) AS email FROM documents),
t AS (SELECT *, regexp_replace(email, '\\.+$', '') AS x FROM e)
SELECT doc_id, email, NOT ({likes("email", vocab.JUNK_MAIL)} OR {" OR ".join(f"starts_with(x, '{p}')" for p in vocab.REJECTED_MAIL)} OR length(x) > 120) AS usable, ({" OR ".join(f"starts_with(email, '{p}')" for p in vocab.GENERIC_MAIL)}) AS generic FROM t""",
    "website_fits": typed() + f"""SELECT venue_id, {FITS} AS fits, website = '' OR contains(website, 'facebook.com') AS blocked FROM v""",
    "crawl_reachable": "WITH RECURSIVE " + LINKS + """, s AS (SELECT DISTINCT plain AS url FROM m WHERE url LIKE 'https:%' AND url NOT LIKE '%?%'),
r AS (SELECT url, 0 AS depth FROM s UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < 3), f AS (SELECT url, min(depth) AS depth FROM r GROUP BY 1) SELECT depth, count(*) AS n FROM f GROUP BY 1""",
}
KEYWORD_RANK = "CASE " + " ".join(f"WHEN contains(replace(lower(dst), '_', '-'), '{w}') THEN {k}" for k, w in enumerate(vocab.PAGE_KEYWORDS)) + f" ELSE {len(vocab.PAGE_KEYWORDS)} + least(length(dst) // 40, 10) END"
HOST = r"regexp_replace(regexp_extract(lower({}), '^[a-z]+://([^/?#:]*)', 1), '^www\.', '')"
ORACLE_SQL |= {
    "crawl_unvisited": "WITH " + LINKS + f" SELECT dst, count(DISTINCT src) AS n_sources, CASE WHEN regexp_matches(lower(dst), '\\.pdf$') THEN 'pdf' ELSE 'page' END AS kind, {KEYWORD_RANK} AS score FROM e WHERE dst NOT IN (SELECT plain FROM m) GROUP BY dst",
    "host_coverage": "WITH " + LINKS + f""", p AS (SELECT {HOST.format("url")} AS host, count(*) AS n_pages FROM pages GROUP BY 1), k AS (SELECT {HOST.format("src")} AS host, count(*) AS n_links FROM e GROUP BY 1)
SELECT host, n_pages, coalesce(n_links, 0) AS n_links, 0 AS n_fragments, 0 AS n_files FROM p LEFT JOIN k USING (host)""",
}


def legacy() -> str:
    """C2 for the kinds that the projection has, written out in its order."""
    rules = [
        (likes(N, ("country club", "golf club")), "country_club"),
        (likes(N, ("yacht club", " yacht ")), "yacht_club"),
        (f"regexp_matches({N}, '\\bwine\\s*bar\\b')", "wine_bar"),
        (likes(N, (" hotel ", " inn ", " resort ", " lodge ")), "hotel"),
        (likes(C, ("hotel", "inn", "resort", "lodge")), "hotel"),
        (likes(C, ("winery", "vineyard")), "winery"),
        (likes(C, ("country club", "golf club")), "country_club"),
        (likes(C, ("wine bar",)), "wine_bar"),
        (likes(C, ("restaurant", "fine dining", "steakhouse", "brasserie", "bistro")), "restaurant"),
        (likes(C, ("art gallery",)), "art_gallery"),
        (likes(C, ("museum", "gallery")), "museum"),
        (likes(C, ("event", "banquet", "wedding", "party", "catering")), "event"),
        (likes(C, ("private club", "social club")), "private_club"),
        (likes(C, ("spa",)) + " AND NOT " + likes(C, ("spanish",)), "spa"),
        (likes(C, ("swim", "pool", "tennis", "golf", "gym")), "recreation"),
        (f"regexp_matches({N}, '\\bgaller(y|ies)\\b')", "art_gallery"),
        (f"regexp_matches({N}, '\\bmuseum\\b')", "museum"),
        (f"regexp_matches({N}, '\\b(brewery|breweries|brewing)\\b')", "brewery"),
        (f"regexp_matches({N}, '\\b(winery|wineries|vineyard)\\b')", "winery"),
        (f"regexp_matches({N}, '\\b(theater|theatre|cinema)\\b')", "theater"),
        (likes(f"replace({N}, 'falls church', ' ')", (" church ", " cathedral ")), "church"),
        (f"regexp_matches({N}, '\\blibrar(y|ies)\\b')", "library"),
        (f"regexp_matches({N}, '\\bspa\\b') AND NOT contains({N}, 'spanish')", "spa"),
    ]
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in rules) + " ELSE 'other' END"


ORACLE_SQL["category_disagreement"] = typed() + f"SELECT {canonical()} AS a, {legacy()} AS b, count(*) AS n FROM v GROUP BY 1, 2"
BY = "composite DESC, upscale DESC, state_rank, lower(name), _ord"
ORACLE_SQL["batch_selected"] = typed(f"b AS ({ORACLE_SQL['batch_pool']})", "q AS (SELECT b.*, name, state, upscale, _ord, regexp_replace(lower(trim(category)), '[ -]', '_', 'g') AS k FROM b JOIN v USING (venue_id))",
    f"""p AS (SELECT *, CASE WHEN k = 'restaurant' AND {likes("lower(name)", vocab.FRENCH_NAMES)} THEN 'french' WHEN k IN ('country_club', 'private_club') THEN 'clubs' WHEN k = 'hotel' THEN 'hotels' WHEN k IN ('winery', 'wine_bar') THEN 'wine' WHEN k IN ('art_gallery', 'museum', 'event_venue') THEN 'wild' END AS bucket FROM q)""",
    f"o AS (SELECT *, row_number() OVER (ORDER BY {BY}) AS pos, row_number() OVER (PARTITION BY bucket ORDER BY {BY}) AS rk FROM p)",
    "k2 AS (SELECT *, coalesce(rk <= CASE bucket WHEN 'french' THEN 6 WHEN 'clubs' THEN 4 WHEN 'hotels' THEN 4 WHEN 'wine' THEN 3 WHEN 'wild' THEN 3 END, false) AS picked FROM o)",
    "t AS (SELECT *, picked OR row_number() OVER (PARTITION BY picked ORDER BY pos) <= 20 - (SELECT count(*) FROM k2 WHERE picked) AS used FROM k2)",
    "e2 AS (SELECT *, state IN ('DC', 'VA', 'MD') AS core, row_number() OVER (PARTITION BY used AND state NOT IN ('DC', 'VA', 'MD') ORDER BY pos) AS edge FROM t)",
    "f2 AS (SELECT *, used AND (core OR edge <= 2) AS kept FROM e2)", "h2 AS (SELECT *, row_number() OVER (PARTITION BY NOT used AND core ORDER BY pos) AS fill FROM f2)") + """SELECT venue_id, name, state, bucket, confidence < 0.8 AS suspicious, row_number() OVER (ORDER BY pos) AS place FROM h2
 WHERE kept OR (NOT used AND core AND fill <= 20 - (SELECT count(*) FROM f2 WHERE kept) AND EXISTS (SELECT 1 FROM f2 WHERE used AND NOT kept))"""
