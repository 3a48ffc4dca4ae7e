"""Sample news made from ``documents``, and the rules as SQL that the rule engine must agree with.

Each document becomes one article: title, description, body and link are picked by its id from
the lists below, which have phrases for each rule; a body may be the document's whole text. The SQL
states the rules once more, layer by layer, as DuckDB expressions; only the word lists are shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions import articles
from quillsieve.functions import wordlists as w
from quillsieve.operators.rules import EXEMPT, REASONS, Pack
from quillsieve.sources.scratch import spread

PLACES = ["Gurugram", "Faridabad", "Dwarka Expressway", "Noida", "Sohna Road", "Delhi NCR", "Pune"]
MAKERS = ["DLF", "BPTP", "M3M", "Omaxe", "Godrej Properties", "Lodha", "Acme"]
TITLES = [
    "{c} residential project launches with Rs 900 crore investment",
    "{m} chairman's remuneration rises, says filing on {c} housing",
    "{m} reports customer confidence as top developer in {c}",
    "{m} wins realty award for housing project in {c}",
    "Apartment purchase at The Camellias in {c} sets a record deal",
    "HSVP lists commercial sites in {c} sector",
    "Metro corridor to lift {c} real estate growth",
    "RRTS transit corridor to link Gurugram, Faridabad and {c}",
    "NCR office leasing climbs in {c}",
    "Faridabad boom seen as Jewar airport nears; {c} investors watch",
    "Faridabad housing demand beats {c} as property market grows",
    "{c} market remains resilient, real estate demand firm",
    "Faridabad-Noida-Ghaziabad expressway corridor near {c} gets nod",
    "Police file fir over builder fraud in {c}",
    "RERA nod for {c} township project",
    "High court on {c} housing project launch",
    "{c} college webinar on housing",
    "Latest News",
    "{c} metro station and sports complex project to launch",
    "Quarterly update: {m} net profit and sales up across markets near {c}",
    "What buyers should know about {c} real estate",
    "South Delhi homes cost more than {c}",
    "Mumbai and Pune realty launch, {c} next",
    "गुरुग्राम {c} परियोजना",
    "",
    "{m} plans new launches, scouts land for a project",
    "{c} expressway interchange improves connectivity and infrastructure",
    "BPTP tower update for {c}",
    "{m} signs a lease",
    "Weather alert for {c}",
    "Golf Course Road and SPR plots see appreciation in {c}",
    "Traffic booths and kiosks add to {c}",
    "Group housing project approved in {c} by {m}",
    "{c} property tax dues leave homebuyers stranded",
    "A report, news in hindi, from {c}",
    "Realty growth story of {c}",
    "{m} has bookings worth Rs 4,000 crore in {c} project",
    "Delhi,ncr realty map has {c}",
    "{c} auction and demarcation of community sites",
    "Commercial plots sold out in {c}",
    "{m} ipo lifts shares, residential sales strong, says CEO",
    "énoida and noidaé are no places, {c} is",
]
ABOUT = [
    "The residential project in {c} adds luxury homes and better connectivity.",
    "",
    "Real estate developer {m} said sales and profit grew.",
    "{c} property market growth was strong.",
    "A short note.",
    "The luxury apartment transaction was in Gurugram.",
    "Development and commercial infrastructure in {c} moved on.",
    "Housing in Mumbai, Bengaluru and Chennai rose.",
    "Delhi NCR realty had new launches.",
    "Residents filed a complaint after a delay.",
    "The office market of NCR had commercial leasing.",
    "An event with a photo gallery was held.",
    "Noida and Ghaziabad plan an expressway with Faridabad.",
]
BODIES = [
    None,  # the document's text
    "",
    "The {c} project by {m} is a township.",
    "Mumbai, Pune and Chennai saw launches; Mumbai led.",
    "{c} and Gurugram, again {c}. Greater Faridabad too.",
    "A man was killed in an accident, police said.",
    "Delhi, New Delhi and Noida were named; Noida twice.",
    "Godrej Properties and DLF had revenue growth in the quarter.",
    "Dwarka Expressway and Golf Course Road.",
    "Uttar Pradesh, Ghaziabad and Delhi NCR.",
    "Manesar and Sohna.",
]
LINKS = [
    "https://example.com/realty/{i}",
    "https://example.com/news/{i}",
    "https://hsvphry.org.in/documents/notices/NEWS_202607041240_{i}.pdf",
    "https://example.com/gurugram/expressway-{i}",
    "https://example.com/story/{i}",
    "https://example.com/videos/{i}",
    "https://example.com/delhi-ncr/office-space-{i}",
    "https://example.com/realty/fraud-{i}",
    "not a link {i}",
    "https://www.amarujala.com/{i}",
    "",
]
IMAGES = ["https://example.com/a.jpg", "https://example.com/b.jpg", "https://example.com/c.png", "", "nowhere"]
#: column: values, and its place in them by d (the document's id, without its sign).
PICKS = {
    "title": (TITLES, "d % 42"),
    "description": (ABOUT, "(d * 3 + d // 42) % 13"),
    "articleText": (BODIES, "(d * 5 + d // 13) % 11"),
    "newsLink": (LINKS, "(d // 5 + d * 2) % 11"),
    "thumbnailImage": (IMAGES, "(d // 7) % 5"),
    "postedBy": (["Example News", "Example News", "Other News", ""], "(d // 3) % 4"),
    "postedByLogo": (["https://example.com/logo.png", "https://example.com/logo.png", "x"], "(d // 11) % 3"),
    "c": (PLACES, "(d // 42 + d // 9) % 7"),
    "m": (MAKERS, "(d * 5 + d // 42) % 7"),
}


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An article for each document; seq is its id."""
    d = F.abs(F.coalesce("doc_id", F.lit(0)))
    picked = {}
    for name, (values, place) in PICKS.items():
        at = F.expr(place.replace("//", "DIV").replace("d", "__d"))
        picked[name] = F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).select("doc_id", "text", d.alias("__d"))
    rows = docs.withColumns(picked)
    rows = rows.withColumn("articleText", F.coalesce("articleText", "text", F.lit("")))
    fill = lambda x: F.replace(F.replace(F.replace(x, F.lit("{c}"), F.col("c")), F.lit("{m}"), F.col("m")), F.lit("{i}"), F.col("doc_id").cast("string"))
    rows = rows.withColumns({k: fill(F.col(k)) for k in ("title", "description", "newsLink")})
    body = F.when(F.col("articleText") == F.col("text"), F.col("text")).otherwise(fill(F.col("articleText")))
    return articles.ensure(rows.select(F.col("doc_id").alias("seq"), body.alias("articleText"), "title", "description", "newsLink", "thumbnailImage", "postedBy", "postedByLogo", F.lit("2026-07-01T00:00:00Z").alias("publishedAt")))


# The same in SQL


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_news() -> str:
    """SELECT of seq, title, description, articleText, newsLink, thumbnailImage, postedBy, postedByLogo."""
    picked = ", ".join(f"[{', '.join('NULL' if v is None else text(v) for v in values)}][CAST({place} AS INTEGER) + 1] AS {name}" for name, (values, place) in PICKS.items())
    fill = "replace(replace(replace({0}, '{{c}}', c), '{{m}}', m), '{{i}}', CAST(doc_id AS VARCHAR))".format
    filled = ", ".join(f"{fill(k)} AS {k}" for k in ("title", "description", "newsLink"))
    body = f"CASE WHEN articleText IS NULL THEN coalesce(text, '') ELSE {fill('articleText')} END"
    return f"SELECT doc_id AS seq, {body} AS articleText, {filled}, thumbnailImage, postedBy, postedByLogo FROM (SELECT doc_id, text, {picked} FROM (SELECT *, abs(coalesce(doc_id, 0)) AS d FROM documents))"


def _quoted(words: list[str]) -> str:
    special = set(".*+?^${}()|[]\\")
    return "|".join("".join("\\" + c if c in special else c for c in word) for word in words)


def some(c: str, words: list[str]) -> str:
    """Any of the words as a substring."""
    return f"regexp_matches({c}, {text(_quoted(words))})" if words else "false"


def word(c: str, words: list[str]) -> str:
    return f"regexp_matches({c}, {text(f'\\b(?:{_quoted(words)})\\b')})" if words else "false"


def count(c: str, words: list[str]) -> str:
    """Mentions, summed word by word."""
    return "(" + " + ".join(f"len(regexp_extract_all({c}, {text(f'\\b{_quoted([x])}\\b')}))" for x in words) + ")" if words else "0"


def codes(values: list[str]) -> str:
    return "CAST([" + ", ".join(map(text, values)) + "] AS VARCHAR[])"


def sql_rules(pack: Pack, source: str, code: str, tag: str) -> str:
    """CTEs that end in ``{tag}``: the columns of ``source`` with all rules, for the city ``code``.

    source: title, description, articleText, newsLink and others.
    """
    places = dict(pack.cities)
    out, target = pack.outside, pack.targets
    without = lambda names: [k for k in out if k not in names]
    region = "regexp_matches(pu, '\\bdelhi[\\s-]?ncr\\b')"
    allowed = "CASE " + " ".join(f"WHEN branch = {i} THEN {{{i}}}" for i in range(len(EXEMPT))) + " END"
    outside = lambda c, branch: allowed.replace("branch", branch).format(*[word(c, without(e)) for e in EXEMPT])
    mentioned = lambda c: allowed.format(*[count(c, without(e)) for e in EXEMPT])
    near = codes(pack.region_cities)
    layers: list[dict[str, str]] = [
        {
            "code": code,
            "t": "lower(title)",
            "p": "lower(title) || ' ' || lower(description)",
            "b": "lower(articleText)",
            "u": "lower(newsLink)",
            "s": "lower(title) || ' ' || lower(description) || ' ' || lower(articleText) || ' ' || lower(newsLink)",
        },
        {"pu": "p || ' ' || u", "tu": "t || ' ' || u"},
        {
            "r1": f"NOT ({word('p', w.NEGATIVE_WORDS)} OR {some('p', w.NEGATIVE_PHRASES)} OR {word('u', w.NEGATIVE_WORDS)} OR {some('u', w.NEGATIVE_PHRASES)})",
            "severe": f"({word('b', w.SEVERE_WORDS)} OR {some('b', w.SEVERE_PHRASES)})",
            "r3_title": word("tu", target),
            "r3_primary": word("p", target),
            "r4": f"{word('pu', ['faridabad'])} AND {some('pu', w.AIRPORT_SIGNALS)} AND {some('pu', w.GROWTH_SIGNALS)}",
            "r5": f"regexp_matches(u, 'hsvphry\\.org\\.in/documents/notices/news_') AND {word('p', ['faridabad'])} AND {some('p', w.NOTICE_WORDS)} AND NOT {some('p', w.NEGATIVE_PHRASES)}",
            "r6_home": word("s", w.HOME_CORRIDORS),
            "r6_transit": some("pu", w.TRANSIT_SIGNALS),
            "r6_promo": some("pu", w.PROMOTION_SIGNALS),
            "region": region,
            "maker": some("pu", w.COMPANY_NAMES),
            "property": some("pu", w.PROPERTY_WORDS),
            "n_in": count("s", target),
            "n_out": count("s", out),
        },
        {
            "r2": "r1 AND NOT severe",
            "r7": f"regexp_matches(tu, '\\bncr\\b') AND {some('pu', w.OFFICE_SIGNALS)} AND NOT {some('pu', w.HOUSING_SALES)}",
            "r8": f"r1 AND {word('pu', ['faridabad', 'faridabads'])} AND {word('pu', ['gurugram', 'gurgaon', 'noida'])} AND property AND ({some('pu', w.MARKET_SIGNALS)} OR {some('pu', w.GROWTH_SIGNALS)})",
            "r9": f"r1 AND {word('pu', ['faridabad'])} AND {word('pu', ['noida'])} AND {word('pu', ['ghaziabad'])} AND {some('pu', w.CONNECTIVITY_SIGNALS)} AND {some('pu', w.CORRIDOR_WORDS)}",
            "r10": f"r6_transit AND {word('pu', places['gurugram'])} AND {word('pu', places['faridabad'])} AND ({word('pu', ['noida'])} OR (n_in >= 2 AND n_out > 0 AND n_in / (n_in + n_out) >= 0.67))",
            "r11": f"r1 AND (r3_title OR region OR r4) AND {some('pu', w.CONNECTIVITY_SIGNALS)} AND {some('pu', w.CONNECTED_WORDS)}",
            "r12_authority": f"(r1 OR r5) AND r3_title AND {some('pu', w.AUTHORITY_SIGNALS)} AND {some('pu', w.AUTHORITY_WORDS)}",
            "r12_civic": f"r1 AND r3_title AND {some('pu', w.CIVIC_WORKS)} AND {some('pu', w.CIVIC_ACTS)} AND NOT {some('pu', w.NEGATIVE_PHRASES)} AND NOT {word('pu', w.CIVIC_CRIMES)}",
            "explicit": "list_filter([" + ", ".join(f"CASE WHEN {word('p', names)} OR ({count('s', names)} >= 1 AND {count('s', names)} = n_in + n_out) THEN {text(c)} END" for c, names in pack.cities) + "], lambda x: x IS NOT NULL)",
            "company": "CASE " + " ".join(f"WHEN {word('s', names)} THEN {text(c)}" for c, names in w.COMPANIES) + " END",
        },
        {
            "r12_luxury": f"r2 AND {some('pu', w.LUXURY_DEALS)} AND {some('pu', w.LUXURY_PROJECTS)} AND {word('pu', ['gurugram', 'gurgaon'])}",
            "branch": f"CASE WHEN r9 THEN 1 WHEN code = {text(w.OPT_IN_CITY[0])} THEN 2 WHEN r4 THEN 3 WHEN r8 THEN 4 WHEN r7 THEN 5 WHEN r10 OR r11 THEN 6 WHEN region OR r6_home THEN 2 ELSE 0 END",
            "branch_company": "CASE WHEN r9 THEN 1 WHEN r4 THEN 3 WHEN r8 THEN 4 WHEN r7 THEN 5 WHEN r10 OR r11 THEN 6 WHEN region OR r6_home THEN 2 ELSE 0 END",
        },
        {"r13_pu": outside("pu", "branch"), "r13_title": outside("t", "branch"), "r13_primary": outside("p", "branch"), "r13_body": mentioned("b"), "r13_company": outside("pu", "branch_company")},
        {
            "r14": f"b <> '' AND r13_body > 0 AND r13_body > 2 * {count('b', target)}",
            "r15": f"""CASE WHEN company IS NULL THEN {codes([])} WHEN len(explicit) > 0 THEN explicit
              WHEN company <> '' AND r13_company THEN {codes([])}
              WHEN company = '' AND {word('pu', [k for k in out if k not in ('delhi', 'new delhi')])} THEN {codes([])}
              WHEN company = '' AND {word('pu', w.FRONT_COMPANY)} AND {some('pu', w.FRONT_SIGNALS)} THEN {near}
              WHEN company = '' AND region THEN {near}
              WHEN company <> '' THEN [company] ELSE {codes([])} END""",
            "r16": f"r1 AND r3_title AND property AND {some('pu', w.MARKET_SIGNALS)} AND NOT r13_pu",
        },
        {
            "r17_leader": f"r1 AND len(r15) > 0 AND {some('pu', w.CONFIDENCE_SIGNALS)} AND {some('pu', w.BUSINESS_WORDS)}",
            "r17_award": f"r1 AND ({word('pu', target)} OR len(r15) > 0) AND maker AND {some('pu', w.AWARD_WORDS)} AND {some('pu', w.AWARD_SUBJECTS)}",
        },
        {"r18": f"trim(t) IN ({', '.join(map(text, w.BLOCKED_TITLES))}) OR regexp_matches(p, '[\\x{{0900}}-\\x{{097F}}]') OR (NOT r17_award AND ({some('p', w.BLOCKED_TEXT)} OR {some('u', w.BLOCKED_LINKS)}))"},
        {"r19_corporate": f"NOT r18 AND r1 AND len(r15) > 0 AND {some('pu', w.PAY_SIGNALS)} AND NOT r13_pu", "r19_rera": f"NOT r18 AND {some('pu', w.REGULATOR_WORDS)}"},
        {"r20": "r19_corporate OR r17_leader OR r12_luxury OR r12_authority OR r11 OR r12_civic OR r16"},
        {"r21_evidence": "region OR r7 OR r4 OR r17_award OR r20 OR r3_title", "r21_specific": f"r10 OR r7 OR r4 OR r9 OR r8 OR r17_award OR r16 OR r20 OR {some('pu', w.PROJECT_SIGNALS)}"},
        {
            "r22_evidence": f"r21_evidence AND r6_promo AND ({some('pu', w.SECTOR_WORDS)} OR maker)",
            "r22_national": f"NOT r18 AND r21_evidence AND r6_promo AND {some('s', w.COMPANY_NAMES)} AND {some('s', w.BUSINESS_SIGNALS)} AND NOT r13_title",
            "r22_progress": f"r2 AND r21_evidence AND r6_promo AND r21_specific AND {some('pu', w.PROGRESS_SIGNALS)}",
        },
        {
            "r23_related": "NOT r18 AND (r22_evidence OR r22_national OR r7 OR r8 OR r17_award OR r20)",
            "r23_court": f"NOT r18 AND {word('pu', w.COURT_WORDS)} AND r22_evidence",
            "r23_broad": f"NOT (r10 OR r7 OR r4 OR r8 OR r16 OR r22_progress OR r20) AND {some('pu', w.BROAD_SIGNALS)} AND NOT r21_specific",
            "r23_outside": "NOT (r10 OR r7 OR r4 OR r8 OR r11 OR r20 OR r22_progress) AND (regexp_matches(p, '\\b(?:new delhi|south delhi|central delhi|east delhi|west delhi|north delhi|delhi,|delhi:)\\b') OR r13_primary)",
            "r23_conflict": "NOT (r22_progress OR (r20 AND (r3_title OR region))) AND (r13_pu OR r14)",
        },
        {"r24": "NOT (r4 OR r22_progress OR r12_civic OR r5) AND (NOT r1 OR severe OR r19_rera OR r23_court)"},
        {
            "t2": f"""CASE WHEN NOT r23_related THEN {codes([])} WHEN r9 THEN {codes(['faridabad'] + ([w.OPT_IN_CITY[0]] if pack.opt_in else []))}
              WHEN r4 OR r8 THEN {codes(['faridabad'])} WHEN company IS NOT NULL AND (r17_award OR r20) THEN r15 WHEN r7 THEN {near}
              WHEN len(explicit) > 0 THEN explicit WHEN region THEN {near} ELSE {codes([])} END""",
            "r25": """CASE WHEN r24 THEN 'reject_negative' WHEN r7 THEN 'ncr_office_market' WHEN r4 THEN 'faridabad_jewar_catalyst' WHEN r10 THEN 'target_corridor'
              WHEN r11 THEN 'connectivity_catalyst' WHEN r8 THEN 'positive_city_market' WHEN r12_authority THEN 'authority_pipeline' WHEN r12_luxury THEN 'luxury_transaction'
              WHEN r19_corporate THEN 'developer_corporate_positive' WHEN r17_leader THEN 'leadership_confidence' WHEN r17_award THEN 'project_development'
              WHEN r16 THEN 'positive_city_market' WHEN r22_progress OR (r22_evidence AND r21_specific) THEN 'project_development' ELSE 'unclassified' END""",
        },
    ]
    ctes, last = [], source
    for i, layer in enumerate(layers):
        name = tag if i == len(layers) - 1 else f"{tag}_{i}"
        ctes.append(f"{name} AS MATERIALIZED (SELECT *, {', '.join(f'{v} AS {k}' for k, v in layer.items())} FROM {last})")
        last = name
    return ",\n".join(ctes)


_JOINED = "concat_ws(' ', nullif(title, ''), nullif(description, ''), nullif(articleText, ''), nullif(postedBy, ''), nullif(newsLink, ''))"
SQL_FOREIGN = f"(regexp_matches({_JOINED}, '[\\x{{0900}}-\\x{{097F}}]') OR regexp_matches(lower({_JOINED}), '\\bnews in hindi\\b') OR contains(lower({_JOINED}), 'amarujala.com'))"


def sql_reasons(sent: str) -> str:
    """The reasons of a row of rules with ``city``, its code; ``sent``: whether it was sent before."""
    blank = [("title", "title"), ("description", "description"), ("cityCode", "city"), ("newsLink", "newsLink"), ("thumbnailImage", "thumbnailImage"), ("postedBy", "postedBy"), ("postedByLogo", "postedByLogo")]
    missing = "list_filter([" + ", ".join(f"CASE WHEN trim({c}) = '' THEN {text(n)} END" for n, c in blank) + "], lambda x: x IS NOT NULL)"
    invalid = "list_filter([" + ", ".join(f"CASE WHEN NOT regexp_matches({c}, '^(?i)https?://[^/?#\\s]+') THEN {text(c)} END" for c in w.URL_FIELDS) + "], lambda x: x IS NOT NULL)"
    listed = [
        ("r18", REASONS[1]), (SQL_FOREIGN, REASONS[2]), ("r24", REASONS[3]), ("NOT r23_related", REASONS[4]), ("r23_related AND NOT r21_specific", REASONS[9]),
        ("r23_broad", REASONS[10]), ("city = ''", REASONS[5]), ("city <> '' AND NOT r21_evidence", REASONS[6]), ("r23_outside", REASONS[7]), ("r23_conflict", REASONS[8]),
    ]
    parts = [f"CASE WHEN {c} THEN {text(r)} END" for c, r in listed]
    parts.append(f"CASE WHEN city <> '' AND len({missing}) > 0 THEN 'filter 11: missing required fields (' || array_to_string({missing}, ', ') || ')' END")
    parts.append(f"CASE WHEN city <> '' AND len({invalid}) > 0 THEN 'filter 12: invalid URL fields (' || array_to_string({invalid}, ', ') || ')' END")
    parts.append(f"CASE WHEN {sent} THEN {text(REASONS[13])} END")
    return f"CASE WHEN title = '' OR newsLink = '' THEN [{text(REASONS[0])}] ELSE list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL) END"


def sql_near_miss(why: str) -> str:
    """Whether a rejected article looks like one that should have gone out."""
    has = lambda *ids: f"list_has_any({why}, {codes([REASONS[i] for i in ids])})"
    looks = f"((({word('pu', Pack.default().targets)}) AND ({some('pu', w.SECTOR_WORDS)} OR r6_promo OR maker)) OR maker OR {some('pu', w.AUTHORITY_SIGNALS)} OR {some('pu', w.CONNECTIVITY_SIGNALS)} OR {some('pu', w.LUXURY_PROJECTS)})"
    context = f"(city <> '' OR (r25 <> 'unclassified' AND len(r15) > 0 AND {some('pu', w.BUSINESS_WORDS)}))"
    able = f"{context} AND {looks} AND NOT r18 AND NOT {SQL_FOREIGN} AND NOT r24 AND NOT ({has(7, 8)} AND NOT (city <> '' AND r3_primary AND maker))"
    return f"({able} AND (r25 NOT IN ('unclassified', 'reject_negative') OR ({has(4, 5, 6, 9, 10)} AND NOT {has(7, 8)})))"


def sql_routed(pack: Pack) -> str:
    """CTEs that end in ``n``: news with all rules and ``city``, the code of the first city."""
    first = f"src AS MATERIALIZED ({sql_news()}),\n{sql_rules(pack, 'src', repr(''), 'one')}"
    if not pack.opt_in:
        return f"WITH {first},\nn AS (SELECT *, coalesce(t2[1], '') AS city FROM one)"
    own = ", ".join(["seq", "articleText", "title", "description", "newsLink", "thumbnailImage", "postedBy", "postedByLogo"])
    return f"WITH {first},\nagain AS (SELECT {own}, coalesce(t2[1], '') AS city FROM one),\n{sql_rules(pack, 'again', 'city', 'n')}"
