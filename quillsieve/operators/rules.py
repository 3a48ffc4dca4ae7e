"""The article rules: layered flags, city codes, label and rejection reasons.

A rule uses others, up to fifteen levels deep. Written as chained columns the optimizer would put
each rule's expression into every rule that uses it; here each layer is bound once, as a struct
that a one-element ``transform`` passes to the next layer. Keyword lists are data: a ``Pack``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions import articles
from quillsieve.functions import wordlists as w
from quillsieve.functions.text import any_of, any_word, mentions

DEVANAGARI = r"[\x{0900}-\x{097F}]"
REGION = r"(?<![A-Za-z0-9_])delhi[\s-]?ncr(?![A-Za-z0-9_])"
CAPITAL = r"(?<![A-Za-z0-9_])(?:(?:new|south|central|east|west|north) delhi(?![A-Za-z0-9_])|delhi[,:](?=[A-Za-z0-9_]))"

REASONS = {
    0: "filter 0: missing title/link",
    1: "filter 1: spam/menu page",
    2: "filter 2: non-English/Hindi content",
    3: "filter 3: negative/crime/utility concern news",
    4: "filter 4: not positive target real-estate/project news",
    5: "filter 5: no allowed city match",
    6: "filter 6: target region missing or weak",
    7: "filter 7: outside region in title/description",
    8: "filter 8: outside-city conflict",
    9: "filter 9: no specific project/development signal",
    10: "filter 10: broad market/company update, not city project news",
    13: "filter 13: already sent",
}


@dataclass(frozen=True)
class Pack:
    """Which cities take part, and what follows from it."""

    opt_in: bool = False
    cities: list[tuple[str, list[str]]] = field(default_factory=list)

    @staticmethod
    def default(opt_in: bool = False) -> Pack:
        return Pack(opt_in, w.CITIES + ([w.OPT_IN_CITY] if opt_in else []))

    @property
    def targets(self) -> list[str]:
        return [k for _, names in self.cities for k in names] + w.REGION_NAMES

    @property
    def outside(self) -> list[str]:
        return [k for k in w.OUTSIDE_PLACES if not (self.opt_in and k in w.OPT_IN_NOT_OUTSIDE)]

    @property
    def region_cities(self) -> list[str]:
        return w.REGION_CITIES + ([w.OPT_IN_CITY[0]] if self.opt_in else [])

    def names(self, code: str) -> list[str]:
        return dict(self.cities)[code]


#: Outside places that a kind of article may name. The branch of an article picks one.
EXEMPT = [[], ["delhi", "new delhi", "ghaziabad", "noida", "uttar pradesh"], ["delhi", "new delhi"], ["delhi", "new delhi", "noida", "uttar pradesh"], ["delhi", "new delhi", "gurugram", "gurgaon", "noida"], ["delhi", "new delhi", "noida"], ["noida"]]

Layer = dict[str, Callable[[Column], Column]]


class Bound:
    """A struct of named values that grows by layers, each bound once."""

    def __init__(self, first: dict[str, Column]):
        self.names = list(first)
        self.column = F.struct(*[c.alias(n) for n, c in first.items()])

    def add(self, layer: Layer) -> Bound:
        old = list(self.names)
        self.column = F.transform(F.array(self.column), lambda r: F.struct(*[r[n].alias(n) for n in old], *[make(r).alias(n) for n, make in layer.items()]))[0]
        self.names += list(layer)
        return self


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def flags(pack: Pack, code: Column, extra: dict[str, Column]) -> Column:
    """The struct of all rules of an article whose city so far is ``code``."""
    outside = pack.outside
    left = [[k for k in outside if k not in exempt] for exempt in EXEMPT]
    own = [k for k in ("delhi", "new delhi", "noida", "ghaziabad", "uttar pradesh") if k in outside]

    def named(text: Column, branch: Column) -> Column:
        """Whether a text names a place that the branch doesn't exempt."""
        out = F.when(branch == 0, any_word(text, left[0]))
        for i in range(1, len(left)):
            out = out.when(branch == i, any_word(text, left[i]))
        return out

    def near(r: Column, codes: list[str]) -> Column:
        return _strings(codes)

    company_branch = lambda r: (
        F.when(r["fng"], 1)
        .when(r["jewar"], 3)
        .when(r["compare"], 4)
        .when(r["office"], 5)
        .when(r["corridor"] | r["connected"], 6)
        .when(r["region"] | r["home_corridor"], 2)
        .otherwise(0)
    )
    b = Bound({**articles.views(), "code": code, **extra})
    b.add(
        {
            "neg_p": lambda r: any_word(r["primary"], w.NEGATIVE_WORDS) | any_of(r["primary"], w.NEGATIVE_PHRASES),
            "neg_u": lambda r: any_word(r["url"], w.NEGATIVE_WORDS) | any_of(r["url"], w.NEGATIVE_PHRASES),
            "severe": lambda r: any_word(r["body"], w.SEVERE_WORDS) | any_of(r["body"], w.SEVERE_PHRASES),
            "target_pu": lambda r: any_word(r["pu"], pack.targets),
            "target_tu": lambda r: any_word(r["title_url"], pack.targets),
            "target_p": lambda r: any_word(r["primary"], pack.targets),
            "region": lambda r: r["pu"].rlike(REGION),
            "region_tu": lambda r: any_word(r["title_url"], ["ncr"]),
            "home_corridor": lambda r: any_word(r["search"], w.HOME_CORRIDORS),
            "growth": lambda r: any_of(r["pu"], w.GROWTH_SIGNALS),
            "market_signal": lambda r: any_of(r["pu"], w.MARKET_SIGNALS),
            "connectivity": lambda r: any_of(r["pu"], w.CONNECTIVITY_SIGNALS),
            "property": lambda r: any_of(r["pu"], w.PROPERTY_WORDS),
            "promo": lambda r: any_of(r["pu"], w.PROMOTION_SIGNALS),
            "maker": lambda r: any_of(r["pu"], w.COMPANY_NAMES),
            "phrase_pu": lambda r: any_of(r["pu"], w.NEGATIVE_PHRASES),
            "faridabad": lambda r: any_word(r["pu"], ["faridabad"]),
            "noida": lambda r: any_word(r["pu"], ["noida"]),
            "n_target": lambda r: mentions(r["search"], pack.targets),
            "n_outside": lambda r: mentions(r["search"], outside),
            "n_city": lambda r: F.array(*[mentions(r["search"], names) for _, names in pack.cities]),
            "body_target": lambda r: mentions(r["body"], pack.targets),
            "body_outside": lambda r: mentions(r["body"], outside),
            "body_own": lambda r: F.array(*[mentions(r["body"], [k]) for k in own]),
            "company": lambda r: _first([(any_word(r["search"], names), F.lit(i)) for i, (_, names) in enumerate(w.COMPANIES)]),
        }
    )
    b.add(
        {
            "clean_pu": lambda r: ~r["neg_p"] & ~r["neg_u"],
            "jewar": lambda r: r["faridabad"] & any_of(r["pu"], w.AIRPORT_SIGNALS) & r["growth"],
            "office": lambda r: r["region_tu"] & any_of(r["pu"], w.OFFICE_SIGNALS) & ~any_of(r["pu"], w.HOUSING_SALES),
            "has_a": lambda r: any_word(r["pu"], pack.names("gurugram")),
            "has_b": lambda r: any_word(r["pu"], pack.names("faridabad")),
            "explicit": lambda r: F.array_compact(F.array(*[F.when(any_word(r["primary"], names) | ((r["n_city"][i] >= 1) & (r["n_city"][i] == r["n_target"] + r["n_outside"])), F.lit(c)) for i, (c, names) in enumerate(pack.cities)])),
            "notice": lambda r: r["url"].rlike(r"hsvphry\.org\.in/documents/notices/news_") & any_word(r["primary"], ["faridabad"]) & any_of(r["primary"], w.NOTICE_WORDS) & ~any_of(r["primary"], w.NEGATIVE_PHRASES),
        }
    )
    b.add(
        {
            "clean": lambda r: r["clean_pu"] & ~r["severe"],
            "compare": lambda r: r["clean_pu"] & any_word(r["pu"], ["faridabad", "faridabads"]) & any_word(r["pu"], ["gurugram", "gurgaon", "noida"]) & r["property"] & (r["market_signal"] | r["growth"]),
            "fng": lambda r: r["clean_pu"] & r["faridabad"] & r["noida"] & any_word(r["pu"], ["ghaziabad"]) & r["connectivity"] & any_of(r["pu"], w.CORRIDOR_WORDS),
            "corridor": lambda r: any_of(r["pu"], w.TRANSIT_SIGNALS) & r["has_a"] & r["has_b"] & (r["noida"] | ((r["n_target"] >= 2) & (r["n_outside"] > 0) & (r["n_target"] / F.greatest(r["n_target"] + r["n_outside"], F.lit(1)) >= 0.67))),
            "connected": lambda r: r["clean_pu"] & (r["target_tu"] | r["region"] | r["jewar"]) & r["connectivity"] & any_of(r["pu"], w.CONNECTED_WORDS),
            "civic": lambda r: r["clean_pu"] & r["target_tu"] & any_of(r["pu"], w.CIVIC_WORKS) & any_of(r["pu"], w.CIVIC_ACTS) & ~r["phrase_pu"] & ~any_word(r["pu"], w.CIVIC_CRIMES),
            "authority": lambda r: (r["clean_pu"] | r["notice"]) & r["target_tu"] & any_of(r["pu"], w.AUTHORITY_SIGNALS) & any_of(r["pu"], w.AUTHORITY_WORDS),
        }
    )
    b.add(
        {
            "company_branch": company_branch,
            "branch": lambda r: F.when(r["fng"], 1).when(r["code"] == w.OPT_IN_CITY[0], 2).otherwise(company_branch(r)),
            "luxury": lambda r: r["clean"] & any_of(r["pu"], w.LUXURY_DEALS) & any_of(r["pu"], w.LUXURY_PROJECTS) & any_word(r["pu"], ["gurugram", "gurgaon"]),
        }
    )
    codes = [c for c, _ in w.COMPANIES]
    coded = lambda r: _first([(r["company"] == i, F.lit(c)) for i, c in enumerate(codes)])
    front = [k for k in outside if k not in ("delhi", "new delhi")]
    b.add({"out_pu": lambda r: named(r["pu"], r["branch"]), "out_company": lambda r: named(r["pu"], r["company_branch"]), "company_code": coded})
    b.add(
        {
            "market": lambda r: r["clean_pu"] & r["target_tu"] & r["property"] & r["market_signal"] & ~r["out_pu"],
            "company_cities": lambda r: (
                F.when(r["company"].isNull(), _strings([]))
                .when(F.size(r["explicit"]) > 0, r["explicit"])
                .when((r["company_code"] != "") & r["out_company"], _strings([]))
                .when((r["company_code"] == "") & any_word(r["pu"], front), _strings([]))
                .when((r["company_code"] == "") & any_word(r["pu"], w.FRONT_COMPANY) & any_of(r["pu"], w.FRONT_SIGNALS), near(r, pack.region_cities))
                .when((r["company_code"] == "") & r["region"], near(r, pack.region_cities))
                .when(r["company_code"] != "", F.array(r["company_code"]))
                .otherwise(_strings([]))
            ),
        }
    )
    b.add(
        {
            "confident": lambda r: r["clean_pu"] & (F.size(r["company_cities"]) > 0) & any_of(r["pu"], w.CONFIDENCE_SIGNALS) & any_of(r["pu"], w.BUSINESS_WORDS),
            "award": lambda r: r["clean_pu"] & (r["target_pu"] | (F.size(r["company_cities"]) > 0)) & r["maker"] & any_of(r["pu"], w.AWARD_WORDS) & any_of(r["pu"], w.AWARD_SUBJECTS),
        }
    )
    b.add({"blocked": lambda r: F.trim(r["title"]).isin(w.BLOCKED_TITLES) | r["primary"].rlike(DEVANAGARI) | (~r["award"] & (any_of(r["primary"], w.BLOCKED_TEXT) | any_of(r["url"], w.BLOCKED_LINKS)))})
    b.add({"corporate": lambda r: ~r["blocked"] & r["clean_pu"] & (F.size(r["company_cities"]) > 0) & any_of(r["pu"], w.PAY_SIGNALS) & ~r["out_pu"], "rera": lambda r: ~r["blocked"] & any_of(r["pu"], w.REGULATOR_WORDS)})
    b.add({"business": lambda r: r["corporate"] | r["confident"] | r["luxury"] | r["authority"] | r["connected"] | r["civic"] | r["market"]})
    b.add(
        {
            "evidence": lambda r: r["region"] | r["office"] | r["jewar"] | r["award"] | r["business"] | r["target_tu"],
            "specific": lambda r: r["corridor"] | r["office"] | r["jewar"] | r["fng"] | r["compare"] | r["award"] | r["market"] | r["business"] | any_of(r["pu"], w.PROJECT_SIGNALS),
        }
    )
    b.add(
        {
            "sector": lambda r: r["evidence"] & r["promo"] & (any_of(r["pu"], w.SECTOR_WORDS) | r["maker"]),
            "national": lambda r: ~r["blocked"] & r["evidence"] & r["promo"] & any_of(r["search"], w.COMPANY_NAMES) & any_of(r["search"], w.BUSINESS_SIGNALS) & ~named(r["title"], r["branch"]),
            "progress": lambda r: r["clean"] & r["evidence"] & r["promo"] & r["specific"] & any_of(r["pu"], w.PROGRESS_SIGNALS),
        }
    )
    exempted = lambda r: r["body_outside"] - _pick(r["branch"], [_sum([r["body_own"][own.index(k)] for k in e if k in own]) for e in EXEMPT])
    free = lambda r: r["corridor"] | r["office"] | r["jewar"] | r["compare"] | r["business"] | r["progress"]
    b.add(
        {
            "related": lambda r: ~r["blocked"] & (r["sector"] | r["national"] | r["office"] | r["compare"] | r["award"] | r["business"]),
            "court": lambda r: ~r["blocked"] & any_word(r["pu"], w.COURT_WORDS) & r["sector"],
            "broad": lambda r: ~(free(r) | r["market"]) & any_of(r["pu"], w.BROAD_SIGNALS) & ~r["specific"],
            "outside_primary": lambda r: ~(free(r) | r["connected"]) & (r["primary"].rlike(CAPITAL) | named(r["primary"], r["branch"])),
            "conflict": lambda r: ~(r["progress"] | (r["business"] & (r["target_tu"] | r["region"]))) & (r["out_pu"] | ((r["body"] != "") & (exempted(r) > 0) & (exempted(r) > r["body_target"] * 2))),
        }
    )
    b.add({"negative": lambda r: ~(r["jewar"] | r["progress"] | r["civic"] | r["notice"]) & (r["neg_p"] | r["neg_u"] | r["severe"] | r["rera"] | r["court"])})
    near_codes = _strings(["faridabad"] + ([w.OPT_IN_CITY[0]] if pack.opt_in else []))
    b.add(
        {
            "codes": lambda r: (
                F.when(~r["related"], _strings([]))
                .when(r["fng"], near_codes)
                .when(r["jewar"] | r["compare"], _strings(["faridabad"]))
                .when(r["company"].isNotNull() & (r["award"] | r["business"]), r["company_cities"])
                .when(r["office"], _strings(pack.region_cities))
                .when(F.size(r["explicit"]) > 0, r["explicit"])
                .when(r["region"], _strings(pack.region_cities))
                .otherwise(_strings([]))
            ),
            "label": lambda r: (
                F.when(r["negative"], "reject_negative")
                .when(r["office"], "ncr_office_market")
                .when(r["jewar"], "faridabad_jewar_catalyst")
                .when(r["corridor"], "target_corridor")
                .when(r["connected"], "connectivity_catalyst")
                .when(r["compare"], "positive_city_market")
                .when(r["authority"], "authority_pipeline")
                .when(r["luxury"], "luxury_transaction")
                .when(r["corporate"], "developer_corporate_positive")
                .when(r["confident"], "leadership_confidence")
                .when(r["award"], "project_development")
                .when(r["market"], "positive_city_market")
                .when(r["progress"] | (r["sector"] & r["specific"]), "project_development")
                .otherwise("unclassified")
            ),
        }
    )
    return b.column


def _first(cases: list[tuple[Column, Column]]) -> Column:
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out


def _pick(index: Column, values: list[Column]) -> Column:
    return _first([(index == i, v) for i, v in enumerate(values)])


def _sum(values: list[Column]) -> Column:
    total = F.lit(0)
    for v in values:
        total = total + v
    return total


def foreign(df: DataFrame) -> Column:
    """Whether an article's language isn't allowed."""
    whole = F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in ("title", "description", "articleText", "postedBy", "newsLink")])
    return whole.rlike(DEVANAGARI) | F.lower(whole).rlike(r"(?<![a-z0-9_])news in hindi(?![a-z0-9_])") | F.contains(F.lower(whole), F.lit("amarujala.com"))


def evaluate(df: DataFrame, pack: Pack, name: str = "rules") -> DataFrame:
    """df (articles) with the struct of all rules."""
    return df.withColumn(name, flags(pack, F.col("cityCode"), {"foreign": foreign(df)}))


def reasons(sent: Column, rules: str = "rules") -> Column:
    """Why an article isn't published, in order; empty if it is."""
    r = F.col(rules)
    city = F.col("cityCode") != ""
    missing, invalid = articles.missing_fields(), articles.invalid_urls()
    listed = F.array(
        F.when(r["blocked"], REASONS[1]),
        F.when(r["foreign"], REASONS[2]),
        F.when(r["negative"], REASONS[3]),
        F.when(~r["related"], REASONS[4]),
        F.when(r["related"] & ~r["specific"], REASONS[9]),
        F.when(r["broad"], REASONS[10]),
        F.when(~city, REASONS[5]),
        F.when(city & ~r["evidence"], REASONS[6]),
        F.when(r["outside_primary"], REASONS[7]),
        F.when(r["conflict"], REASONS[8]),
        F.when(city & (F.size(missing) > 0), F.concat(F.lit("filter 11: missing required fields ("), F.array_join(missing, ", "), F.lit(")"))),
        F.when(city & (F.size(invalid) > 0), F.concat(F.lit("filter 12: invalid URL fields ("), F.array_join(invalid, ", "), F.lit(")"))),
        F.when(sent, REASONS[13]),
    )
    return F.when((F.col("title") == "") | (F.col("newsLink") == ""), F.array(F.lit(REASONS[0]))).otherwise(F.array_compact(listed))


def near_miss(pack: Pack, why: Column, rules: str = "rules") -> Column:
    """Whether a rejected article looks like one that should have been published."""
    r = F.col(rules)
    has = lambda *ids: F.arrays_overlap(why, F.array(*[F.lit(REASONS[i]) for i in ids]))
    conflict = has(7, 8)
    city = F.col("cityCode") != ""
    strong = city & r["target_p"] & r["maker"]
    developer = (F.size(r["company_cities"]) > 0) & any_of(r["pu"], w.BUSINESS_WORDS)
    looks = (r["target_pu"] & (any_of(r["pu"], w.SECTOR_WORDS) | r["promo"] | r["maker"])) | r["maker"] | any_of(r["pu"], w.AUTHORITY_SIGNALS) | r["connectivity"] | any_of(r["pu"], w.LUXURY_PROJECTS)
    context = city | ((r["label"] != "unclassified") & developer)
    able = context & looks & ~r["blocked"] & ~r["foreign"] & ~r["negative"] & ~(conflict & ~strong)
    return able & (~r["label"].isin("unclassified", "reject_negative") | (has(4, 5, 6, 9, 10) & ~conflict))
