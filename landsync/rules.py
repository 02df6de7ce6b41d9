"""Rule tables: what is looked for on which provider's pages.

Adding a provider means adding rows here; the jobs do not change. All entries
are fixed values: results depend on their wording and order.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: provider dimension -------------------------------------
PROVIDERS = [
    # key, name, base_url, products_url, contact_phone, website
    ("AIA", "AIA Malaysia", "https://www.aia.com.my",
     "https://www.aia.com.my/en/our-products/health-protection/medical-protection.html",
     "1300-88-1318", "https://www.aia.com.my"),
    ("Prudential", "Prudential Malaysia", "https://www.prudential.com.my",
     "https://www.prudential.com.my/en/products-health-insurance/medical-plans/",
     "1300-88-7288", "https://www.prudential.com.my"),
    ("Allianz", "Allianz Malaysia", "https://www.allianz.com.my",
     "https://www.allianz.com.my/personal/life-health-and-savings/medical-and-hospitalisation.html",
     "1300-22-5542", "https://www.allianz.com.my"),
    ("GreatEastern", "Great Eastern Life", "https://www.greateasternlife.com",
     "https://www.greateasternlife.com/my/en/personal-insurance/our-products.html?category=corp-site%3Amy%2Fproduct-category%2Flife-and-health%2Fhealth-insurance&online=&gift=&keyword=",
     "1300-13-8338", "https://www.greateasternlife.com/my"),
    ("Etiqa", "Etiqa Insurance", "https://www.etiqa.com.my",
     "https://www.etiqa.com.my/health",
     "1300-13-8888", "https://www.etiqa.com.my"),
]
PROVIDER_COLUMNS = ["provider_key", "name", "base_url", "products_url", "contact_phone", "website"]

# Order in which providers are visited on the detailed path.
DETAIL_ORDER = ["AIA", "Allianz", "GreatEastern", "Etiqa", "Prudential"]

# --- Fixed values: plan-name rule -----------------------------------------
BLOCKED_NAME_PARTS = [
    "health protection", "medical protection", "life protection",
    "click", "read more", "learn more", "find out", "explore",
    "contact us", "about us", "about ", "home", "menu", "login", "register",
    "cookie", "privacy", "terms", "copyright", "footer", "header",
    "navigation", "search", "loading", "error", "submit", "subscribe",
    "today", "logo", "provider", "service company", "welcome",
    "vitality", "customer support", "road ranger", "auto assist",
    "cares", " has ", " we ", "support", "assist", "children &",
    "wellness", "how ", "what ", "why ", "when ", "where ",
    "knowledge hub", "insurance type", "insurance needs", "sign up",
    "sign in", "log in", "get quote", "view more", "view all",
    "download", "brochure", "pdf", "contact", "email", "phone",
    "follow us", "social", "facebook", "twitter", "instagram",
    "linkedin", "youtube", "sdn bhd", "berhad", "holdings",
    "services", "programme", "program", "healthiest", "campaign",
    "news", "article", "blog", "event", "promotion", "offer",
]
KNOWN_NAME_PREFIXES = [
    "pru", "aia ", "aia med", "allianz", "great ", "etiqa", "takaful", "medisafe",
    "supreme", "smart", "a-plus", "a-life", "critical", "hospital",
    "i-medik", "medical ez", "mediplus", "med insure", "med ",
    "onemedical", "one medical", "i-med", "ezy", "healthassured",
]

# --- Fixed values: headings on listing pages, in order of trust ------------
_CARDS = [
    ".product-card h2", ".product-card h3", ".product-card .title",
    ".product-item h2", ".product-item h3",
    "article h2", "article h3",
    "[class*='product'] h2", "[class*='product'] h3",
    ".card h3", ".card h2", ".card-title",
]
HEADING_SELECTORS = {
    "AIA": [
        ".product-card h2", ".product-card h3", ".product-card .title",
        ".product-item h2", ".product-item h3", ".product-item .title",
        "article h2", "article h3",
        "a[href*='health'] span", "a[href*='medical'] span",
        "[class*='product'] h2", "[class*='product'] h3",
        "h2.title", "h3.title",
        ".grid-item h3", ".list-item h3",
    ],
    "Prudential": _CARDS,
    "Allianz": [*_CARDS, "[data-product] h3", "[data-product] h2"],
    "GreatEastern": _CARDS,
    "Etiqa": _CARDS,
}

# --- Fixed values: plan names in running text, in order of trust -----------
BODY_NAME_PATTERNS = {
    "AIA": [
        r"(?U)A-(?:Plus|Life)\s+[A-Za-z]+(?:\s+[A-Za-z]+)?",
        r"(?U)AIA\s+(?:Medical|Health|Critical|Voluntary)[A-Za-z\s]*",
    ],
    "Prudential": [
        r"(?U)PRU[A-Z][a-zA-Z]+(?:\s+[A-Z][a-z]+)?(?:\s+[A-Z][a-z]+)?",
        r"(?U)Prudential\s+(?:BSN\s+)?[A-Z][a-zA-Z\s]+",
    ],
    "Allianz": [
        r"(?iU)Allianz\s+(?:Care|Health|Medi|Criti)[A-Za-z]*(?:\s+[A-Za-z]+)?",
        r"(?iU)MediSafe\s*(?:Infinite|Plus|Basic)?",
        r"(?iU)Hospital\s*(?:&|and)?\s*Surgical(?:\s+[A-Za-z]+)?",
    ],
    "GreatEastern": [
        r"(?iU)GREAT\s+(?:HealthCare|MediCash|Critical|Total|Life)[A-Za-z]*(?:\s+[A-Za-z]+)?",
        r"(?iU)Supreme\s+Health(?:\s+[A-Za-z]+)?",
        r"(?iU)SmartMedic(?:\s+[A-Za-z]+)?",
        r"(?iU)Great\s+(?:Care|Shield|Protect)[A-Za-z]*",
    ],
    "Etiqa": [
        r"(?iU)Medical\s+EZ(?:\s+[A-Za-z]+)?",
        r"(?iU)Takaful\s+Medi[A-Za-z]+(?:\s+[A-Za-z]+)?",
        r"(?iU)Etiqa\s+(?:Health|Family|Critical|Medi)[A-Za-z]*(?:\s+[A-Za-z]+)?",
        r"(?iU)i-Medik(?:\s+[A-Za-z]+)?",
    ],
}

# Names that only look like plans: (part, applies below this length).
FALSE_NAMES = {
    "Prudential": [("Prudential plc", None), ("Prudential BSN Takaful", None)],
    "Allianz": [("Allianz Malaysia", None), ("Allianz Customer", None)],
    "GreatEastern": [("Great Eastern", 20)],
    "Etiqa": [("Etiqa Insurance", None), ("Etiqa today", None)],
}

# --- Fixed values: coverage words and limit patterns -----------------------
COVERAGE_WORDS = {
    "outpatient_covered": ["outpatient", "out-patient", "clinic visit"],
    "maternity_covered": ["maternity", "pregnancy", "childbirth"],
    "dental_covered": ["dental", "teeth", "orthodontic"],
    "optical_covered": ["optical", "eye", "vision", "spectacles"],
    "mental_health_covered": ["mental health", "psychiatric", "psychology"],
}
LIMIT_PATTERNS = {
    "annual_limit": [
        r"(?U)annual\s+limit[:\s]+(?:rm\s*)?([0-9,.]+(?:\s*million)?)",
        r"(?U)yearly\s+limit[:\s]+(?:rm\s*)?([0-9,.]+(?:\s*million)?)",
        r"(?U)per\s+year[:\s]+(?:rm\s*)?([0-9,.]+(?:\s*million)?)",
    ],
    "lifetime_limit": [
        r"(?U)lifetime\s+limit[:\s]+(?:rm\s*)?([0-9,.]+(?:\s*million)?)",
        r"(?U)overall\s+limit[:\s]+(?:rm\s*)?([0-9,.]+(?:\s*million)?)",
    ],
    "room_board_limit": [
        r"(?U)room\s*(?:&|and)?\s*board[:\s]+(?:rm\s*)?([0-9,.]+)",
        r"(?U)daily\s+room[:\s]+(?:rm\s*)?([0-9,.]+)",
    ],
}

# --- Fixed values: eligible-age phrases, in order of trust -----------------
AGE_PATTERNS = {
    "AIA": [
        r"(?iU)Eligible\s+Age[:\s]+([^\n]+)",
        r"(?iU)Entry\s+Age[:\s]+([^\n]+)",
        r"(?iU)(\d+\s*(?:days?|months?|years?)\s*[-–]\s*\d+\s*(?:days?|months?|years?)\s*old)",
    ],
    "Allianz": [r"(?iU)(?:entry|eligible)\s+age[:\s]+([^\n]+)"],
    "GreatEastern": [r"(?iU)(?:entry|eligible|age)[:\s]+(\d+[^\.]+)"],
    "Etiqa": [r"(?iU)(?:entry|eligible|age)[:\s]+(\d+[^\.]+)"],
    "Prudential": [r"(?iU)(?:entry|eligible|age)[:\s]+(\d+[^\.]+)"],
}

# --- Fixed values: plan title and description on product pages -------------
TITLE_SELECTORS = {
    "AIA": ["h1.cmp-title__text", ".product-title h1", ".hero-title h1", "h1",
            ".product-name", "[class*='product-title']"],
}
DEFAULT_TITLE_SELECTORS = ["h1"]
# Providers whose titles read "plan | text | category".
BAR_TITLES = ["GreatEastern"]
# Providers whose plans may take their name from the URL.
URL_TITLES = ["AIA"]
# Providers whose plans are classified before they count.
CLASSIFIED = ["GreatEastern", "Etiqa"]

DESCRIPTION_SELECTORS = {
    "AIA": [".product-description p", ".hero-description", "article p",
            ".product-intro p", "main p"],
    "Allianz": [".product-description p", "article p"],
    "GreatEastern": [".product-description", "article p"],
    "Etiqa": [".product-description", ".hero-description"],
    "Prudential": [".product-description", "article p"],
}
# Providers whose description must be longer than this; else the last one tried stays.
DESCRIPTION_MIN_LENGTH = {"AIA": 30}
BENEFIT_SELECTORS = ["[class*='benefit']", "[class*='feature']"]


# --- Fixed values: product links -------------------------------------------
@dataclass(frozen=True)
class LinkRule:
    """One way to find product links.

    Either ``pattern`` (regex, group 1 is the link) or ``css`` is set. A link is
    kept if it holds every text of ``needs`` and none of ``skip``. With
    ``query`` "drop" links with a query string go, with "category" they stay
    only if they name a category. ``complete`` says which relative links get
    the base URL: "all", "slash" or "none".
    """

    pattern: str | None = None
    css: str | None = None
    needs: tuple[str, ...] = ()
    needs_any_case: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    skip_any_case: bool = False
    query: str = "keep"
    complete: str = "slash"


_AIA_SKIP = (
    "overview.html", "life-protection.html", "medical-protection.html",
    "critical-illness-protection.html", "lady-protection.html",
    "savings-and-investment.html", "retirement-protection.html",
    "health-protection.html", "employee-benefits.html",
)
_ALLIANZ_SKIP = (
    "medical-and-hospitalisation.html", "life-health-and-savings.html",
    "overview.html", "contact-us.html", "faq.html", "claims",
)
_ALLIANZ_OTHER_SECTIONS = (
    "/life-protection/", "/personal-accident/", "/savings-investments",
    "/critical-illness/", "/help-and-services/", "/a-z-reads/",
)
_GREAT_SKIP = ("our-products.html", "overview.html", "contact", "health-insurance.html")
_ETIQA_SKIP = ("health$", "contact", "faq", "claim")
_PRU_SKIP = (
    "/critical-illness", "/life-insurance", "/wealth-insurance",
    "/savings-investment", "newsroom", "announcements",
    "epay.", "partnersweb.", "claims-and-support",
)

LISTING_LINK_RULES = [LinkRule(css=css, complete="all") for css in (
    "a[href*='product']", "a[href*='health']", "a[href*='medical']",
    ".product-card a", ".product-item a", "article a",
)]
LISTING_LINK_CAP = 15
LISTING_VISIT_CAP = 5

DETAIL_LINK_RULES = {
    "AIA": [
        LinkRule(pattern=r'href="(/en/our-products/health-protection/[^"]+\.html)"', skip=_AIA_SKIP, query="drop"),
        LinkRule(pattern=r'href="(/en/our-products/life-protection/[^"]+\.html)"', skip=_AIA_SKIP, query="drop"),
        LinkRule(pattern=r'href="(/en/our-products/medical-protection/[^"]+\.html)"', skip=_AIA_SKIP, query="drop"),
        LinkRule(pattern=r'href="(/en/our-products/critical-illness-protection/[^"]+\.html)"', skip=_AIA_SKIP, query="drop"),
    ],
    "Allianz": [
        LinkRule(pattern=r'href="(/personal/life-health-and-savings/medical-and-hospitalisation/[^"]+\.html)"',
                 skip=_ALLIANZ_SKIP + _ALLIANZ_OTHER_SECTIONS, query="drop"),
        *[LinkRule(css=css, needs=("/medical-and-hospitalisation/",), skip=_ALLIANZ_SKIP)
          for css in (".product-card a", ".product-tile a", "[class*='product'] a",
                      ".card-body a")],
    ],
    "GreatEastern": [
        LinkRule(pattern=r'href="(https://www\.greateasternlife\.com/my/en/personal-insurance/our-products/health-insurance/[^"]+)"',
                 skip=_GREAT_SKIP, query="category"),
        LinkRule(pattern=r'href="(/my/en/personal-insurance/our-products/health-insurance/[^"]+)"',
                 skip=_GREAT_SKIP, query="category"),
        *[LinkRule(css=css, needs=("/health-insurance/",), skip=_GREAT_SKIP) for css in (
            "a[href*='great-health-direct']", "a[href*='great-medivalue']",
            "a[href*='great-medic-lite']", "a[href*='smart-health-protector']",
            "a[href*='smart-baby-shield']", "a[href*='smartmedic-shield']",
            "a[href*='/health-insurance/great-']", "a[href*='/health-insurance/smart-']",
            "a[href*='/health-insurance/'][href$='.html']")],
    ],
    "Etiqa": [
        *[LinkRule(pattern=p, skip=_ETIQA_SKIP, complete="all") for p in (
            r'href="(/health/[^"]+)"', r'href="(/v2/health/[^"]+)"',
            r'href="(/medical[^"]*)"',
            r'href="(https://www\.etiqa\.com\.my/[^"]*health[^"]*)"')],
        *[LinkRule(css=css) for css in (
            ".product-card a", ".plan-card a", "[class*='product'] a", "[class*='plan'] a")],
    ],
    "Prudential": [
        LinkRule(css=css, needs=("/products-riders/",), needs_any_case=("med",),
                 skip=_PRU_SKIP, skip_any_case=True)
        for css in ("[class*='card'] a[href*='/products-riders/']",
                    "a[href*='prumillion-med']", "a[href*='pruvalue-med']",
                    "[class*='card'] a")
    ],
}
DETAIL_LINK_CAPS = {"AIA": 20, "Allianz": 20, "GreatEastern": 25, "Etiqa": 20,
                    "Prudential": 10}

# --- Fixed values: brochure links, in order of trust -----------------------
# ("href", text in link) or ("text", text shown); the first anchor of each counts.
BROCHURE_RULES = {
    "AIA": [("href", ".pdf"), ("href", "brochure"), ("href", "product-brochure"),
            ("text", "Product brochure"), ("text", "Download brochure"), ("text", "PDF")],
    "Allianz": [("href", ".pdf"), ("text", "Brochure"), ("text", "Download"),
                ("text", "Product Disclosure")],
    "GreatEastern": [("href", ".pdf"), ("text", "Brochure"), ("text", "Product Summary"),
                     ("text", "Download")],
    "Etiqa": [("href", ".pdf"), ("text", "Brochure"), ("text", "Product Disclosure"),
              ("text", "Download")],
    "Prudential": [("href", ".pdf"), ("text", "Brochure"), ("text", "Product Summary"),
                   ("text", "Download")],
}
# Providers that take any link of these rules; the others need ".pdf" in it.
BROCHURE_ANY_LINK = ["AIA"]
BROCHURE_PAGE_PATTERNS = {
    "AIA": [
        r'(?i)href="(/content/dam/my[^"]*product-brochure[^"]*\.pdf)"',
        r'(?i)href="(/content/dam/my[^"]*brochure[^"]*\.pdf)"',
        r'(?i)href="(/content/dam/my-wise/[^"]*\.pdf)"',
    ],
}
BROCHURE_PAGE_SKIP = "pidm"

# --- Fixed values: classification by name ----------------------------------
CRITICAL_ILLNESS_NAMES = ["Critical Care", "Critical Relief", "Critical Illness"]
MEDICAL_NAMES = ["Medical", "MediCard", "MediValue", "Health Direct"]


@dataclass(frozen=True)
class RuleTable:
    """The rules of all providers, by provider key; providers with equal rules share one branch of a plan.

    ``rule_rows`` writes a table of rules as rows and ``read_rules`` reads it, so that a provider can be added
    by rows alone.
    """

    headings: dict[str, list[str]] = field(default_factory=lambda: HEADING_SELECTORS)
    body_names: dict[str, list[str]] = field(default_factory=lambda: BODY_NAME_PATTERNS)
    titles: dict[str, list[str]] = field(default_factory=lambda: TITLE_SELECTORS)
    detail_links: dict[str, list[LinkRule]] = field(default_factory=lambda: DETAIL_LINK_RULES)
    ages: dict[str, list[str]] = field(default_factory=lambda: AGE_PATTERNS)
    brochures: dict[str, list[tuple[str, str]]] = field(default_factory=lambda: BROCHURE_RULES)
    descriptions: dict[str, list[str]] = field(default_factory=lambda: DESCRIPTION_SELECTORS)
    page_brochures: dict[str, list[str]] = field(default_factory=lambda: BROCHURE_PAGE_PATTERNS)
    false_names: dict[str, list[tuple[str, int | None]]] = field(default_factory=lambda: FALSE_NAMES)
    least_descriptions: dict[str, int] = field(default_factory=lambda: DESCRIPTION_MIN_LENGTH)
    listing_links: list[LinkRule] = field(default_factory=lambda: LISTING_LINK_RULES)
    any_brochure: list[str] = field(default_factory=lambda: BROCHURE_ANY_LINK)
    bar_titles: list[str] = field(default_factory=lambda: BAR_TITLES)
    url_titles: list[str] = field(default_factory=lambda: URL_TITLES)
    classified: list[str] = field(default_factory=lambda: CLASSIFIED)
    visited: list[str] = field(default_factory=lambda: DETAIL_ORDER)


#: A rule as a row: ``kind`` is a field of ``RuleTable``, ``rank`` the place among the provider's rules of the
#: kind (or of the provider among those of a list), ``value`` the text looked for, ``flags`` the rest as JSON.
RULE_COLUMNS = "provider_key string, kind string, rank int, value string, flags string"
#: Rules that a table may have; they are read by the driver, as they become part of a plan.
MOST_RULES = 100_000
_TEXTS = ("headings", "body_names", "titles", "ages", "descriptions", "page_brochures")
_LISTS = ("any_brochure", "bar_titles", "url_titles", "classified", "visited")


def rows_of(table: RuleTable) -> list[tuple]:
    """The rules as tuples of ``RULE_COLUMNS``."""
    def link(rule: LinkRule) -> tuple[str, str]:
        flags = {k: v for k, v in asdict(rule).items() if k not in ("pattern", "css")}
        return rule.pattern or rule.css, json.dumps(flags | {"by": "pattern" if rule.pattern else "css"})

    out: list[tuple] = []
    for kind in _TEXTS:
        out += [(key, kind, i, v, None) for key, values in getattr(table, kind).items() for i, v in enumerate(values)]
    out += [(key, "detail_links", i, *link(r)) for key, links in table.detail_links.items() for i, r in enumerate(links)]
    out += [(None, "listing_links", i, *link(r)) for i, r in enumerate(table.listing_links)]
    out += [(key, "brochures", i, v, json.dumps({"in": where}))
            for key, values in table.brochures.items() for i, (where, v) in enumerate(values)]
    out += [(key, "false_names", i, v, json.dumps({"below": below}))
            for key, values in table.false_names.items() for i, (v, below) in enumerate(values)]
    out += [(key, "least_descriptions", 0, str(n), None) for key, n in table.least_descriptions.items()]
    for kind in _LISTS:
        out += [(key, kind, i, None, None) for i, key in enumerate(getattr(table, kind))]
    return out


def rule_rows(spark: SparkSession, table: RuleTable | None = None) -> DataFrame:
    return spark.createDataFrame(rows_of(table or RuleTable()), RULE_COLUMNS)


def read_rules(rows: DataFrame) -> RuleTable:
    """The rules that rows (see ``RULE_COLUMNS``) stand for."""
    found = rows.select("provider_key", "kind", "rank", "value", "flags").limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    by_key: dict[str, dict[str, list]] = {f.name: {} for f in fields(RuleTable)}
    for r in sorted(found, key=lambda r: (r["kind"], r["rank"], r["provider_key"] or "")):
        if r["kind"] not in by_key:
            raise ValueError(f"unknown kind of rule: {r['kind']}")
        flags = json.loads(r["flags"] or "{}")
        value = r["value"]
        if r["kind"].endswith("_links"):
            by = flags.pop("by")
            value = LinkRule(**{by: value}, **{k: tuple(v) if isinstance(v, list) else v for k, v in flags.items()})
        elif r["kind"] == "brochures":
            value = (flags["in"], value)
        elif r["kind"] == "false_names":
            value = (value, flags.get("below"))
        elif r["kind"] == "least_descriptions":
            value = int(value)
        by_key[r["kind"]].setdefault(r["provider_key"], []).append(value)
    out: dict[str, object] = dict(by_key)
    out["listing_links"] = by_key["listing_links"].get(None, [])
    out["least_descriptions"] = {k: v[0] for k, v in by_key["least_descriptions"].items()}
    for kind in _LISTS:
        out[kind] = list(by_key[kind])
    return RuleTable(**out)


def provider_table(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The provider dimension as a DataFrame; ``rows`` replaces the built-in set.

    Built from literals, so that Spark knows its size and broadcasts it.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(PROVIDER_COLUMNS, row)])
               for row in (PROVIDERS if rows is None else rows)]
    return spark.range(1).select(F.inline(F.array(*structs)))
