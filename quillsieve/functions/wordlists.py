"""Word lists and tables of the article rules.

FIXED VALUES: everything in this module must be as it is for right results. Lists are matched in
lower case; the order of the cities and companies counts.
"""

SOURCES = [
    "https://www.hindustantimes.com/real-estate", "https://www.hindustantimes.com/topic/faridabad/news",
    "https://economictimes.indiatimes.com/industry/services/property-/-cstruction",
    "https://economictimes.indiatimes.com/news/company/corporate-trends", "https://www.cnbctv18.com/real-estate/",
    "https://timesofindia.indiatimes.com/real-estate/news", "https://realty.economictimes.indiatimes.com/tag/gurugram",
    "https://realty.economictimes.indiatimes.com/tag/faridabad", "https://realty.economictimes.indiatimes.com/news/residential",
    "https://realty.economictimes.indiatimes.com/news/commercial", "https://realty.economictimes.indiatimes.com/news/infrastructure",
    "https://realty.economictimes.indiatimes.com/news/industry", "https://www.moneycontrol.com/news/business/real-estate/",
    "https://www.constructionworld.in/latest-construction-news/real-estate-news", "https://www.outlookmoney.com/topic/real-estate",
    "https://www.tribuneindia.com/topic/real-estate", "https://torbitrealty.com/category/news/city-updates/gurugram/",
    "https://indianinfrastructure.com/", "https://urbantransportnews.com/", "https://www.metrorailnews.in/", "https://themetrorailguy.com/",
    "https://news.railanalysis.com/", "https://www.delhimetrorail.com/", "https://ncrtc.in/", "https://realtynmore.com/latest-news/",
    "https://realtynxt.com/", "https://www.track2realty.track2media.com/", "https://propnewstime.com/", "https://hsvphry.org.in/",
    "https://www.bptp.com/media", "https://www.dlf.in/media", "https://m3mindia.com/media", "https://smartworlddevelopers.com/media",
    "https://www.signatureglobal.in/", "https://www.centralpark.in/media.php", "https://www.godrejproperties.com/media/press",
    "https://www.emaarindia.com/media/", "https://www.whitelandcorporation.com/", "https://maxestates.in/news_and_media",
    "https://www.birlaestates.com/media-centre.aspx", "https://www.puriconstructions.com/", "https://www.omaxe.com/", "https://www.rpsgroupindia.com/",
]
OPT_IN_SOURCES = [
    "https://realty.economictimes.indiatimes.com/tag/noida", "https://realty.economictimes.indiatimes.com/tag/greater%2Bnoida",
    "https://realty.economictimes.indiatimes.com/amp/tag/greater%2Bnoida", "https://realty.economictimes.indiatimes.com/tag/jewar",
    "https://realty.economictimes.indiatimes.com/tag/yamuna%2Bexpressway", "https://realty.economictimes.indiatimes.com/tag/noida%2Bairport",
    "https://realty.economictimes.indiatimes.com/tag/noida%2Bauthority", "https://realty.economictimes.indiatimes.com/tag/greater%2Bnoida%2Bauthority",
    "https://realty.economictimes.indiatimes.com/tag/yeida", "https://realty.economictimes.indiatimes.com/rss/residential",
    "https://realty.economictimes.indiatimes.com/rss/commercial", "https://realty.economictimes.indiatimes.com/rss/infrastructure",
    "https://realty.economictimes.indiatimes.com/rss/industry", "https://realty.economictimes.indiatimes.com/rss/regulatory",
    "https://www.hindustantimes.com/cities/noida-news", "https://www.hindustantimes.com/topic/noida/news",
    "https://www.hindustantimes.com/topic/greater-noida/news", "https://www.hindustantimes.com/topic/noida-authority/news",
    "https://www.hindustantimes.com/topic/greater-noida-authority/news", "https://www.hindustantimes.com/topic/yamuna-expressway/news",
    "https://www.hindustantimes.com/topic/jewar-airport/news", "https://www.hindustantimes.com/topic/yeida/news",
    "https://economictimes.indiatimes.com/industry/services/property-/-cstruction", "https://www.moneycontrol.com/news/business/real-estate/",
    "https://www.cnbctv18.com/real-estate/", "https://timesofindia.indiatimes.com/real-estate/news",
    "https://www.constructionworld.in/latest-construction-news/real-estate-news", "https://realtynmore.com/latest-news/", "https://realtynxt.com/",
    "https://propnewstime.com/", "https://www.track2realty.track2media.com/", "https://www.niairport.in/en/company/news/overview/news-overview",
    "https://www.yamunaexpresswayauthority.com/web/", "https://www.yamunaexpresswayauthority.com/web/announcement/", "https://gnida.up.gov.in/en/news",
    "https://gnida.up.gov.in/en/announcements", "https://www.atsgreens.com/blog", "https://www.mahagunindia.com/media", "https://countygroup.in/",
    "https://www.prateekgroup.com/blog", "https://www.gulshangroup.com/", "https://www.aba-corp.com/",
    "https://indianexpress.com/about/noida-authority/", "https://indianexpress.com/about/greater-noida-authority/",
    "https://timesofindia.indiatimes.com/city/noida",
]
HOME_CORRIDORS = [
    "dwarka expressway", "golf course road", "golf course extension road", "southern peripheral road", "spr",
]
TRANSIT_SIGNALS = [
    "dpr", "highway", "metro corridor", "ncrtc", "rapid rail", "regional rapid transit", "rrts", "namo bharat", "transit corridor",
]
OFFICE_SIGNALS = [
    "commercial leasing", "commercial office", "gross office leasing", "office leasing", "office market", "office space",
]
AIRPORT_SIGNALS = [
    "faridabad-jewar expressway", "jewar airport", "jewar expressway", "noida international airport",
]
GROWTH_SIGNALS = [
    "appreciation catalyst", "boom", "connectivity", "development", "growth", "infrastructure upgrades", "investor", "poised for rapid transformation",
    "real estate market", "transformation",
]
MARKET_SIGNALS = [
    "demand remains resilient", "drives ncr housing market", "emerges as a strong real estate destination", "growth market", "housing demand",
    "housing market", "homebuyers are looking beyond", "infrastructure inflection", "investment destination", "largest market", "office market",
    "office stock", "market remains resilient", "property market", "real estate destination", "real estate growth", "real estate hierarchy",
    "real estate market", "premium housing market", "redefining ncr", "strong real estate destination",
]
REGULATOR_WORDS = [
    "rera", "hrera", "h-rera", "real estate regulatory authority",
]
COURT_WORDS = [
    "court", "supreme court", "high court", "tribunal", "nclt", "nclat", "case", "cases", "litigation", "order", "judgment", "judgement", "plea",
    "petition",
]
SECTOR_WORDS = [
    "affordable housing", "apartment", "appreciation", "approval", "builder", "carpet area", "commercial property", "commercial real estate",
    "connectivity", "corridor", "developer", "development", "development authority", "dlf", "dwelling", "expressway", "flat", "floor",
    "growth corridor", "highway", "homebuyer", "homebuyers", "housing", "infra", "infrastructure", "investment", "inaugurated", "land parcel",
    "launch", "launched", "launches", "lease", "luxury housing", "luxury homes", "master plan", "metro", "new project", "new project launch",
    "office space", "price appreciation", "plot", "possession", "project", "property", "rapid rail", "real estate", "realty", "redevelopment",
    "registry", "residential", "rrts", "sector", "stamp duty", "township", "transit-oriented development",
]
PROMOTION_SIGNALS = [
    "affordable housing", "appreciation", "approval", "approved", "allotment", "allotments", "bookings", "customer confidence", "commercial property",
    "commercial real estate", "completion", "connectivity", "corridor", "delivered", "delivery", "develop", "developed", "developer", "development",
    "expansion", "expressway", "earnings", "growth", "growth corridor", "highway", "housing", "infra", "infrastructure", "inaugurated", "investment",
    "launch", "launched", "launches", "luxury housing", "luxury homes", "luxury living", "metro", "new project", "new project launch", "ncrtc",
    "premium housing", "premium housing market", "office space", "possession", "profit", "net profit", "price appreciation", "project", "rapid rail",
    "real estate", "realty", "redevelopment", "regional rapid transit", "residential", "results", "revenue", "rrts", "sales", "township",
]
COMPANY_NAMES = [
    "dlf", "dlf homes", "dlf ltd", "bptp", "bptp ltd", "godrej properties", "lodha", "macrotech", "prestige estates", "brigade enterprises", "sobha",
    "oberoi realty", "phoenix mills", "signature global", "anant raj", "eldeco", "ashiana housing", "kolte-patil", "mahindra lifespace", "m3m",
    "raymond realty", "smartworld", "elan", "whiteland", "tulip", "tulip group", "central park", "emaar india", "emaar", "omaxe", "puri constructions",
    "puri", "rps", "srs",
]
BUSINESS_SIGNALS = [
    "q1", "q2", "q3", "q4", "quarter", "quarterly", "net profit", "profit", "revenue", "sales", "pre-sales", "presales", "booking", "bookings",
    "earnings", "results", "ipo", "shares", "stock", "market cap", "fundraise", "fund raising", "investment", "acquisition", "merger",
]
PAY_SIGNALS = [
    "chairman", "ceo", "compensation", "fy", "pay", "remuneration", "salary",
]
CONFIDENCE_SIGNALS = [
    "aims to create", "chairman", "ceo", "managing director", "md", "growth market", "market expansion", "scouts land", "scouting land",
    "plans new launches", "plans launches", "launch pipeline", "new launches", "offering", "core growth market", "as important as", "bets big",
    "customer confidence", "top developer", "top developers",
]
LUXURY_DEALS = [
    "apartment purchase", "apartments", "buys", "bought", "crore apartment", "luxury apartment", "luxury apartments", "premium apartment",
    "record deal", "transaction",
]
LUXURY_PROJECTS = [
    "the dahlias", "dlf dahlias", "the camellias", "dlf camellias", "the arbour", "dlf arbour", "the magnolias", "dlf magnolias", "three sixty north",
    "360 north",
]
AUTHORITY_SIGNALS = [
    "commercial auction", "commercial sites", "demarcation", "development authority", "gnida", "hsvp", "huda", "mixed land use", "mixed-use policy",
    "new commercial sites", "noida authority", "plot scheme", "plots", "sector demarcation", "social infrastructure", "tod",
    "transit-oriented development", "yeida",
]
CONNECTIVITY_SIGNALS = [
    "connectivity catalyst", "expressway", "interchange", "jewar connectivity", "noida airport", "noida international airport", "metro corridor",
    "metro extension", "metro line", "spr", "southern peripheral road", "golf course extension road", "golf course road", "dwarka expressway",
    "sohna road", "faridabad-noida-ghaziabad", "fng corridor",
]
PROJECT_SIGNALS = [
    "acquires land", "adds new inventory", "allotment", "allotments", "auction", "airport-linked", "authority hq", "branded residences",
    "charging stations", "commercial project", "commercial sites", "commercial plot", "commercial plots", "industrial project", "industrial projects",
    "develop land", "developed a residential", "developing a residential", "development project", "development of the year", "dwarka expressway",
    "golf course extension road", "golf course road", "gurugram project", "group housing project", "hand over", "hands over", "housing project",
    "industrial plots", "inaugurate noida authority hq", "inaugurates noida authority hq", "investment board", "investment board nod", "kiosks",
    "landmark high-rise development", "first gurugram project", "first faridabad project", "bookings worth", "land acquisition", "land parcel",
    "land rates", "luxury project", "new benchmark", "hospitality living", "metro extension", "metro line", "metro corridor approval", "metro station",
    "given approval from central body", "mixed-use development", "new commercial sites", "new noida", "new project", "faridabad project",
    "new real estate projects", "noida project", "noida projects", "plot rates", "plot scheme", "plots off noida airport", "plotted township",
    "premium housing market", "property hotspot", "pumped into new real estate projects", "steel span", "possession", "project launch", "rapid rail",
    "real estate projects", "regional rapid transit", "rrts", "projects worth", "residential development", "residential project", "retail project",
    "records", "records sales", "sector demarcation", "social infrastructure", "sports complex", "sold out", "township", "tod",
    "transit-oriented development", "traffic booths", "ultra-luxury residences", "unveils homes", "unveils luxury", "unveils project",
    "unveils residential", "unveils township",
]
BROAD_SIGNALS = [
    "across india", "all about", "amid global uncertainty", "annual report", "buyers should know", "calculator", "cities where", "company update",
    "demand to remain", "earnings call", "explained", "global uncertainty", "housing data", "housing demand", "housing market recovery",
    "india's housing", "india’s housing", "india's office leasing", "india’s office leasing", "looking to buy a home", "marketing spends",
    "market recovery", "market report", "markets", "office leasing", "pan india", "pan-india", "quarterly update", "q1 fy", "q2 fy", "q3 fy", "q4 fy",
    "recovery", "records sales", "retail expansion", "retail sector", "sales dip", "sales fall", "sales value", "sector records",
    "what buyers should know", "what the housing data suggests", "consider these four options",
]
BLOCKED_TEXT = [
    "about us", "admission", "admissions", "actor", "actress", "advertise", "air monitor", "air monitors", "appoints", "appointed", "across india",
    "aravali", "awards", "brand awareness", "business head", "built-up areas", "caqm", "careers", "college", "conference", "contact us",
    "digital branding", "education & careers", "ecological stress", "environment", "expo", "fish death", "fish deaths", "gallery",
    "global disruptions", "grievance", "grievance redressal", "integrated campaigns", "looking to buy a home", "login", "marketing spends",
    "newsletter", "names", "nationwide", "panel", "pan india", "pan-india", "pollution", "photo gallery", "photos", "privacy policy", "preity zinta",
    "register", "school", "sewage", "spring effect", "survey", "traffic jam", "subscription", "terms of use", "consider these four options",
    "ug admission", "video", "videos", "virtual engagement", "water pipeline", "water supply", "waterbody", "webinar",
]
BLOCKED_TITLES = [
    "bbd gurgaon", "commercial projects", "latest news", "online allotte payment services", "real estate news", "terms of use",
]
BLOCKED_LINKS = [
    "/about", "/advertise", "amarujala.com", "/awards", "/campaign", "/career", "/category/commercial", "/conference", "/contact", "/citizen-services",
    "/education", "/event", "/gallery", "/login", "/newsletter", "/payment", "/photo", "/photos", "/privacy", "/register", "/subscription", "/terms",
    "unauthorised-pg", "unauthorised-pgs", "unauthorized-pg", "unauthorized-pgs", "/video", "/videos", "/webinar",
]
NEGATIVE_WORDS = [
    "accident", "accused", "alert", "arrest", "arrested", "assault", "attack", "barred", "banned", "bankruptcy", "body found", "boycott",
    "built-up areas", "caqm", "cancel", "canceled", "cancelled", "cheated", "cheating", "collapse", "complaint", "complaints", "crime", "criminal",
    "crisis", "crash", "detour", "debarred", "demolish", "demolished", "demolition", "diesel", "death", "dead", "default", "defaults", "delay",
    "delayed", "delays", "demolition death", "dies", "died", "dispute", "disputes", "dues", "encroachment", "eviction", "fir", "fine", "fined",
    "fish deaths", "fraud", "frauds", "grievance", "grievances", "grap", "genset", "generator", "hospital", "illegal", "imd", "injured", "jail",
    "killed", "lawsuit", "legal", "litigation", "murder", "notice", "notices", "penalty", "police", "pollution", "powercut", "protest", "protests",
    "rain", "rainfall", "rape", "raid", "raided", "revoked", "scam", "sc-appointed", "sealed", "seized", "shooting", "stalled", "stranded", "strike",
    "summon", "summoned", "steep hike", "stuck", "suicide", "suicides", "tax hike", "thunderstorm", "threat", "unable", "unpaid", "violation",
    "violations", "violence", "weather", "yellow alert", "worries", "worry",
]
NEGATIVE_PHRASES = [
    "accused of", "bear the brunt", "broken roads", "builder arrested", "builder suicide", "market crash", "buyers stranded", "caqm pollution",
    "cheated homebuyers", "circle rates surge", "construction ban", "construction halted", "construction stopped", "diesel bulk buying",
    "died by suicide", "dies by suicide", "director arrested", "eow complaint", "fraud case", "homebuyer complaint", "homebuyers bear the brunt",
    "homebuyers stranded", "homebuyer suicide", "housing project halted", "housing project suspended", "imd data", "left in lurch", "licence lapses",
    "license lapses", "missing links", "murdered over property", "not new claims", "payment default", "power backup", "power backup worries",
    "power outage", "power supply issue", "poor upkeep", "pre-sales decline", "pre-sales drop", "presales decline", "presales drop",
    "policy remains constrained", "property sales barred", "property tax", "property dispute murder", "property registration crisis",
    "property registration stuck", "project delayed", "project delay", "project halted", "project stalled", "project stuck", "project suspended",
    "rera complaint", "rera order", "rera penalty", "sc-appointed panel", "seal properties", "auction assets", "grap challan", "grap challans",
    "short circuit", "registry stalled", "registration stalled", "real estate agent killed", "real estate broker killed", "sales decline",
    "sales drop", "strike hits", "suicide due to property", "suicide over property", "traffic jam", "seven km detour", "water pipeline",
    "yellow alert",
]
SEVERE_WORDS = [
    "accident", "arrest", "arrested", "assault", "attack", "body found", "cheated", "cheating", "collapse", "crime", "criminal", "death", "dead",
    "dies", "died", "fir", "fire", "fraud", "injured", "jail", "killed", "murder", "police", "rape", "scam", "shooting", "suicide", "violence",
]
SEVERE_PHRASES = [
    "builder arrested", "builder suicide", "died by suicide", "dies by suicide", "director arrested", "fraud case", "homebuyer suicide",
    "murdered over property", "property dispute murder", "real estate agent killed", "real estate broker killed", "short circuit",
    "suicide due to property", "suicide over property", "unauthorised pg", "unauthorised pgs", "unauthorized pg", "unauthorized pgs",
    "unfulfilled promises",
]
OUTSIDE_PLACES = [
    "ahmedabad", "andhra", "bengaluru", "bangalore", "bengal", "bhopal", "bhubaneswar", "bihar", "bombay", "chandigarh", "chennai", "coimbatore",
    "delhi", "goa", "gujarat", "ghaziabad", "haridwar", "hyderabad", "indore", "jaipur", "kerala", "kolkata", "lucknow", "maharashtra", "mumbai",
    "new delhi", "noida", "greater noida", "pallikaranai", "patna", "pilkhuwa", "perumbakkam", "perungudi", "phuket", "pune", "rajasthan", "singapore",
    "tamil nadu", "telangana", "uttar pradesh",
]
BLOCKED_SOURCES = [
    "aninews.in", "content.magicbricks.com", "financialexpress.com/about/real-estate", "business-standard.com/search",
    "hindustantimes.com/cities/gurugram-news", "lokmattimes.com", "rprealtyplus.com", "99acres.com/articles",
    "timesofindia.indiatimes.com/city/gurgaon", "timesofindia.indiatimes.com/city/faridabad", "tribuneindia.com/news/haryana",
    "indianexpress.com/section/cities/delhi", "thehindu.com/news/cities/delhi", "amarujala.com",
]
# city, then its names; the third one takes part only if opted in.
CITIES = [
    ("faridabad", ["faridabad", "faridabads", "greater faridabad", "neharpar", "skynest", "skynest towers"]),
    ("gurugram", ["gurugram", "gurgaon", "dwarka expressway", "downtown 66", "golf course road", "golf course extension road", "manesar", "manasar",
                  "pataudi", "patudi", "patodi", "southern peripheral road", "spr", "sohna", "sohna road"]),
]
OPT_IN_CITY = ("noida", ["noida", "greater noida", "greater noida west", "noida extension", "new noida", "jewar", "jewar airport", "noida airport",
                         "noida international airport", "yamuna expressway", "yeida"])
OPT_IN_NOT_OUTSIDE = ["greater noida", "noida", "uttar pradesh"]
REGION_NAMES = ["delhi ncr"]
REGION_CITIES = ["gurugram", "faridabad"]
# city of a company ("": none of its own), then its names; the first match counts.
COMPANIES = [
    ("gurugram", ["dlf", "dlf homes", "dlf ltd"]),
    ("", ["bptp", "bptp ltd"]),
    ("gurugram", ["m3m", "signature global", "smartworld", "elan", "whiteland", "tulip", "tulip group", "central park", "emaar india", "emaar"]),
    ("faridabad", ["omaxe", "puri", "puri constructions", "rps", "srs"]),
]
FRONT_COMPANY = ["bptp", "bptp ltd"]
FRONT_SIGNALS = ["customer confidence", "top developer", "top developers"]
HOUSING_SALES = ["housing sales", "housing demand", "residential sales", "home sales"]
PROPERTY_WORDS = ["real estate", "realty", "property", "housing"]
BUSINESS_WORDS = ["real estate", "realty", "developer", "project", "launch", "land", "market"]
AUTHORITY_WORDS = ["development", "commercial", "infrastructure", "sector", "mixed-use", "tod"]
NOTICE_WORDS = ["auction", "demarcation", "e-auction", "commercial", "community", "infrastructure", "sector", "sites"]
CONNECTED_WORDS = ["connectivity", "development", "growth", "real estate", "property", "infrastructure"]
CORRIDOR_WORDS = ["connectivity", "corridor", "development", "growth", "infrastructure", "real estate"]
CIVIC_WORKS = ["authority hq", "charging stations", "industrial projects", "kiosks", "metro station", "sports complex"]
CIVIC_ACTS = ["add", "allot", "building", "emerges", "inaugurate", "launch", "project", "spend"]
CIVIC_CRIMES = ["accident", "arrest", "chargesheet", "crime", "fraud", "illegal", "murder", "police", "suicide"]
AWARD_WORDS = ["award", "awards", "wins", "won"]
AWARD_SUBJECTS = ["development", "housing", "project", "real estate", "realty", "residential"]
PROGRESS_SIGNALS = ["approved", "approves", "approval", "allotment", "allotments", "bookings worth", "first faridabad project", "first gurugram project",
                    "faridabad project", "gdv", "gurugram project", "noida project", "invest", "investment", "joint development", "launches",
                    "property hotspot", "records", "records sales", "reports bookings", "residential project", "sold out", "traffic booths",
                    "worth rs", "worth ₹"]
REQUIRED_FIELDS = ["title", "description", "cityCode", "newsLink", "thumbnailImage", "postedBy", "createdAt", "postedByLogo"]
URL_FIELDS = ["newsLink", "thumbnailImage", "postedByLogo"]
PLACEHOLDERS = ["your description", "description", "article description", "news description"]
PUBLISHERS = {
    "business-standard.com": "Business Standard", "cnbctv18.com": "CNBC TV18", "hindustantimes.com": "Hindustan Times",
    "moneycontrol.com": "Moneycontrol", "outlookmoney.com": "Outlook Money", "propnewstime.com": "Prop News Time",
    "realtynmore.com": "RealtyNMore", "torbitrealty.com": "Torbit Realty", "tribuneindia.com": "The Tribune",
}
DEVELOPER_PUBLISHERS = {
    "dlf.in": "DLF Media", "m3mindia.com": "M3M Media", "smartworlddevelopers.com": "Smartworld Media",
    "signatureglobal.in": "Signature Global Media", "centralpark.in": "Central Park Media",
}
DEVELOPER_PATHS = {"dlf.in": "/media", "m3mindia.com": "/media", "smartworlddevelopers.com": "/media", "signatureglobal.in": "/", "centralpark.in": "/media.php"}
PAGED_HOSTS = ["torbitrealty.com", "realtynmore.com", "realtynxt.com", "www.track2realty.track2media.com", "propnewstime.com"]
BLOCKED_PATHS = ["/about", "/about-us", "/career", "/careers", "/contact", "/privacy", "/terms", "/project/", "/projects/", "/properties/",
                 "/residential-project", "/commercial-project"]
ALLOWED_HINTS = ["announcement", "blog", "circular", "feed", "infrastructure", "insight", "investor", "latest", "market-report", "media", "news",
                 "notification", "press", "property", "real-estate", "report", "research", "rss", "sitemap", "tender", "topic", "xml"]
ROOT_SOURCES = ["Construction World", "Economic Times Realty", "PropNewsTime", "RealtyNXT", "Realty Plus", "Ten News", "The Property Times", "The Realty Today"]
# pattern over a URL's path, kind of page; the first match counts.
PAGE_KINDS = [
    ("rss|feed", "RSS Feed"), ("sitemap", "News Sitemap"), ("xml|atom", "XML Feed"), ("tender", "Tender"), ("circular", "Circular"),
    ("notification", "Notification"), ("announcement", "Announcement"), ("investor", "Investor News"), ("research|insight", "Research"),
    ("report", "Market Reports"), ("press", "Press Release Archive"), ("media", "Media Centre"), ("blog", "Official Blog"),
    ("city|cities|gurugram|gurgaon|faridabad|noida", "City News"), ("infrastructure", "Infrastructure News"), ("property", "Property Section"),
    ("real-estate|realty", "Real Estate Section"), ("news", "News Category"),
]
REJECTED_IMAGES = (
    "1x1|artshare|blank|placeholder|spacer|logo|icon|avatar|favicon|advertise|banner|copylink|flipcoin|youtube|ytimg|playstore|app store|social|"
    "facebook|instagram|whatsapp|linkedin|loader|buffering"
)
