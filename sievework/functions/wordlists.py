"""The word lists, maps and limits that the curation rules are defined by."""

from __future__ import annotations

# Titles out of scope, matched at word boundaries.
JUNIOR_WORDS = ["junior", "intern", "internship", "entry level", "entry-level", "trainee", "apprentice"]

# Title patterns that are noise whatever the company.
NOISE_TITLES = [
    r"street team", r"forum (coordinator|moderator)", r"community moderat\w*", r"content moderat\w*", r"brand ambassador", r"promotional? staff",
    r"customer (service|support) (rep|representative|agent)s?", r"call cent(er|re)", r"retail (associate|assistant)", r"cashier",
    r"merchandis(er|ing) assistant", r"warehouse (operative|assistant)",
]

# Article topics that are noise, and signals that save an article.
NOISE_TOPICS = [
    "cooking", "recipe", "fashion", "weather", "traffic", "property prices", "mortgage", "planning permission", "criminal", "court case", "politics",
    "election", "budget",
]
SALVAGE_SIGNALS = [
    "sport", "tech", "startup", "ireland", "irish", "digital", "data", "fitness", "health", "performance", "innovation", "funding", "investment",
    "launch", "raises", "award", "summit", "conference",
]

# Places that count as eligible, ambiguous or rejected.
ELIGIBLE = [
    "dublin", "cork", "galway", "limerick", "belfast", "waterford", "kilkenny", "newry", "ireland", "irish", ", ie", "co. ",
    "skerries", "skibbereen", "navan", "swords", "castlebar", "carlow", "cavan", "sixmilebridge", "sandyford", "castleknock", "killarney",
    "donegal", "dundalk", "enniscorthy", "louth", "ennis", "scarriff",
    "remote - emea", "remote - europe", "remote - eu", "remote emea", "remote europe",
]
ELIGIBLE_WIDE = [
    "dublin", "cork", "galway", "limerick", "waterford", "kilkenny", "ireland", "irish", ", ie", "co. ",
    "skerries", "skibbereen", "navan", "swords", "castlebar", "carlow", "cavan", "sixmilebridge", "sandyford", "castleknock", "killarney",
    "donegal", "dundalk", "enniscorthy", "louth", "ennis", "scarriff",
    "belfast", "newry", "derry", "londonderry", "antrim", "northern ireland",
    "london", "leeds", "manchester", "birmingham", "edinburgh", "glasgow", "bristol", "sheffield", "liverpool", "newcastle", "cardiff",
    "uk", "united kingdom", "england", "scotland", "wales",
    "remote - uk", "remote - emea", "remote - europe", "remote - eu", "remote emea", "remote europe",
]
MANY_PLACES_REJECT = ["multiple locations", "multiple cities", "various locations"]
MANY_PLACES_PENDING = ["locations", "multiple"]
REJECTED = [
    "remote - us", "remote - usa", "remote - canada", "remote - latam", "remote - apac", "remote - anz", "remote - uk", "remote - ukraine",
    "remote - bulgaria", "remote ca",
    "united states", ", usa",
    ", ma", ", ny", ", ca", ", tx", ", wa", ", il", ", ne", ", nc", ", fl", ", ga", ", oh", ", pa", ", nj", ", az", ", or", ", id", ", nh", ", wv",
    ", nv", ", me", ", ky", ", tn", ", mn", ", mo", ", va", ", md", ", sc", ", la", ", al", ", co",
    "boston", "los angeles", "new york", "san francisco", "chicago", "seattle", "austin", "nashville", "denver", "atlanta", "raleigh", "las vegas",
    "pueblo", "boise", "tempe", "portland", "sacramento", "bakersfield", "chico", "oroville", "susanville", "richvale", "redding", "jackson, c",
    "tracy, c", "eureka, c", "noblesville", "lincoln, ne", "omaha", "mercer island", "redwood city", "miami", "dallas", "kansas city",
    "north andover", "newburgh", "nashua", "north berwick", "white hall", "reynoldsburg",
    "london", "manchester", "edinburgh", "united kingdom", "england",
    "strava sf", "strava berlin", "strava london", "strava paris",
    "sofia", "plovdiv", "tel aviv", "barcelona", "berlin", "paris", "amsterdam", "madrid", "tallinn", "estonia", "belgium", "netherlands",
    "den bosch", "chiavari", "singapore", "shanghai", "guangzhou", "beijing", "tokyo", "japan", "korea", "seoul", "india", "mumbai", "jakarta",
    "indonesia", "philippines", "manila", "sydney", "melbourne", "australia", "canada", "colombia", "doha", "dubai", "abu dhabi", "ukraine",
    "bulgaria",
]
REJECTED_WIDE = [
    "remote - us", "remote - usa", "remote - canada", "remote - latam", "remote - apac", "remote - anz", "remote - ukraine",
    "remote - bulgaria", "remote ca",
    "united states", ", usa",
    ", ma", ", ny", ", ca", ", tx", ", wa", ", il", ", ne", ", nc", ", fl", ", ga", ", oh", ", pa", ", nj", ", az", ", or", ", id", ", nh", ", wv",
    ", nv", ", me", ", ky", ", tn", ", mn", ", mo", ", va", ", md", ", sc", ", la", ", al", ", co",
    "boston", "los angeles", "new york", "san francisco", "chicago", "seattle", "austin", "nashville", "denver", "atlanta", "raleigh", "las vegas",
    "pueblo", "boise", "tempe", "portland", "sacramento", "bakersfield", "chico", "oroville", "susanville", "richvale", "redding", "jackson, c",
    "tracy, c", "eureka, c", "noblesville", "lincoln, ne", "omaha", "mercer island", "redwood city", "miami", "dallas", "kansas city",
    "north andover", "newburgh", "nashua", "north berwick", "white hall", "reynoldsburg",
    "strava sf", "strava berlin", "strava paris",
    "sofia", "plovdiv", "tel aviv", "barcelona", "berlin", "paris", "amsterdam", "madrid", "tallinn", "estonia", "belgium", "netherlands",
    "den bosch", "chiavari", "singapore", "shanghai", "guangzhou", "beijing", "tokyo", "japan", "korea", "seoul", "india", "mumbai", "jakarta",
    "indonesia", "philippines", "manila", "sydney", "melbourne", "australia", "canada", "colombia", "doha", "dubai", "abu dhabi", "ukraine",
    "bulgaria",
]
OFFICE_ELIGIBLE = ["ireland", " ie", "-ie", "dublin", "limerick", "cork", "galway", "belfast", "waterford", "kilkenny", "derry", "londonderry"]
OFFICE_BRITAIN = [
    " uk", "-uk", "united kingdom", "england", "scotland", "wales", "london", "leeds", "manchester", "birmingham", "edinburgh", "glasgow", "bristol",
    "sheffield", "liverpool", "newcastle", "cardiff",
]
OFFICE_REJECTED = [
    " ma", " ny", " ca", " tx", " fl", " wa", " il", " nv", " co", " az", " nc", " ne", " id", " ut", " oh", " mi", " pa", " ga", " va", " md", " or",
    " wi", " mn", " mo", " in", " tn", " ky", "boston", "chicago", "austin", "new york", "los angeles", "san francisco", "denver", "remote bulgaria",
    "sofia", "plovdiv", " bg", "china", "shanghai", "guangzhou", "singapore", "korea", "seoul", "jakarta", "sydney", "doha", "qatar", "dubai",
    "spain", "barcelona", "madrid", "germany", "berlin", "belgium", "netherlands", "colombia", "medellin", "gibraltar", "usa",
]

# Location filters of the digest and of board results.
DIGEST_EXCLUDE = ["boston", "new york", "nyc", "united states", " us,", "(us)", "texas", "california", "chicago", "remote (us)"]
DIGEST_INCLUDE = ["ireland", "dublin", "cork", "galway", "limerick", "belfast", "waterford", "remote", "hybrid"]
BOARD_EXCLUDE = ["boston", "new york", "london", "remote (us)", "united states", " us,", ", us ", "nyc"]
BOARD_INCLUDE = ["ireland", "dublin", "cork", "galway", "limerick", "belfast", "waterford", "remote"]
BOARD_KEYWORDS = ["sport", "athletic", "fitness", "stadium", "fan", "esport", "gaming", "performance", "wearable", "health tech"]

# Terms of the relevance score.
SCORE_KEYWORDS = [
    "software", "engineer", "developer", "data", "analytics", "product", "design", "technology", "digital", "tech", "app", "mobile", "web", "platform",
    "cloud", "devops", "backend", "frontend", "full stack", "fullstack", "machine learning", "ai", "artificial intelligence", "python", "java",
    "javascript", "react", "node", "api", "database", "sql", "aws", "azure", "infrastructure", "security", "ux", "ui", "designer", "product manager",
    "scrum", "agile", "qa", "testing", "performance", "wearable", "sports science", "athlete", "coaching", "training", "fitness", "health", "wellness",
    "biometric", "sensor", "tracking", "gps",
]
SCORE_STRONG = [
    "software engineer", "data scientist", "product manager", "tech lead", "engineering manager", "developer", "programmer", "architect", "devops",
    "machine learning", "data engineer", "backend", "frontend", "full stack",
]
SCORE_EXCLUDED = [
    "retail", "sales associate", "cashier", "warehouse", "driver", "cleaner", "security guard", "receptionist", "admin assistant",
    "customer service rep", "call center", "barista", "server", "waiter", "cook", "chef", "maintenance",
]
SCORE_UNRELATED = ["physiotherapist", "accountant", "legal", "solicitor", "barrister", "cleaner", "security guard", "chef", "driver", "warehouse"]

# Enum spellings.
SENIORITY = {
    "mid": "mid", "senior": "senior", "lead": "lead", "executive": "executive", "associate": "mid", "staff": "lead", "principal": "lead",
}
EMPLOYMENT = {
    "full_time": "full_time", "part_time": "part_time", "contract": "contract", "internship": "internship", "temporary": "temporary",
    "full-time": "full_time", "part-time": "part_time", "permanent": "full_time", "permanent_full_time": "full_time", "fixed_term": "contract",
    "fixed_term_contract": "contract", "fixed-term": "contract", "temp": "temporary", "freelance": "contract",
}
REMOTE = {
    "onsite": "onsite", "hybrid": "hybrid", "remote": "remote", "on-site": "onsite", "on_site": "onsite", "office": "onsite", "in-office": "onsite",
    "in_office": "onsite", "remote_hybrid": "hybrid", "partially remote": "hybrid", "flexible": "hybrid",
}
FUNCTIONS = [
    "Engineering", "Data & Analytics", "Product & Design", "Sales & Business Development", "Marketing & Content", "Operations", "Customer Success", "Other",
]
SENIORITY_ORDER = ["Executive", "Lead", "Senior", "Mid-level"]

# Legal suffixes of company names.
LEGAL_SUFFIXES = [" limited", " ltd", " inc.", " inc", " llc", " gmbh", " bv", " plc", " group", " company", " co.", " co"]

# Top-level domains of several parts, and publishers by host.
MULTI_TLDS = [".co.uk", ".co.nz", ".com.au", ".co.ie", ".co.za", ".org.uk", ".ac.uk", ".gov.uk"]
PUBLISHERS = {
    "siliconrepublic.com": "Silicon Republic", "sportforbusiness.com": "Sport for Business", "businesspost.ie": "Business Post",
    "irishtimes.com": "Irish Times", "irishexaminer.com": "Irish Examiner", "independent.ie": "Irish Independent", "rte.ie": "RTÉ",
    "thejournal.ie": "The Journal", "techcentral.ie": "TechCentral", "irishtechnews.ie": "Irish Tech News", "businessplus.ie": "Business Plus",
    "thinkbusiness.ie": "Think Business", "enterprise-ireland.com": "Enterprise Ireland", "sportireland.ie": "Sport Ireland", "bebeez.eu": "Bebeez",
    "eu-startups.com": "EU-Startups", "sifted.eu": "Sifted", "techcrunch.com": "TechCrunch", "theathletic.com": "The Athletic", "espn.com": "ESPN",
    "reuters.com": "Reuters", "bloomberg.com": "Bloomberg", "forbes.com": "Forbes", "ft.com": "Financial Times", "sportstechx.com": "SportsTechX",
    "sportspro.com": "SportsPro", "sbcnews.co.uk": "SBC News", "sustainhealth.fit": "Sustain Health Magazine", "mshale.com": "Mshale",
    "sportstourismnews.com": "Sports Tourism News",
}

# Tracking parameters of addresses.
TRACKING = ["_gl", "recId", "recSource", "searchId", "eventOrigin", "aff", "fbclid", "gclid"]

# Job-board addresses and their slugs, in order of priority; slugs that are none.
BOARD_PATTERNS = [
    ("greenhouse", r"(?i)boards\.greenhouse\.io/(?:embed/job_board\?for=)?([a-z0-9_-]+)"), ("lever", r"(?i)jobs\.lever\.co/([a-z0-9_-]+)"),
    ("workable", r"(?i)apply\.workable\.com/([a-z0-9_-]+)"), ("ashby", r"(?i)jobs\.ashbyhq\.com/([a-z0-9_-]+)"),
    ("teamtailor", r"(?i)([a-z0-9-]+)\.teamtailor\.com"), ("bamboohr", r"(?i)([a-z0-9-]+)\.bamboohr\.com"),
    ("personio", r"(?i)([a-z0-9-]+)\.jobs\.personio\.(?:com|de)"), ("recruitee", r"(?i)([a-z0-9-]+)\.recruitee\.com"),
    ("breezy", r"(?i)([a-z0-9-]+)\.breezy\.hr"), ("smartrecruiters", r"(?i)https?://([a-z0-9_-]+)\.smartrecruiters\.com"),
    ("smartrecruiters", r"(?i)careers\.smartrecruiters\.com/([a-z0-9_-]+)"),
]
# Text of pages that Teamtailor serves under a company's own host.
TEAMTAILOR_MARKERS = ["career site by teamtailor", "cdn.teamtailor.com", "teamtailor-jobs", "teamtailor.com/t/"]
NO_SLUGS = ["embed", "widget", "jobs", "careers", "apply", "external", "api", "en", "us", "oops", "error", "404", "notfound"]
WORKDAY = r"(?i)https?://([a-z0-9][a-z0-9-]*)\.wd(\d+)\.myworkdayjobs\.com(?:/[a-z]{2}-[a-z]{2})?/([^/\s\"'<>?#]+)"
API_TEMPLATES = [
    ("greenhouse", "https://boards-api.greenhouse.io/v1/boards/{slug}/jobs"), ("lever", "https://api.lever.co/v0/postings/{slug}?mode=json"),
    ("workable", "https://apply.workable.com/api/v3/accounts/{slug}/jobs"), ("ashby", "https://api.ashbyhq.com/posting-api/job-board/{slug}"),
    ("smartrecruiters", "https://api.smartrecruiters.com/v1/companies/{slug}/postings"), ("teamtailor", "https://{slug}.teamtailor.com/jobs.json"),
    ("recruitee", "https://{slug}.recruitee.com/api/offers/"), ("personio", "https://{slug}.jobs.personio.com/search.json"),
    ("bamboohr", "https://{slug}.bamboohr.com/careers/list"), ("breezy", "https://{slug}.breezy.hr/json"),
]
LOGIN_ENDS = ["/signin", "/login", "/auth", "/register", "/signup"]
HOME_PATHS = ["/", "/en/", "/en-us/", "/en-gb/", "/home", "/home/", "/index", "/index.html"]
CAREER_SIGNS = [
    "apply now", "open positions", "open roles", "current openings", "job title", "full-time", "part-time", "remote", "hybrid", "we're hiring",
    "we are hiring", "join our team",
]

#: Lowest job number that counts as recent, and limits of age in days.
ID_FLOOR, MAX_DAYS = 4_200_000_000, 90
AGE_LIMITS = {"site_rss": 35, "google_news": 40, "monitor": 3, "actor": 30}
