"""Word lists, lookup tables, thresholds and patterns.

Everything here is data.  The operators take these as arguments, so another
industry or country only needs other values, not other code.
"""

# --- fixed values: thresholds -------------------------------------------------
MAX_PAGES_PER_SITE = 100
MAX_PRODUCT_PAGES = 80
MAX_CONTACT_PAGES = 10
MAX_CONSECUTIVE_FAILURES = 5
EMPTY_PAGE_WORDS = 20
EMPTY_PAGES_BEFORE_SKIP = 10
CONTACT_CONTEXT_CHARS = 80
JS_RENDERED_MEDIAN_WORDS = 50
MAX_FAILED_SHARE = 0.2
CAPTCHA_MAX_WORDS = 300
MIN_WORDS = 20
MIN_TEXT_PAGES = 20
NEWS_YEAR_SPAN = 5

# --- fixed values: landing file columns ----------------------------------------
LANDING_COLUMNS = {
    "Serial No": "serial_no",
    "Company Name": "company_name",
    "Company Site URL": "company_site_url",
}

# --- fixed values: company names ------------------------------------------------
BRAND_PREFIX = r"^The\s+"
BRAND_SUFFIXES = [
    "Construction Equipment", "Construction Machinery", "Tractor Corporation", "North America",
    "America", "Corporation", "Company", "Industries", "Cranes", "Agriculture", r"Inc\.?", "LLC",
]

# --- fixed values: page addresses ------------------------------------------------
DOCUMENT_PATTERN = r"\.(pdf|jpe?g|png|gif|svg|webp|zip|docx?|xlsx?|pptx?|mp4|mp3)$"
YEAR_PATTERN = r"(?:^|/)((?:19|20)\d{2})(?:/|-|$)"

# Page types in the order they are tried, with the path words that mark them.
PAGE_TYPE_WORDS = [
    ("news", [r"news\w*", "press", r"blogs?", "media", "stories", r"articles?",
              r"publications?", r"insights?", "magazine", r"events?"]),
    ("careers", [r"careers?", r"jobs?"]),
    ("dealer", [r"dealers?", "locator"]),
    ("parts_service", ["parts", r"service\w*", "support", "warranty", r"manuals?",
                       "training", "safety", "operator-reference"]),
    ("about", [r"about\w*", "company", "history", "sustainability", r"investors?",
               "leadership", r"contact\w*"]),
    ("product", [r"products?", "equipment", r"machines?", "machinery", r"attachments?",
                 "series", r"models?", r"tractors?", r"excavators?", r"loaders?",
                 r"backhoes?", r"dozers?", r"mowers?", r"harvesters?", r"combines?",
                 r"balers?", r"sprayers?", r"planters?", r"telehandlers?",
                 r"compactors?", r"rollers?", r"trucks?", r"cranes?", r"lifts?",
                 r"drills?", r"trenchers?", r"grinders?", r"chippers?", r"rakes?",
                 r"mixers?", r"pavers?", r"graders?"]),
]

# Page types that a crawl visits, best first; "home" and "document" are not queued.
PAGE_PRIORITY = {"product": 0, "about": 1, "parts_service": 2, "other": 3, "news": 4,
                 "dealer": 5, "careers": 6}

CONTACT_PAGE_PATTERN = (
    r"(?:^|[/_-])(contact\w*|locations?|headquarters?|head-office|corporate\w*|about\w*|"
    r"who-we-are|our-company)(?:[/_.-]|$)"
)
CONTACT_FIRST_PATTERN = r"contact|location|headquarter|head-office"
NOT_CONTACT_PATTERN = r"dealer|careers?|jobs?|news|press|blog"

# Per-site settings by host; anything left out takes the default.
SITE_RULE_DEFAULTS = {"base_url": None, "start_url": None, "sitemaps": None, "exclude": None,
                      "product_pattern": None, "category_segment": 0}
SITE_RULES = {
    "deere.com": {
        "base_url": "https://www.deere.com/en-us/",
        "product_pattern": r"^products-(and-)?solutions(/|$)",
        "category_segment": 1,
    },
    "cat.com": {"base_url": "https://www.cat.com/"},
    "casece.com": {
        "base_url": "https://www.casece.com/en-us/northamerica/",
        "product_pattern": r"^products(/|$)",
        "category_segment": 1,
    },
    "bobcat.com": {
        "base_url": "https://www.bobcat.com/na/en/",
        "product_pattern": r"^(equipment|attachments)(/|$)",
        "category_segment": 1,
    },
    "komatsu.com": {
        "base_url": "https://www.komatsu.com/en-us/",
        "exclude": r"^products/parts(/|$)",
        "product_pattern": r"^products/equipment(/|$)",
        "category_segment": 2,
    },
    "kubotausa.com": {
        "base_url": "https://www.kubotausa.com/",
        "product_pattern": r"^equipment-(series|category)(/|$)",
        "category_segment": 1,
    },
    "jcb.com": {
        "base_url": "https://www.jcb.com/en-US/",
        "product_pattern": r"^products/(machines|attachments)(/|$)",
        "category_segment": 2,
    },
    "agriculture.newholland.com": {
        "base_url": "https://agriculture.newholland.com/en-us/nar/",
        "product_pattern": r"^products(/|$)",
        "category_segment": 1,
    },
    "agcocorp.com": {
        "base_url": "https://www.agcocorp.com/us/en/",
        "start_url": "https://www.agcocorp.com/us/en/home.html",
        "product_pattern": r"^home/brands-and-solutions(/|$)",
        "category_segment": 2,
    },
    "terex.com": {
        "base_url": "https://www.terex.com/",
        "exclude": r"^[a-z]{2}(-[a-z]{2})?(/|$)",
    },
    "volvoce.com": {
        "base_url": "https://www.volvoce.com/en-us/",
        "product_pattern": r"^(products|attachments)(/|$)",
        "category_segment": 1,
    },
    "hitachicm.us": {
        "base_url": "https://www.hitachicm.com/us/en/",
        "product_pattern": r"^products(/|$)",
        "category_segment": 1,
    },
    "wackerneuson.com": {
        "base_url": "https://www.wackerneuson.com/us/",
        "sitemaps": ["https://www.wackerneuson.com/us/sitemap.xml"],
        "exclude": r"^es(/|$)",
        "product_pattern": r"^products(/|$)",
        "category_segment": 1,
    },
    "vermeer.com": {"base_url": "https://www.vermeer.com/na/"},
    "na.develon-ce.com": {
        "base_url": "https://na.develon-ce.com/en/",
        "product_pattern": r"^construction-equipment(/|$)",
        "category_segment": 1,
    },
    "jlg.com": {
        "base_url": "https://www.jlg.com/en/",
        "exclude": r"^directaccess(/|$)",
        "product_pattern": r"^equipment(/|$)",
        "category_segment": 1,
    },
    "manitowoc.com": {
        "base_url": "https://www.manitowoc.com/",
        "exclude": r"^(de|fr|es|pt|it|ru|ko|zh)(/|$)|^find-a-dealer(/|$)",
        "product_pattern": r"^(grove|potain|national-crane|manitowoc|krupp|shuttlelift)(/|$)",
        "category_segment": 1,
    },
    "toro.com": {"base_url": "https://www.toro.com/en/"},
    "ditchwitch.com": {
        "base_url": "https://www.ditchwitch.com/",
        "exclude": r"^wp-content(/|$)",
        "product_pattern": r"^(trenchers|vacuum-excavation|directional-drills|stand-on-skid-steers|"
                           r"trenchless|hdd-tooling|vacs)(/|$)",
        "category_segment": 0,
    },
}

# --- fixed values: product categories -----------------------------------------------
NOT_PRODUCT_PATTERN = (
    r"compare|comparison|spec-check|testing-page|legal|financ|(^|/)parts(/|$)|offers?(/|$)|"
    r"promotion|warranty|build-and-price|inventory|(^|/)used|used-equipment|register-used|prior-models|non-current|"
    r"brochure|dealer|find-a|request-a|quote|demo(/|$)|government|military|"
    r"power-gard|protection-plan|digital-products|rental-resources|we-drill|(^|/)features(/|$)"
)

# (category, segment, pattern on the path); the first match decides, so order matters.
CATEGORY_RULES = [
    ("Attachments", "Attachments", r"attachment|accessor|(^|[/-])(blades?|buckets?)(/|$)|products-and-solutions/loaders"),
    ("Engines & Powertrain", "Other", r"^(?!.*engine-powered).*(engine|drivetrain|powertrain|agco-power|pump-drive)"),
    ("Hay & Forage", "Agriculture", r"vertical-mixer|feed-mixer"),
    ("Forestry & Tree Care", "Forestry", r"forest|feller|forwarder|skidder|log-loader|logging|timber|"
                                         r"harvester-head|chipper|stump|tree-care|brush|horizontal-grinder|tub-grinder"),
    ("Mining Equipment", "Mining", r"mining|shovel|dragline|longwall|continuous-miner|blasthole|room-and-pillar|"
                                   r"bolter|underground|shaft-sinking|entry-development|hard-rock|industrial-minerals|crush|"
                                   r"haul-truck|surface-drill"),
    ("Drills & Trenchers", "Construction", r"directional-drill|trencher|vacuum-excavat|horizontal-directional|"
                                           r"trenchless|hdd-tooling"),
    ("Cranes", "Construction", r"crane|boom-truck|carry-deck|(^|/)krupp(/|$)"),
    ("Mini Excavators", "Construction", r"mini-excavator|compact-excavator|mini-ex(/|-|$)"),
    ("Excavators", "Construction", r"excavator|high-reach"),
    ("Skid Steer & Track Loaders", "Construction", r"skid-steer|track-loader|compact-track|mini-loader|"
                                                   r"mini-track|compact-loader|articulated-loader|small-articulated"),
    ("Backhoe Loaders", "Construction", r"backhoe|tractor-loader"),
    ("Wheel Loaders", "Construction", r"wheel-loader"),
    ("Dozers", "Construction", r"dozer"),
    ("Motor Graders", "Construction", r"motor-grader"),
    ("Haulers & Dump Trucks", "Construction", r"hauler|dump-truck|dumper|dumpster|(^|/)trucks(/|$)"),
    ("Compaction", "Construction", r"^(?!.*(tillage|seed|planter)).*(compaction|compactor|roller|vibratory|rammer)"),
    ("Aerial Work Platforms", "Construction", r"aerial|boom-lift|articulated-boom|telescopic-boom|scissor|digger-derrick|"
                                              r"vertical-lift|low-level-access|stock-picker|mast-lift"),
    ("Concrete & Paving", "Construction", r"concrete|paver|paving|asphalt|mixer|road-build|(^|/)(advance|bid-well)(/|$)"),
    ("Light & Power Equipment", "Construction", r"light-tower|lighting|generator|power-supply|portable-power|"
                                                r"compressor|pump|heater"),
    ("Tractors", "Agriculture", r"tractor"),
    ("Telehandlers & Material Handling", "Construction", r"telehandler|telescopic-handler|telescopic-loader|loadall|"
                                                         r"material-handl|forklift|reach-stacker|warehouse|"
                                                         r"(^|/)marco(/|$)"),
    ("Combines & Harvesting", "Agriculture", r"combine|harvest|header|cotton|grape|sugarcane"),
    ("Hay & Forage", "Agriculture", r"(^|[/-])hay|forage|baler|bale|rake|tedder|wrapper|mower-conditioner|windrower"),
    ("Seeding & Tillage", "Agriculture", r"seed|planter|tillage|cultivat|plow|disk"),
    ("Sprayers & Crop Care", "Agriculture", r"spray|crop-care|nutrient|applicator|spreader"),
    ("Precision Technology", "Agriculture", r"precision|guidance|gps|technology-solutions|telematics"),
    ("Mowers & Turf", "Turf & Utility", r"mower|turf|lawn|golf|zero-turn|landscap|aerator|cutter|shredder"),
    ("Utility Vehicles", "Turf & Utility", r"utility-vehicle|gator|(^|[/-])rtv|(^|[/-])utv|xuv|crossover|toolcat"),
]

CATEGORY_ORDER = [
    "Mini Excavators", "Excavators", "Skid Steer & Track Loaders", "Backhoe Loaders", "Wheel Loaders",
    "Dozers", "Motor Graders", "Haulers & Dump Trucks", "Telehandlers & Material Handling", "Compaction",
    "Aerial Work Platforms", "Cranes", "Concrete & Paving", "Drills & Trenchers", "Light & Power Equipment",
    "Tractors", "Combines & Harvesting", "Hay & Forage", "Seeding & Tillage", "Sprayers & Crop Care",
    "Precision Technology", "Mowers & Turf", "Utility Vehicles", "Forestry & Tree Care", "Mining Equipment",
    "Engines & Powertrain", "Attachments",
]

ELECTRIC_PATH_PATTERN = r"electric|battery|zero-emission|(^|[/-])ev(/|-|$)"
ELECTRIC_HEADING_PATTERN = r"(?i)\b(electric|battery)\b"
ELECTRIC_LANDING_PATTERN = (
    r"^(electric|battery|zero-emission)[a-z-]*-(machines|equipment|products|solutions|range|lineup|portfolio)$"
)
# A trailing internal code that mixes letters and digits.
MODEL_CODE_PATTERN = r"-(?=[a-z0-9]*[0-9])(?=[a-z0-9]*[a-z])[a-z0-9]{6,}$"

# --- fixed values: technology themes, status notes ---------------------------------
TECH_THEMES = {
    "Electric & Battery": r"(?i)\b(electric|battery|batteries|electrified|zero[- ]emissions?)\b",
    "Autonomy": r"(?i)\b(autonomous|autonomy|driverless|self-driving)\b",
    "Telematics & Connectivity": r"(?i)\b(telematics|connectivity|remote monitoring|fleet management)\b",
    "GPS & Precision": r"(?i)\b(gps|precision ag\w*|grade control|machine control)\b",
    "Alternative Fuels": r"(?i)\b(hydrogen|hvo|renewable diesel|biodiesel)\b",
    "Emissions": r"(?i)\b(tier 4|tier iv|stage v|emissions?)\b",
    "Sustainability": r"(?i)\b(sustainab\w+|carbon|net[- ]zero)\b",
}

DATA_NOTES = {
    "ok": "Full data",
    "partial": "Partial: some pages failed",
    "js_rendered": "Limited: pages built by JavaScript",
    "captcha": "No data: website shows a captcha",
    "blocked": "No data: website blocks automated access",
    "error": "No data: website did not respond",
}

# --- fixed values: page screening ----------------------------------------------------
CAPTCHA_PATTERN = (
    r"(?i)(?<!re)captcha|are you a robot|verify you are human|access denied|request unsuccessful"
)

# --- fixed values: sitemaps -------------------------------------------------------------
SITEMAP_BLOCK_PATTERN = r"(?s)<(?:\w+:)?url>(.*?)</(?:\w+:)?url>"
SITEMAP_LOC_PATTERN = r"(?s)<(?:\w+:)?loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</(?:\w+:)?loc>"
SITEMAP_LASTMOD_PATTERN = r"(?s)<(?:\w+:)?lastmod>\s*(.*?)\s*</(?:\w+:)?lastmod>"

# --- fixed values: phone numbers and addresses ----------------------------------------
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "District of Columbia": "DC",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL",
    "Indiana": "IN", "Iowa": "IA", "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA",
    "Maine": "ME", "Maryland": "MD", "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN",
    "Mississippi": "MS", "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY",
    "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR",
    "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA",
    "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

PHONE_PATTERN = r"(?<![\d-])(?:\+?1[\s.-])?\(?[2-9]\d{2}\)?[\s.-]{1,2}[2-9]\d{2}[\s.-]\d{4}(?![\d-])"
PHONE_AFTER_ADDRESS_PATTERN = (
    r"(?<![\d-])(?:\+?1[\s.-])?(?:\(1\)\s*)?\(?[2-9]\d{2}\)?[\s.-]{1,2}[2-9]\d{2}[\s.-]\d{4}(?![\d-])"
)
CITY_WORDS_PATTERN = r"[A-Z][A-Za-z.'-]*(?:\s+[A-Z][A-Za-z.'-]*){0,3}"
ADDRESS_VALUE_PATTERN = r"^(.*?),\s*([A-Z]{2})\s+(\d{5})$"
JSON_LD_PHONE_PATTERN = r'"telephone"\s*:\s*"([^"]+)"'
JSON_LD_POSTAL_PATTERN = r'"postalCode"\s*:\s*"(\d{5})'
JSON_LD_REGION_PATTERN = r'"addressRegion"\s*:\s*"([^"]+)"'
JSON_LD_LOCALITY_PATTERN = r'"addressLocality"\s*:\s*"([^"]+)"'

HQ_PATTERN = (
    r"(?i)head\s*quarters?|head office|corporate (?:office|offices|hq|campus)|main office|global hq|\bhq\b"
)
CONTACT_URL_PATTERN = r"(?i)contact|location|headquarter|head-office|about|corporate|our-company"
FAX_PATTERN = r"(?i)fax"
FAX_WINDOW_RANKING = 25
FAX_WINDOW_AFTER_ADDRESS = 12
NOT_FOUND_LABEL = "not found on website"

STREET_WORDS = ["way", "parkway", "pkwy", "drive", "dr", "road", "rd", "street", "st", "avenue", "ave",
                "boulevard", "blvd", "lane", "ln", "court", "ct", "place", "pl", "circle", "highway", "hwy",
                "suite", "ste", "corporation", "corp", "llc", "inc", "company", "usa"]
DIRECTION_WORDS = ["n", "s", "e", "w", "ne", "nw", "se", "sw"]

# --- fixed values: founding years --------------------------------------------------------
FOUNDED_PATTERN = r"(?i)\b(?:since|founded(?:\s+in)?|established(?:\s+in)?|est\.)\s+((?:18|19|20)\d{2})\b"
FIRST_PERSON_PATTERN = r"\b(?:[Ww]e|[Oo]ur|us)\b"
NOT_FOUNDING_PATTERN = (
    r"(?i)facilit|plant|factory|site|campus|office|center|centre|location|dealer|"
    r"award|program|partner|acquired|employee|career|ceo|president"
)
MIN_FOUNDED_YEAR = 1800

# --- fixed values: serving labels ----------------------------------------------------------
NOT_PUBLISHED_LABEL = "Not published on website"
NO_YEAR_LABEL = "-"
EXCLUDED_CATEGORY = "Attachments"

# --- fixed values: dashboard tiles -----------------------------------------------------------
# name, dataset, dimensions, measure, function, name of the value, sort, fixed positions
TILES = [
    ("kpi_companies", "ds_company", (), "brand", "count", "companies"),
    ("kpi_located", "ds_locations", (), "brand", "count", "hq_found"),
    ("kpi_categories", "ds_categories", (), "category", "count_distinct", "categories"),
    ("kpi_products", "ds_categories", (), "product_pages", "sum", "product_pages"),
    ("kpi_electric", "ds_electric", (), "product_name", "count", "electric_products"),
    ("kpi_news", "ds_news", (), "news_this_year", "sum", "news_this_year"),
    ("heat_portfolio", "ds_categories", ("category", "brand"), "share_of_company", "sum", "share_of_company",
     ("category_order", "brand"), (("category", tuple(CATEGORY_ORDER)),)),
    ("bar_electric", "ds_electric", ("brand",), "product_name", "count", "electric_products", ("electric_products", "brand")),
    ("heat_tech", "ds_tech", ("theme", "brand"), "share_of_pages", "sum", "share_of_pages",
     ("theme_order", "brand"), (("theme", tuple(TECH_THEMES)),)),
    ("line_news", "ds_news", ("year_start", "brand"), "news_pages", "sum", "news_pages"),
]
