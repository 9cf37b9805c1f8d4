"""Word lists, lookup tables, thresholds and labels.

Everything in this module is a constant that results depend on, stated as it is.
No logic lives here. Every operator takes these as parameters, so a caller may
replace any of them with a rules table.
"""

# ---- Fixed values: thresholds -------------------------------------------------------------
REPEATED_CONTACT_MIN_ITEMS = 3
WIDE_WINDOW = 50
METRIC_WINDOW = 10
SETTLED_DAYS = 14
SHORT_MAX_SECONDS = 180
MAX_VERTICAL_RATIO = 0.95
DUPLICATE_TOLERANCE_SECONDS = 10
DAYS_PER_MONTH = 30.44
MIN_ITEM_COUNT = 30
MIN_LONG_COUNT = 30
MIN_VIEWS_PER_ITEM = 10_000
MIN_VIEWS_RATIO = 0.30
MIN_RATIO_SAMPLE = 5
MIN_UPLOADS_PER_YEAR = 6
MAX_DAYS_SINCE_LAST = 365
DEAD_MIN_SUBSCRIBERS = 100
DEAD_MIN_VIEWS = 100
NON_LATIN_MIN_CHARS = 8
NON_LATIN_MIN_RATIO = 0.10
OFF_TARGET_MIN_SHARE = 0.10
FLAGGED_PATIENCE = 10
DEEP_SCAN_PAGES = 4
LONG_SCAN_PAGES = 3
EXCLUDE_CAP = 10_000
DELETE_MAX_ROWS = 25
DELETE_MAX_FRACTION = 0.5
MIN_CONFIDENCE = 0.6
MIN_CRITERIA_RATIO = 0.5
NICHE_MATCH_DEFAULT = 70.0
TOP_DROP_REASONS = 20
NOTES_MAX_CHARS = 1500
SPEND_DAY_CAP = 10.0
SPEND_MONTH_CAP = 200.0
QUOTA_CEILING = 8000
SEND_DAILY_CAP = 10
STRANDED_AFTER_MINUTES = 60
FOLLOWUP_MIN_DAYS = 90
FOLLOWUP_MAX_TOUCHES = 2

# ---- Fixed values: scoring ----------------------------------------------------------------
SUBSCRIBER_CEILING = 1_000_000
VIEWS_CEILING = 500_000
ENGAGEMENT_CEILING = 8.0
FREQ_IDEAL_MIN = 2
FREQ_IDEAL_MAX = 20
RISK_VIEW_RATIO = 0.02
RISK_ENGAGEMENT = 0.5
RISK_HIGH_SUBSCRIBERS = 100_000
RISK_COMBO_RATIO = 0.005

# ---- Fixed values: time zones -------------------------------------------------------------
BUDGET_ZONE = "America/Toronto"
QUOTA_ZONE = "America/Los_Angeles"

# ---- Fixed values: patterns ---------------------------------------------------------------
EMAIL_PATTERN = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
HANDLE_PATTERN = r"@([a-zA-Z0-9_.\-]+)"
DURATION_PATTERN = r"^P(?:(\d+)D)?T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$"
TITLE_SUFFIX_PATTERN = r"[\(\[\{][^\(\)\[\]\{\}]{0,30}[\)\]\}]\s*$"
FORMULA_PREFIXES = "=+-@\t\r"
ENTITY_URL_PATTERN = r"^https://www\.youtube\.com/(?:channel/UC[A-Za-z0-9_-]{22}|@[A-Za-z0-9._-]+)$"
ENTITY_ID_PATTERN = r"^UC[A-Za-z0-9_-]{22}$"
ENTITY_URL_PREFIX = "https://www.youtube.com/channel/"
HTTP_URL_PATTERN = r"^https?://[^\s<>\"']+$"
MAILTO_PATTERN = r"^mailto:[^\s<>\"'@]+@[^\s<>\"'?]+(?:\?[^\s<>\"']*)?$"
LOCATION_CUE = (
    r"(?:based in\b|based out of\b|located in\b|living in\b|lives?\s+in\b|"
    r"moved to\b|home (?:is )?in\b|home base\b|life in\b|"
    r"from(?: a| the)?(?: \w+){0,2} in\b|📍|location\s*[:\-])"
)
LOCATION_GAP = 60

# ---- Fixed values: labels -----------------------------------------------------------------
QUALIFIED = "Qualified"
NEW_ENTITY = "New Channel"
SEND_STATES = ["Claimed", "Sent", "NotSent", "MaybeSent"]
REPLY_STATES = ["No Reply", "Replied", "Interested", "Declined"]
DELETABLE_STATUSES = ["New"]
TRANSIENT_REASONS = ["quota_exhausted", "no_headroom_for_bucket", "unreachable"]
CONTACT_SOURCES = [
    "repeated across recent videos",
    "About description",
    "repeated across older videos",
    "influencers.club enrichment",
    "linked site or its /contact page (Playwright)",
]
MISS_NOTE_ALL = "none found (all 5 steps ran)"
UNKNOWN_COUNTRY_VALUES = ["", "unknown", "none", "null", "n/a", "-"]
MEDIA_ERROR_WORDS = ["video", "youtube", "unsupported", "not accessible"]
BLOCKED_FINISH_REASONS = ["SAFETY", "RECITATION", "PROHIBITED_CONTENT", "BLOCKLIST"]
SOCIAL_ABOUT_HOSTS = ["facebook.com"]

# ---- Fixed values: mail and link hosts ----------------------------------------------------
THIRD_PARTY_DOMAINS = [
    "youtube.com", "youtu.be", "instagram.com", "tiktok.com", "twitter.com",
    "x.com", "facebook.com", "fb.com", "linktr.ee", "linktree.com",
    "beacons.ai", "beacons.page", "discord.gg", "discord.com", "patreon.com",
    "twitch.tv", "amzn.to", "amazon.com", "bit.ly", "goo.gl", "linkedin.com",
    "threads.net", "snapchat.com", "pinterest.com", "reddit.com",
    "google.com", "apple.com", "spotify.com",
    "cash.app", "venmo.com", "paypal.com", "paypal.me", "buymeacoffee.com",
    "ko-fi.com", "coupert.com", "honey.com",
    "tinyurl.com", "t.co", "ow.ly", "rebrand.ly", "is.gd", "tiny.cc", "cutt.ly",
    "fiverr.com", "upwork.com", "freelancer.com", "99designs.com",
    "tally.so", "typeform.com", "forms.gle", "docs.google.com",
    "calendly.com", "canva.com", "elink.io",
]
FREEMAIL_DOMAINS = [
    "gmail.com", "googlemail.com", "outlook.com", "hotmail.com", "live.com",
    "msn.com", "yahoo.com", "ymail.com", "aol.com", "icloud.com", "me.com",
    "mac.com", "protonmail.com", "proton.me", "gmx.com", "gmx.de",
    "mail.com", "zoho.com", "yandex.com", "yandex.ru", "fastmail.com",
]

# ---- Fixed values: script ranges read as another language (inclusive code points) ----------
NON_LATIN_RANGES = [
    (0x0400, 0x04FF),  # Cyrillic
    (0x0590, 0x05FF),  # Hebrew
    (0x0600, 0x06FF),  # Arabic
    (0x0700, 0x074F),  # Syriac
    (0x0900, 0x097F),  # Devanagari
    (0x0980, 0x09FF),  # Bengali
    (0x0B80, 0x0BFF),  # Tamil
    (0x0E00, 0x0E7F),  # Thai
    (0x3040, 0x30FF),  # Hiragana, Katakana
    (0x3400, 0x4DBF),  # CJK extension A
    (0x4E00, 0x9FFF),  # CJK
    (0xA000, 0xA4CF),  # Yi
    (0xAC00, 0xD7AF),  # Hangul
    (0xF900, 0xFAFF),  # CJK compatibility
]

# ---- Fixed values: country names to codes -------------------------------------------------
INSIDE_COUNTRY_NAMES = {
    "united states": "US", "united states of america": "US", "usa": "US", "us": "US", "america": "US",
    "canada": "CA",
    "united kingdom": "GB", "united kingdom of great britain and northern ireland": "GB",
    "great britain": "GB", "britain": "GB", "uk": "GB", "england": "GB", "scotland": "GB",
    "wales": "GB", "northern ireland": "GB",
    "australia": "AU", "austria": "AT", "belgium": "BE", "bulgaria": "BG", "croatia": "HR",
    "cyprus": "CY", "czechia": "CZ", "czech republic": "CZ", "denmark": "DK", "estonia": "EE",
    "finland": "FI", "france": "FR", "germany": "DE", "greece": "GR", "hungary": "HU",
    "italy": "IT", "latvia": "LV", "lithuania": "LT", "luxembourg": "LU", "malta": "MT",
    "netherlands": "NL", "the netherlands": "NL", "holland": "NL", "poland": "PL",
    "portugal": "PT", "romania": "RO", "slovakia": "SK", "slovenia": "SI", "spain": "ES",
    "sweden": "SE", "iceland": "IS", "liechtenstein": "LI", "norway": "NO", "switzerland": "CH",
    "andorra": "AD", "monaco": "MC", "san marino": "SM", "vatican city": "VA", "holy see": "VA",
    "albania": "AL", "bosnia and herzegovina": "BA", "montenegro": "ME", "north macedonia": "MK",
    "macedonia": "MK", "serbia": "RS", "kosovo": "XK", "moldova": "MD", "ukraine": "UA",
}
OUTSIDE_COUNTRY_NAMES = {
    "ireland": "IE", "republic of ireland": "IE",
    "india": "IN", "pakistan": "PK", "bangladesh": "BD", "sri lanka": "LK",
    "nepal": "NP", "philippines": "PH", "indonesia": "ID", "malaysia": "MY",
    "singapore": "SG", "thailand": "TH", "vietnam": "VN", "viet nam": "VN",
    "cambodia": "KH", "myanmar": "MM", "china": "CN", "hong kong": "HK",
    "taiwan": "TW", "japan": "JP", "south korea": "KR", "korea": "KR",
    "kazakhstan": "KZ", "uzbekistan": "UZ", "afghanistan": "AF",
    "united arab emirates": "AE", "saudi arabia": "SA", "qatar": "QA",
    "kuwait": "KW", "israel": "IL", "jordan": "JO", "lebanon": "LB",
    "iraq": "IQ", "iran": "IR", "turkey": "TR", "turkiye": "TR",
    "egypt": "EG", "morocco": "MA", "algeria": "DZ", "tunisia": "TN",
    "nigeria": "NG", "ghana": "GH", "kenya": "KE", "uganda": "UG",
    "tanzania": "TZ", "ethiopia": "ET", "south africa": "ZA",
    "mexico": "MX", "brazil": "BR", "brasil": "BR", "argentina": "AR",
    "chile": "CL", "colombia": "CO", "peru": "PE", "venezuela": "VE",
    "ecuador": "EC", "bolivia": "BO", "uruguay": "UY", "paraguay": "PY",
    "guatemala": "GT", "dominican republic": "DO", "costa rica": "CR",
    "puerto rico": "PR", "cuba": "CU", "panama": "PA", "honduras": "HN",
    "russia": "RU", "russian federation": "RU", "belarus": "BY",
    "new zealand": "NZ",
}

# ---- Fixed values: topic terms (category order is the match order) ------------------------
EXCLUDED_TOPIC_TERMS = {
    "political": [
        "politics", "political", "geopolitics", "election", "elections",
        "democrat", "democrats", "republican", "republicans", "libertarian",
        "leftist", "left-wing", "right-wing", "congress", "senate",
        "communism", "socialism", "MAGA",
    ],
    "asmr": ["asmr", "tingles", "mouth sounds"],
    "firearms": [
        "firearm", "firearms", "handgun", "handguns", "ammo", "ammunition",
        "AR-15", "AK-47", "glock", "concealed carry", "second amendment",
        "gunsmith", "ballistics",
    ],
    "sim_racing": ["beamng", "assetto corsa", "iracing", "gran turismo"],
    "forestry": ["logging truck", "logging trucks", "forestry", "sawmill", "tree felling"],
}
BROADCAST_NAME_TERMS = [
    "hgtv", "entertainment tonight", "food network", "diy network",
    "magnolia network", "discovery channel", "travel channel",
    "history channel", "bbc", "itv", "channel 4", "channel 5", "sky news",
    "cnn", "msnbc", "fox news", "abc news", "nbc news", "cbs news", "pbs",
    "tlc", "bravo tv", "a&e", "lifetime tv", "paramount network",
    "nickelodeon", "disney channel",
]
BROADCAST_PHRASE_TERMS = [
    "full episodes", "full episode", "new episodes air", "episodes air",
    "airs every", "first airing", "first aired", "originally aired",
    "television programme", "television program", "tv programme",
    "television series", "television network", "tv network",
    "broadcast network", "television channel", "daytime television",
    "television programming", "season premiere", "series premiere",
    "tune in every",
]
OFF_TARGET_TERMS = {
    "gaming": [
        "fortnite", "roblox", "minecraft", "call of duty", "warzone", "valorant",
        "overwatch", "apex legends", "league of legends", "counter-strike", "cs2",
        "gta v", "gta 6", "elden ring", "zelda", "pokemon", "rainbow six", "forza",
        "modern warfare", "battle pass", "playstation", "ps5", "ps4", "xbox",
        "nintendo", "dualsense", "gameplay", "speedrun", "let's play", "lets play",
        "steam deck", "esports", "fps montage", "game review", "gamer",
    ],
    "phones_and_pcs": [
        "iphone", "android phone", "galaxy s2", "galaxy z", "pixel 9", "pixel 10",
        "pixel 11", "smartphone", "macbook", "chromebook", "ipad", "laptop review",
        "gaming pc", "gaming laptop", "rtx 40", "rtx 50", "radeon", "ryzen",
        "intel core", "motherboard", "overclock", "gpu", "benchmark", "ssd review",
        "5g phone", "phone case", "foldable phone", "pc build", "pcbuild",
        "pc builds", "diy pc", "pc case", "pc parts", "custom pc", "pcgaming",
        "gaming monitor", "gaming handheld", "gaming chair", "gaming keyboard",
        "mechanical keyboard", "lian li", "thermaltake", "steamos", "water cooling",
        "liquid cooling", "rgb build", "mini pc", "geforce", "nvidia",
        "cable management",
    ],
    "generic_gadgets": [
        "robot vacuum", "robotic vacuum", "vacuum mop", "dehumidifier",
        "air purifier", "treadmill", "power station", "smartwatch",
        "fitness tracker", "earbuds", "electric scooter", "3d printer",
        "drone review", "action camera", "osmo pocket", "insta360", "dash cam",
        "massage gun",
    ],
    "toys_and_kids": [
        "lego", "minifigure", "minifig", "brickheadz", "bricklink",
        "barbie", "baby doll", "dollhouse", "doll house", "doll room",
        "doll story", "doll makeover", "squishmallow", "squishy", "slime",
        "play doh", "play-doh", "playdough", "playset",
        "toy review", "toy unboxing", "toy haul", "kids toy",
        "surprise egg", "blind bag", "action figure", "funko",
        "poor vs rich", "rich vs poor", "gacha", "kids cartoon",
        "nursery rhyme",
    ],
    "story_recap": [
        "manhwa", "manhua", "webtoon", "anime recap", "manga recap",
        "donghua", "light novel", "novel recap",
    ],
    "av_specialist": [
        "speaker", "subwoofer", "audiophile", "hi-fi", "hifi", " dac", "iem",
        "amplifier", "turntable", "bookshelf speaker", "klipsch", "denon",
        "marantz", "phono", "loudspeaker",
    ],
    "property_showcase": [
        "inside the", "mansion", "estate tour", "property tour",
        "million dollar", "luxury home", "home tour of",
    ],
    "travel_vlog": [
        "travel vlog", "country in", "visiting", "trip to", "backpacking", "expat",
    ],
    "ai_and_crypto": [
        "crypto", "bitcoin", "ethereum", "nft", "altcoin", "web3", "blockchain",
        "ai tool", "ai platform", "ai automation", "ai review", "chatgpt",
        "midjourney", "ai agent", "saas",
    ],
}
BIO_OFF_SIGNALS = [
    "gamer", "gaming channel", "playing games", "video game", "let's play",
    "lets play", "twitch", "speedrun", "money glitches", "fortnite", "roblox",
    "minecraft", "playstation", "xbox", "nintendo", "esports",
    "about technology", "all about tech", "tech world", "tech reviews",
    "technology and gadgets", "gadget reviews", "latest technology",
    "consumer electronics", "smartphone", "unboxing and product reviews",
    "crypto", "nft", "blockchain", "ai tools",
    "diy pc", "pc building", "pc builds", "pc component", "gaming pc",
]
