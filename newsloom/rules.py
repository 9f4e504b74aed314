"""Word lists, rule tables and thresholds that results depend on."""

from __future__ import annotations

# ---------------------------------------------------------------- whitespace
# Every character Python's str.split()/strip() treats as white space, as one
# regex class body that Java regex and RE2 read the same way.
WS = (
    r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same set as plain characters, for trim().
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Punctuation stripped from title words and from keywords.
TITLE_PUNCT = ",.!?:;\"'()[]"
KEYWORD_PUNCT = ".,;:!?()[]{}\"'\n"

# -------------------------------------------------------------- quality rules
# Thresholds and flag names, in reporting order.
MIN_TITLE_LENGTH = 5
MIN_CONTENT_LENGTH = 50
MIN_DETECT_LENGTH = 20
MIN_LANGUAGE_CHECK_LENGTH = 200
MIN_ARTICLES_PER_SOURCE = 5
MIN_QUALITY_OK_RATE = 0.75
QUALITY_FLAGS = (
    "TITRE_VIDE_OU_TROP_COURT",
    "CONTENU_TROP_COURT",
    "URL_MANQUANTE",
    "DATE_MANQUANTE",
    "URL_INVALIDE",
    "LANGUE_ARABE_NON_SUPPORTEE",
    "LANGUE_INCOHERENTE",
)
WARNING_FLAGS = ("AUTEUR_MANQUANT", "CATEGORIE_MANQUANTE")
RETENTION_DAYS = {"bronze": 90, "silver": 90, "gold": 365}

# --------------------------------------------------------- language profiles
# Function words whose share decides the language of a text; a text written in
# Arabic script is recognised by its letters instead.
LANGUAGE_WORDS = {
    "en": "the of and to in is that for it with as was on be by this are from".split(),
    "fr": "le la les de des du et en un une que qui dans pour est sur au pas avec ce".split(),
    "es": "el la los las de del y en un una que por con para es se lo no al su".split(),
    "de": "der die das und zu den von mit ist des ein eine nicht für auf im sich dem".split(),
}

# ------------------------------------------------------------- stop word lists
# Words never used in a topic representation, by language.
STOP_EN = """
the of to and in is for on with as by at an be this that from post appeared
first also has have are was were its which his her they them their but not or
so if than because while where when how what who why about into over after
before between out against during without under more most other some such no
nor only own same too very can will just should now said would could been much
many
""".split()
STOP_FR = """
le la les de des un une en que qui pour dans par sur avec plus ou au aux est
sont cette cet ces son sa ses du quoi dont où quand comment pourquoi depuis
pendant après avant sous vers selon comme
""".split()
STOP_AR = """
في من على الى عن هذا هذه ان او مع كل تم قد التي الذي بعد بين انه أن إن كان
كانت هو هي هناك كما إلى حول عند لدى عبر نحو منذ الذين تلك ذلك
""".split()
TOPIC_STOP_WORDS = STOP_EN + STOP_FR + STOP_AR

# Words that no market is searched by.
MARKET_STOP_WORDS = """
the of to and in is for on with as by at an be this that from post appeared first also has have
are was were its which his her they them their but not or so if than because while where when how
what who why about into over after before between out against during without under more most other
some such no nor only own same too very can will just should now said would could been much many
le la les de des un une en que qui pour dans par sur avec plus ou au aux est sont cette cet ces
son sa ses du dont où quand comment pourquoi depuis pendant après avant sous vers selon comme في
من على الى عن هذا هذه ان او مع كل تم قد التي الذي بعد بين انه أن إن كان كانت هو هي هناك كما إلى
حول عند لدى عبر نحو منذ it we you he she fait pas tout tous être avoir faire dit mis says new get
one two
""".split()

# Words dropped from the keyword ranking.
KEYWORD_STOP_WORDS = """
le la les de des du un une et en à au aux est sont a ont dans pour par sur avec
ce cet cette se que qui ne pas plus mais ou où son sa ses
the of and to a in is it you that he was for on are as with his they i at be
this have from or one had by word but not what all were we when your can said
there use an each which she do how their if will up other about out many then
them these so some her would make like into him has two more go no way could my
than first been call who its now find long down day did get come made may part
""".split()

# Words dropped when a topic label becomes a display name.
LABEL_STOP_WORDS = """
the of to and in is for on with as by at an be it he she you we they this that
video watch update photos
""".split()

# ---------------------------------------------------------------- translation
# French/Arabic/English keyword -> English search keyword.
KEYWORD_MAP = {
    "maroc": "morocco", "المغرب": "morocco",
    "gaza": "gaza", "غزة": "gaza", "palestine": "palestine", "فلسطين": "palestine",
    "israel": "israel", "israël": "israel", "إسرائيل": "israel",
    "usa": "us", "états-unis": "us", "etats-unis": "us", "أمريكا": "us",
    "biden": "biden", "trump": "trump",
    "uk": "uk", "britain": "britain", "london": "uk", "bbc": "uk",
    "france": "france", "فرنسا": "france", "macron": "macron",
    "ukraine": "ukraine", "أوكرانيا": "ukraine",
    "russia": "russia", "russie": "russia", "روسيا": "russia",
    "putin": "putin", "poutine": "putin",
    "china": "china", "chine": "china", "chinese": "china", "الصين": "china",
    "xi": "china", "jinping": "china", "beijing": "china",
    "europe": "europe", "eu": "europe", "nato": "nato",
    "iran": "iran", "إيران": "iran", "tehran": "iran",
    "syria": "syria", "syrie": "syria", "سوريا": "syria",
    "lebanon": "lebanon", "liban": "lebanon",
    "india": "india", "inde": "india", "भारत": "india",
    "africa": "africa", "afrique": "africa", "إفريقيا": "africa",
    "economy": "economy", "économie": "economy", "inflation": "inflation",
    "fed": "fed", "federal": "fed", "reserve": "fed",
    "crypto": "crypto", "bitcoin": "bitcoin", "ethereum": "ethereum",
    "btc": "bitcoin", "eth": "ethereum",
    "stock": "stock", "market": "market", "trade": "trade",
    "tariff": "tariffs", "tarifs": "tariffs", "douane": "tariffs",
    "football": "football", "sport": "sports", "nba": "nba",
    "nhl": "nhl", "world cup": "world cup", "fifa": "fifa",
    "election": "election", "élection": "election",
    "elections": "election", "انتخابات": "election",
    "vote": "election", "president": "president",
    "senate": "senate", "congress": "congress",
    "war": "war", "guerre": "war", "حرب": "war",
    "conflict": "war", "military": "military",
    "oil": "oil", "pétrole": "oil", "energy": "energy",
    "nuclear": "nuclear", "nucléaire": "nuclear",
    "ai": "ai", "intelligence": "ai", "artificial": "ai",
    "openai": "openai", "chatgpt": "openai",
    "tech": "technology", "technology": "technology",
    "space": "space", "nasa": "space", "esa": "space",
    "climate": "climate", "climat": "climate",
}
# The shorter map used by the relevance check.
RELEVANCE_MAP = {
    "maroc": "morocco", "gaza": "gaza", "israel": "israel", "france": "france",
    "usa": "us", "ukraine": "ukraine", "russie": "russia", "china": "china",
    "iran": "iran",
}

# -------------------------------------------------------------- entity rules
# The name of what no rule names, and labels that are no topics.
DEFAULT_ENTITY = "Actualité Internationale"
SENTINEL_LABELS = ("non-modelise", "hors-sujet", "non-classe")
# Fixed values: (entity, substrings), first rule that matches wins.
ENTITY_RULES = [
    ("Iran", ["iran", "tehran"]),
    ("Israël / Gaza", ["gaza", "israel", "palestine", "hamas", "lebanon", "beirut"]),
    ("Maroc", ["morocco", "maroc", "sahara", "hespress", "barlamane", "akhbarona"]),
    ("Ukraine / Russie", ["ukraine", "russia", "putin", "moscow", "kiev"]),
    ("États-Unis", ["us", "usa", "biden", "trump", "cnn", "white house", "washington", "america"]),
    ("Royaume-Uni", ["uk", "bbc", "london", "britain"]),
    ("France", ["france", "macron", "paris"]),
    ("Chine", ["china", "beijing"]),
    ("Affaire Murdaugh", ["murdaugh", "trial"]),
    ("Espace & Science", ["space", "nasa", "moon"]),
    ("Climat & Énergie", ["climate", "solar", "energy", "weather"]),
    ("Afrique", ["africa", "african"]),
    ("Économie & FED", ["economy", "inflation", "fed", "bank"]),
]
# The stricter rules of the market page.
MARKET_ENTITY_RULES = [
    ("Iran", ["iran", "tehran", "iranian"]),
    ("Israël / Gaza", ["gaza", "israel", "palestine", "hamas", "lebanon", "beirut", "west bank"]),
    ("Maroc", ["morocco", "maroc", "sahara", "hespress", "barlamane", "akhbarona", "rabat"]),
    ("Ukraine / Russie", ["ukraine", "russia", "putin", "moscow", "kiev", "kremlin", "zelensky"]),
    ("États-Unis", ["biden", "trump", "white house", "washington dc", "congress", "senate", "pentagon"]),
    ("Royaume-Uni", ["uk", "britain", "british", "london", "parliament"]),
    ("France", ["france", "macron", "paris", "élysée", "elysee"]),
    ("Chine", ["china", "beijing", "xi jinping", "chinese", "taiwan"]),
    ("Justice & Enquêtes", ["murdaugh", "trial", "court", "verdict", "sentenced"]),
    ("Espace & Science", ["space", "nasa", "moon", "mars", "rocket", "satellite"]),
    ("Climat & Énergie", ["climate", "solar", "energy", "carbon", "emission", "weather"]),
    ("Économie & FED", ["inflation", "fed", "interest rate", "economy", "recession", "gdp"]),
    ("Afrique", ["africa", "african", "kenya", "nigeria", "ethiopia", "ghana"]),
    ("Inde / Pakistan", ["india", "pakistan", "kashmir", "modi", "new delhi"]),
]
# What to look for in market titles, per entity, in order.
ENTITY_BET_KEYWORDS = {
    "Iran": ["iran", "tehran", "iranian"],
    "Israël / Gaza": ["gaza", "israel", "palestine", "hamas"],
    "Maroc": ["morocco"],
    "Ukraine / Russie": ["ukraine", "russia"],
    "États-Unis": ["us election", "trump", "biden", "senate"],
    "Royaume-Uni": ["uk election", "britain"],
    "France": ["france election", "macron"],
    "Chine": ["china", "taiwan"],
    "Justice & Enquêtes": ["trial", "court"],
    "Espace & Science": ["space", "nasa"],
    "Climat & Énergie": ["climate", "energy"],
    "Économie & FED": ["inflation", "fed rate"],
    "Afrique": ["africa"],
    "Inde / Pakistan": ["india", "pakistan"],
    "Actualité Internationale": ["world news"],
}

# ----------------------------------------------------------- source catalogue
# Key, domain, language, country, raw prefix, name, category,
# description. `category_in_raw` sources append the feed category.
SOURCE_CATALOGUE = [
    ("hespress", "hespress.com", "fr", "MA", "hespress_rss", False, "Hespress", "rss", "fil marocain"),
    ("bbc", "bbc.co.uk", "en", "GB", "bbc_rss", True, "BBC News", "rss", "world service"),
    ("gdelt", None, None, None, "gdelt", False, "GDELT v2", "api", "article list"),
    ("akhbarona", "akhbarona.com", "fr", "MA", "akhbarona_rss", False, "Akhbarona", "rss", "fil marocain"),
    ("lakom", "lakome2.com", "fr", "MA", "lakom_rss", False, "Lakom", "rss", "fil marocain"),
    ("barlamane", "barlamane.com", "fr", "MA", "barlamane_rss", False, "Barlamane", "rss", "fil marocain"),
    ("aljazeera", "aljazeera.com", "en", "QA", "aljazeera_rss", True, "Al Jazeera", "rss", "world news"),
    ("cnn", "cnn.com", "en", "US", "cnn_rss", True, "CNN", "rss", "world news"),
    ("reuters", "reuters.com", "en", "US", "reuters_rss", True, "Reuters", "rss", "agency"),
]
MOROCCAN_SOURCES = ("hespress", "akhbarona", "lakom", "barlamane")

# Containers tried in order when reading an article page. A bare
# word is a tag, `div.x` a class and `div#x` an id.
PAGE_SELECTORS = {
    "hespress": ["div.article-content", "div.single-content", "div.entry-content", "article"],
    "bbc": ["article", "div.story-body__inner", "main"],
    "akhbarona": ["div.entry-content", "div.post-content", "article", "div.content"],
    "lakom": ["div.entry-content", "div.post-content", "article", "div.content"],
    "barlamane": ["div.entry-content", "div.post-content", "article", "div.content"],
    "aljazeera": ["article", "div.article-content", "div.main-content", "div#body-content"],
    "cnn": ["article", "div.article__content", "div.l-container", "div#maincontent"],
    "reuters": ["article", "div.ArticleBody__container", "div.StandardArticleBody_body", "div#___main"],
}
PAGE_DROP_TAGS = ("aside", "nav", "script", "style", "figure")
MIN_PAGE_TEXT = 100

# -------------------------------------------------------------- table layouts
# Column order of the layers.
RAW_COLUMNS = (
    "article_id titre url source langue date_publication contenu pays raw_source "
    "auteur categorie ingested_at"
).split()
SILVER_COLUMNS = (
    "article_id titre_clean url source langue langue_detectee pays date_publication "
    "contenu_clean content_length content_hash raw_source auteur categorie "
    "quality_flags quality_status processed_at"
).split()
GOLD_COLUMNS = {
    "article_id": "string", "url": "string", "titre_clean": "string",
    "contenu_clean": "string", "content_length": "int", "content_hash": "string",
    "source": "string", "raw_source": "string", "langue": "string",
    "langue_detectee": "string", "pays": "string", "date_publication": "timestamp",
    "auteur": "string", "categorie": "string", "quality_status": "string",
    "quality_flags": "string", "topic_id": "int", "topic_label": "string",
    "topic_prob": "double", "topic_article_count": "int",
    "topic_coverage_score": "double", "polymarket_question": "string",
    "polymarket_prob": "double", "polymarket_prob_pct": "string",
    "polymarket_volume_usd": "double", "polymarket_url": "string",
    "combined_signal": "double", "processed_at": "timestamp",
    "gold_built_at": "timestamp", "ingested_at": "timestamp",
}
# Stored name -> name served by the API.
API_NAMES = {
    "article_id": "id", "titre_clean": "titre", "date_publication": "date",
    "quality_status": "quality", "topic_label": "topic",
    "polymarket_prob": "poly_prob", "polymarket_question": "poly_q",
}
API_DEFAULTS = {
    "id": None, "titre": None, "date": None, "quality": "UNKNOWN", "topic": None,
    "topic_r": None, "poly_prob": None, "poly_q": None, "source_key": None,
}

# --------------------------------------------------------------- log reading
# A log line that contains one of the words has reached the step.
LOG_STEPS = [
    (0, ["scraping", "phase 1", "articles scraped"]),
    (1, ["silver", "bronze", "phase 2"]),
    (2, ["bertopic", "topic"]),
    (3, ["gold", "polymarket", "phase 3"]),
    (4, ["duckdb", "warehouse", "phase 4"]),
]
# Severity by first matching pattern, ignoring case.
LOG_SEVERITY = [
    ("error", "error"),
    ("warn", "warn"),
    ("ok", r"\[ok\]|success|done|terminé|complet"),
    ("phase", "phase|>>>|==="),
    ("info", "info"),
]
