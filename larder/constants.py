"""Fixed values that results depend on, stated plainly."""

# --- Fixed values: text tokens --------------------------------------------------
STOP_WORDS = ("and", "or", "the", "a", "of", "with", "in")
MIN_TOKEN_LENGTH = 3

# --- Fixed values: similarity match ---------------------------------------------
NGRAM_SIZES = (3, 4)
SIMILARITY_THRESHOLD = 0.35

# --- Fixed values: sources of a matched term -------------------------------------
SEASON_SOURCE = "eufic"
PRODUCTION_SOURCE = "faostat"
UNMATCHED = "unmatched"
SEASONAL_CATEGORIES = ("fruit", "vegetable")
OTHER_CATEGORY = "other"

# --- Fixed values: months ---------------------------------------------------------
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}

# --- Fixed values: recommendation score -------------------------------------------
PRIOR_QUANTILE = 0.80
NEUTRAL_SENTIMENT = 50.0
WEIGHT_RATING = 0.35
WEIGHT_SENTIMENT = 0.25
WEIGHT_POPULARITY = 0.20
WEIGHT_SIMPLICITY = 0.20

# --- Fixed values: sustainability score -------------------------------------------
WEIGHT_SEASON = 0.75
WEIGHT_AVAILABILITY = 0.25
POSITIVE_BONUS = 10.0

# --- Fixed values: basket relevance -----------------------------------------------
WEIGHT_BASKET = 0.50
WEIGHT_SUSTAINABILITY = 0.30
WEIGHT_APPEAL = 0.20
MISSING_MINUTES = 999

# --- Fixed values: names that mark an aggregate production row ---------------------
AGGREGATE_PATTERNS = ("primary", " total", ", total", "poultry", " meat", "equivalent", "oilcrop")

# --- Fixed values: compound country keys ------------------------------------------
COMPOUND_COUNTRIES = {"czechrepublic": "czech republic", "unitedkingdom": "united kingdom"}

# --- Fixed values: segments ---------------------------------------------------------
SEGMENT_FEATURES = (
    "appeal_score", "sentiment_percentile", "simplicity_score",
    "eufic_match_count", "totaltime_inverted", "rating_score",
)
SEGMENT_LABELS = (
    ("🏆 Top Rated", "rating_score"),
    ("🌿 Seasonal & Local", "eufic_match_count"),
    ("⭐ Crowd Favourite", "sentiment_percentile"),
    ("⚡ Quick & Easy", "totaltime_inverted"),
)
SEGMENT_FALLBACK = "🌍 Global Kitchen"
SEGMENT_COUNT = 5
SEGMENT_SEED = 42
SEGMENT_STARTS = 10
SILHOUETTE_SAMPLE = 50_000
ELBOW_RANGE = tuple(range(2, 9))
TIME_CLIP_QUANTILE = 0.99

# --- Fixed values: flags, bands and badges of a shown recipe --------------------------
FLAG_HIT = "🟢"
FLAG_PRODUCTION = "🟡"
SCORE_BANDS = (
    (80, "🌱 Très durable"), (60, "🌿 Durable"), (40, "🟡 Moyen"), (None, "🔴 Faible"),
)
COMPLEMENTARY_SOURCE = "FAOSTAT/Food.com"
RANK_BADGES = ("🥇 ", "🥈 ", "🥉 ")
EXPLANATION = {
    "prefix": "Recommended because: ",
    "popular": ("popular (", " reviews)"),
    "time": ("ready in ", " min"),
    "seasonal": ("matches: ", ""),
    "fallback": "no selection — top seasonal picks",
}

# --- Fixed values: columns of a serving response -----------------------------------
RESPONSE_COLUMNS = (
    "recipeid", "name", "recipecategory", "totaltime", "ingredient_count",
    "aggregatedrating", "reviewcount", "appeal_score", "seasonality_score",
    "availability_score", "sustainability_score", "coverage_score", "cluster_label",
    "matched_ingredients", "eufic_match_count", "faostat_match_count",
)

# --- Fixed values: words that mark text left in the source language -----------------
STEP_MARKERS = (
    "blend", "serve", "garnish", "with", "until", "smooth", "glass", "slice",
    "preheat", "oven", "mix", "cut", "cook", "stir", "pour",
)
MIXED_MARKERS = (
    "boneless", "skinless", "breasts", "english", "marinade", "fillets", "shrimp", "lamb",
    "skewers", "freezer", "bag", "kebab", "prepared", "thread", "grilling", "discarded",
    "platter", "slice", "serve", "blend", "garnish", "with", "until", "smooth", "glass",
)
MAX_STEP_MARKERS = 2
MIXED_MIN_MARKERS = 3
MIXED_MIN_SHARE = 0.12

# --- Fixed values: rule-based sentiment (published constants of Hutto & Gilbert 2014)
BOOST_UP = 0.293
BOOST_DOWN = -0.293
DAMPING = (1.0, 0.95, 0.9)
NEGATION_FACTOR = -0.74
NEVER_FACTOR = 1.25
BEFORE_CONTRAST = 0.5
AFTER_CONTRAST = 1.5
NORMALISE_ALPHA = 15.0
CONTRAST_WORD = "but"
BOOSTERS_UP = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
    "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "fully",
    "greatly", "highly", "hugely", "incredible", "incredibly", "intensely", "major",
    "majorly", "more", "most", "particularly", "purely", "quite", "really", "remarkably",
    "so", "substantially", "thoroughly", "total", "totally", "tremendous", "tremendously",
    "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
BOOSTERS_DOWN = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginal", "marginally",
    "occasional", "occasionally", "partly", "scarce", "scarcely", "slight", "slightly",
    "somewhat", "sorta",
)
PHRASE_BOOSTERS = (("just enough", -0.293), ("kind of", -0.293), ("sort of", -0.293))
IDIOMS = (
    ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("badass", 1.5), ("bus stop", 0.0),
    ("yeah right", -2.0), ("kiss of death", -1.5), ("to die for", 3.0), ("beating heart", 3.1),
    ("broken heart", -2.9),
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont",
    "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "neednt", "never",
    "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt",
    "uhuh", "wasnt", "werent", "without", "wont", "wouldnt", "rarely", "seldom", "despite",
)
