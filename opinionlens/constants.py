"""Word lists, patterns, lookup tables and default thresholds.

Every list here is only the *default* of a function parameter; callers with
another topic, another set of places or other classes pass their own.
"""

from __future__ import annotations

# --- fixed values: keyword lists of the two compared subjects -----------------

KEYWORDS_A = [
    "trump",
    "donald trump",
    "maga",
    "trump2024",
    "make america great again",
    "vote trump",
    "vote red",
]

KEYWORDS_B = [
    "harris",
    "kamala",
    "kamala harris",
    "harris2024",
    "vote harris",
    "vote blue",
    "democrats",
]

# --- fixed values: stop words added to the default English list ---------------

EXTRA_STOPWORDS = [
    "amp", "rt", "https", "http", "co", "www", "com", "tweet",
    "election", "elections", "2024",
]

TOPIC_STOPWORDS = EXTRA_STOPWORDS + [
    "trump", "donald", "donaldtrump", "maga", "harris", "kamala", "kamalaharris",
    "biden", "joe", "joebiden", "gop", "democrat", "democrats", "republican",
    "republicans", "president", "election", "vote", "voting", "voted",
    "arizona", "georgia", "michigan", "nevada", "carolina", "north",
    "pennsylvania", "wisconsin",
    "like", "people", "one", "get", "know", "think", "said", "even", "going",
    "time", "need", "right", "want", "make", "new", "see", "say", "says", "way",
    "also", "really", "much", "probably", "thing", "things", "still", "last",
    "ever", "well", "got", "didn", "doesn", "won",
]

# --- fixed values: stance patterns, negative class first ----------------------

NEG_PATTERNS = [
    r"\bvote\s+blue\b",
    r"#voteblue\b",
    r"\bnever\s+trump\b",
    r"\bstop\s+trump\b",
    r"\bdefeat\s+trump\b",
    r"\bdump\s+trump\b",
    r"\bfuck\s+(donald\s+)?trump\b",
    r"\bfuck\s+maga\b",
    r"\banti[-\s]?trump\b",
    r"\banti[-\s]?maga\b",
    r"\btrump\b.{0,80}\b(rapist|convicted felon|sexual abuser|pedophile|treason)\b",
    r"\b(chickenshit|coward|afraid)\b.{0,80}\btrump\b",
    r"\btrump\b.{0,80}\b(chickenshit|coward|afraid)\b",
]

POS_PATTERNS = [
    r"\bvote\s+trump\b",
    r"\bvote\s+red\b",
    r"\btrump\s*2024\b",
    r"#trump2024\b",
    r"#trumptosaveamerica\b",
    r"\bmake\s+america\s+great\s+again\b",
    r"\bkamala\b.{0,100}\b(tds|destroy|catastrophe|worst|weak|failed|liar|corrupt)\b",
    r"\bharris\b.{0,100}\b(tds|destroy|catastrophe|worst|weak|failed|liar|corrupt)\b",
    r"\bbiden\b.{0,100}\b(corrupt|weak|failed|destroyed|garbage)\b",
    r"\bdemocrats?\b.{0,100}\b(corrupt|weak|failed|destroyed|garbage)\b",
    r"\bwhy are you so obsessed with trump\b",
    r"\bworse case of tds\b",
    r"\bworst case of tds\b",
]

# --- fixed values: places -----------------------------------------------------

# File-name key -> state; the first key contained in the lower-cased name wins.
STATE_BY_FILE_KEY = {
    "arizona": "Arizona",
    "georgia": "Georgia",
    "michigan": "Michigan",
    "nevada": "Nevada",
    "north_carolina": "North Carolina",
    "pennsylvania": "Pennsylvania",
    "wisconsin": "Wisconsin",
}

STATE_CODES = {
    "Arizona": "AZ",
    "Georgia": "GA",
    "Michigan": "MI",
    "Nevada": "NV",
    "North Carolina": "NC",
    "Pennsylvania": "PA",
    "Wisconsin": "WI",
}

UNKNOWN_PLACE = "Unknown"

# --- fixed values: emoji code-point ranges removed from text ------------------

EMOJI_RANGES = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2700, 0x27BF),
    (0x2600, 0x26FF),
    (0x1F900, 0x1F9FF),
    (0x1FA70, 0x1FAFF),
]

# --- fixed values: query defaults ---------------------------------------------

TOP_N = 100
MIN_TAG_COUNT = 20
COOCCURRENCE_WORDS = 50
COOCCURRENCE_PAIRS = 100
MIN_CITY_USERS = 1
TERMS_PER_CLUSTER = 15
KMEANS_K = 4
VOCAB_SIZE = 20_000
MIN_DF = 20.0
MAX_DF = 0.6
SVM_FEATURES = ("text", "hashtags", "description")
SVM_HASH_SIZE = 1 << 18
SVM_MAX_ITER = 50
SVM_REG = 0.1
TRAIN_PERCENT = 80
SEED = 42
MODEL_RETRIES = 3
MODEL_BACKOFF_SECONDS = 2.0
NO_TAGS_WORD = "none"

# --- fixed values: English stop words of Spark ML -----------------------------

ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

# --- names of the three orientations (ours) -----------------------------------

POS, NEG, BALANCED = "POS", "NEG", "BALANCED"
