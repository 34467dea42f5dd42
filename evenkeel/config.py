"""Fixed values of the corpus definition.

Everything here is a value that results depend on, stated once; operators take them as
parameters with these as defaults.
"""

SEED = 42

# Length gate, truncation, dedup prefix, split.
MIN_CHARS = 20
MAX_CHARS = 4000
GATE_FACTOR = 4
PREFIX_CHARS = 200
TRAIN_FRACTION = "0.8"
VAL_FRACTION = "0.1"
RARE_STRATUM_ROWS = 3

# Labels.
MEDICAL = 1
NON_MEDICAL = 0

# Fixed values: (source, label, row quota) in priority order.
SOURCE_QUOTAS = [
    ("pubmed", MEDICAL, 15000),
    ("medquad", MEDICAL, 5500),
    ("mtsamples", MEDICAL, 4500),
    ("wikipedia_medical", MEDICAL, 2000),
    ("medquestionpairs", MEDICAL, 3000),
    ("synthetic_casual", MEDICAL, 6000),
    ("agnews", NON_MEDICAL, 10500),
    ("newsgroups20", NON_MEDICAL, 4500),
    ("amazon_yelp", NON_MEDICAL, 10000),
    ("wikipedia_nonmedical", NON_MEDICAL, 2000),
]

# Search topics of the paged abstract source.
SEARCH_TOPICS = [
    "cardiology", "oncology", "diabetes", "infectious disease", "neurology",
    "psychiatry", "pediatrics", "dermatology", "orthopedics", "endocrinology",
    "gastroenterology", "pulmonology", "nephrology", "hematology", "rheumatology",
    "obstetrics", "surgery", "immunology", "public health", "pharmacology",
    "geriatrics", "emergency medicine", "radiology", "pathology", "anesthesiology",
]

# Seed categories of the two encyclopedia sources, walk depth and member cap.
MEDICAL_SEEDS = [
    "Category:Diseases and disorders",
    "Category:Symptoms and signs",
    "Category:Medical specialties",
    "Category:Drugs",
    "Category:Medical treatments",
    "Category:Infectious diseases",
    "Category:Mental and behavioural disorders",
]
NON_MEDICAL_SEEDS = [
    "Category:History by period",
    "Category:Sports",
    "Category:Technology",
    "Category:Video games",
    "Category:Cooking",
    "Category:Music genres",
    "Category:World economies",
]
MEMBERS_PER_CATEGORY = 200
WALK_DEPTH = 1

# Forum categories left out.
EXCLUDED_CATEGORIES = ["sci.med"]

LINK_FRAGMENT = "/diseases-conditions/"
MIN_ARTICLE_CHARS = 100

# Template generator and informality perturbation.
SYMPTOM_SHARE = 0.75
ATTEMPTS_PER_ROW = 20
CONTRACTION_SHARE = 0.4
DROP_QUESTION_SHARE = 0.3
CONTRACTIONS = [
    (" i've ", " ive "), (" it's ", " its "), (" don't ", " dont "),
    (" can't ", " cant "), (" i'm ", " im "), (" doesn't ", " doesnt "),
]
