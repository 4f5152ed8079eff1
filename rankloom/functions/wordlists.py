"""Word lists and lookup tables that results depend on."""

# English stop words (179), natural order.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how
all any both each few more most other some such no nor not only own same so
than too very s t can will just don don't should should've now d ll m o re ve y
ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't
shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn
wouldn't
""".split()

# Irregular noun plurals resolved before the suffix rules.
IRREGULAR_LEMMAS = {
    "children": "child",
    "men": "man",
    "women": "woman",
    "feet": "foot",
    "geese": "goose",
    "mice": "mouse",
    "teeth": "tooth",
    "lives": "life",
    "knives": "knife",
    "leaves": "leaf",
    "shelves": "shelf",
    "analyses": "analysis",
    "criteria": "criterion",
    "matrices": "matrix",
    "indices": "index",
}

# Noun suffix rules, tried in order; the first that matches wins.
LEMMA_SUFFIXES = [
    ("sses", "ss"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("ies", "y"),
]
# Endings that look like a plural but are not.
LEMMA_KEEP = ["ss", "us", "is"]

# Gendered pronouns and their neutral forms.
NEUTRAL_PRONOUNS = {
    "he": "they",
    "she": "they",
    "him": "them",
    "her": "their",
    "his": "their",
    "hers": "theirs",
    "himself": "themselves",
    "herself": "themselves",
}

# Section weights.
OVERALL_WEIGHTS = {"skills": 40, "experience": 30, "education": 15, "projects": 15}  # percent
BORDA_WEIGHTS = {"education": 20, "workexp": 60, "personal_projects": 15, "misc": 5}  # percent
FIT_THRESHOLD = 40

# Status codes.
STATUS_UPLOADED, STATUS_UNFIT, STATUS_FIT = -2, -1, 0
JOB_NEW, JOB_DONE = 0, 1

ENTITY_KINDS = ("ORG", "GPE", "NORP")

# Degree ladder, highest first: label and the words that show it.
DEGREES = [
    ("PhD", "phd|ph\\.d|doctorate|doctoral"),
    ("Master's", "master|msc|m\\.s\\.|mba"),
    ("Bachelor's", "bachelor|bsc|b\\.s\\.|undergraduate degree"),
]

# Section headings of a CV, lower case.
SECTION_HEADINGS = {
    "education": "education|academic background|qualifications",
    "workexp": "experience|work experience|professional experience|employment|employment history",
    "personal_projects": "projects|personal projects|academic projects",
    "misc": "skills|technical skills|awards|certificates|certifications|publications|summary|languages",
}

REDACTED = "[REDACTED]"
