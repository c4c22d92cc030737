"""Fixed values that results depend on: word lists, code tables and patterns."""

# --- fixed values: programme keywords, short list (matched as substrings) ---
RELATED_KEYWORDS = (
    "Census Bureau", "FSRDC", "Federal Statistical Research Data Center",
    "restricted microdata", "IRS", "BEA", "confidentiality review",
    "Michigan RDC", "Texas RDC", "Boston RDC",
    "Annual Survey of Manufactures", "Census of Construction Industries",
    "Census of Finance, Insurance, and Real Estate",
)

# --- fixed values: programme keywords, long list ---
RELATED_KEYWORDS_LONG = (
    "census bureau", "fsrdc", "federal statistical research data center",
    "restricted microdata", "irs", "bea", "confidentiality review",
    "michigan rdc", "texas rdc", "boston rdc", "cornell rdc", "berkeley rdc",
    "annual survey of manufactures", "census of construction industries",
    "census of finance, insurance, and real estate", "ncrdc", "nyc rdc",
    "longitudinal employer-household dynamics", "lehd", "ces", "qwi",
    "confidential data", "restricted data", "statistical disclosure limitation",
    "title 13", "title 26", "cbms", "sbo", "economic census",
)

# --- fixed values: keyword in a centre name -> standard centre name, in priority order ---
CENTRE_NAMES = (
    ("michigan", "Michigan RDC"),
    ("texas", "Texas RDC"),
    ("boston", "Boston RDC"),
    ("cornell", "Cornell RDC"),
    ("berkeley", "Berkeley RDC"),
    ("new york", "NYC RDC"),
    ("north carolina", "NCRDC"),
)
UNKNOWN_CENTRE = "Unknown RDC"

# --- fixed values: work type -> two-letter output type ---
OUTPUT_TYPE_CODES = {
    "book-chapter": "BC",
    "blog": "BG",
    "dissertation": "DI",
    "dataset": "DS",
    "journal-article": "JA",
    "mimeo": "MI",
    "mastersthesis": "MT",
    "report": "RE",
    "software": "SW",
    "technical-report": "TN",
    "working-paper": "WP",
}
OTHER_TYPE_CODE = "OT"

# --- fixed values: work type -> output type label ---
OUTPUT_TYPE_LABELS = {
    "journal-article": "Journal Article",
    "book": "Book",
    "book-chapter": "Book Chapter",
    "conference-paper": "Conference Paper",
    "dataset": "Dataset",
    "report": "Report",
    "patent": "Patent",
    "dissertation": "Dissertation",
    "review": "Review",
    "preprint": "Preprint",
}

# --- fixed values: substring of a document type -> output type ---
OUTPUT_TYPE_GUESSES = (
    ("journal", "Journal Article"),
    ("conference", "Conference Paper"),
    ("thesis", "Thesis"),
)

# --- fixed values: harmonised column -> source columns, in priority order ---
HARMONISED_ALIASES = {
    "author": ["author", "pi", "researchers", "project_pi", "projectpi"],
    "year": ["year", "projectendyear"],
    "title": ["title", "projecttitle"],
    "doi": ["doi"],
}

# --- fixed values: columns tried for the year and the topic of an output ---
YEAR_COLUMNS = ("OutputYear", "Year", "output_year", "year", "YEAR", "Publication_Year")
TOPIC_COLUMNS = ("PredictedTopic", "Topic", "predicted_topic", "topic", "TOPIC", "Topic_ID")

# --- fixed values: columns tried for the name of a project lead and a project title ---
PI_COLUMNS = ("author", "ProjectPI", "PI", "project_pi", "pi_name", "name")
PROJECT_TITLE_COLUMNS = ("title", "ProjectTitle", "project_title")

# --- fixed values: patterns ---
CITATION_VOLUME_ISSUE_PAGES = r"(\d+)\((\d+)\),\s*(\d+-\d+)"
CITATION_YEAR_VOLUME_ISSUE_PAGES = r"(\d{4})[,\s]*(\d+)\s*\((\d+)\)\s*,\s*([\d\-]+)"
CITATION_VOLUME = r"(?i)vol(?:ume)?\.?\s*(\d+)"
CITATION_ISSUE = r"(?i)(no|issue|nr)\.?\s*(\d+)"
CITATION_PAGES = r"(?i)p(?:p|ages)?\.?\s*(\d+\s*[-–]\s*\d+|\d+)"
CENTRE_WORD = r"(?i)\bRDC\b"
PROGRAMME_TAG = "fsrdc"
DEFAULT_PROJECT_TITLE = "FSRDC Project"
WORK_ID_PREFIX = "https://openalex.org/"

# --- fixed values: defaults written where a field is missing ---
UNKNOWN_PI = "Unknown PI"
UNTITLED_PROJECT = "Untitled Project"

# --- own pattern, made to run in linear time ---
# Words are spelled with Unicode letters and digits, which plain \w is not in Java. A match
# starts at the first letter of a run of words or at the programme tag: a later start in the
# same run could only find less, and trying it would cost quadratic time.
PROJECT_TITLE = (
    r"(?i)(?:(?<![\p{L}\p{N}_\s-])(?:FSRDC:?\s*)?|FSRDC:?\s*)"
    r"([\p{L}\p{N}_\s-]+?)(?:using|based|analysis|study|research|$)"
)
