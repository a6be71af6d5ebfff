"""Word lists, priorities and tables that results depend on."""

# --- fixed values: source names and their preference ------------------------------------
COLLECT_SOURCES = (
    "france_travail",
    "welcome_to_the_jungle",
    "bpce",
    "region_ile_de_france",
    "postgresql_history",
    "hive_aggregates",
)
OFFER_SOURCES = (
    "bpce",
    "france_travail",
    "region_ile_de_france",
    "welcome_to_the_jungle",
    "postgresql_history",
)
STORE_SOURCES = (
    "adzuna",
    "bpce",
    "france_travail",
    "region_ile_de_france",
    "welcome_to_the_jungle",
)
AGGREGATE_SOURCE = "hive_aggregates"
SOURCE_PRIORITY = {
    "welcome_to_the_jungle": 60,
    "bpce": 55,
    "france_travail": 50,
    "region_ile_de_france": 45,
    "postgresql_history": 30,
}

# --- fixed values: scope keywords ---------------------------------------------------------
ROLE_KEYWORDS = (
    "data engineer", "ingenieur data", "ingenieur donnees", "data scientist", "data analyst",
    "analyste data", "analyste donnees", "analytics engineer", "machine learning engineer",
    "ingenieur machine learning", "mlops engineer", "ingenieur mlops", "ai engineer",
    "developpeur ia", "developpeur intelligence artificielle", "data architect",
    "architecte data", "business intelligence", "analyste bi", "consultant data",
    "consultant bi", "data platform engineer", "cloud data engineer", "developpeur etl",
    "ingenieur etl", "developpeur big data", "ingenieur big data", "dbt developer", "dataops",
    "llm engineer", "nlp engineer", "computer vision engineer",
)
FOCUS_KEYWORDS = (
    "data", "donnees", "database", "base de donnees", "bdd", "analytics", "analytique",
    "reporting", "decisionnel", "machine learning", "deep learning", "business intelligence",
    "etl", "ia", "ai", "mlops", "cloud", "big data", "dbt", "airflow", "databricks",
    "snowflake", "spark", "kafka", "power bi", "tableau", "looker", "nlp", "llm",
    "computer vision",
)
TECH_KEYWORDS = (
    "python", "sql", "spark", "pyspark", "snowflake", "databricks", "airflow", "dbt", "kafka",
    "aws", "azure", "gcp", "power bi", "tableau", "looker", "mlflow", "terraform", "docker",
    "kubernetes", "scala", "pandas",
)

# --- fixed values: contract aliases, tested in this order ----------------------------------
CONTRACT_ALIASES = (
    ("cdi", "cdi"),
    ("cdd", "cdd"),
    ("freelance", "freelance"),
    ("interim", "interim"),
    ("stage", "stage"),
    ("alternance", "alternance"),
    ("apprentissage", "alternance"),
    ("contrat apprentissage", "alternance"),
    ("contrat professionnalisation", "alternance"),
    ("professionnalisation", "alternance"),
    ("temps plein", "temps plein"),
    ("temps partiel", "temps partiel"),
)

# --- fixed values: tokens left out of signatures -------------------------------------------
SIGNATURE_STOPWORDS = (
    "h", "f", "hf", "h f", "h/f", "fh", "the", "de", "du", "des", "la", "le", "les", "d", "l",
    "en", "et", "pour", "with", "a", "to", "of", "senior", "junior", "alternance", "stage",
)

# --- fixed values: telework, salary and date markers ----------------------------------------
REMOTE_MARKERS = ("full remote", "100% remote", "teletravail total")
HYBRID_MARKERS = ("teletravail", "remote", "hybride")
ONSITE_MARKERS = ("sur site", "presentiel")
MONTHLY_MARKERS = ("mensuel", "mois", "monthly", "/month")
YEARLY_MARKERS = ("annuel", "an", "year", "yearly", "annum")
RELATIVE_DAYS = (("aujourdhui", 0), ("hier", 1), ("avant-hier", 2), ("avant hier", 2))
TRUE_WORDS = ("1", "true", "vrai", "yes", "oui", "on")
FALSE_WORDS = ("0", "false", "faux", "no", "non", "off")

# --- fixed values: patterns -----------------------------------------------------------------
AMOUNT_PATTERN = r"(\d+(?:[.,]\d+)?)\s*([kK])?"
AMOUNT_RANGE_PATTERN = (
    r"(\d+(?:[.,]\d+)?)\s*([kK])?\s*(?:a|à|-|to)\s*(\d+(?:[.,]\d+)?)\s*([kK])?"
)
OFFER_HREF_PATTERN = r"(?i)\A/fr/companies/[^/]+/jobs/[^/?#]+/?\n?\z"
PAGE_NUMBER_PATTERN = r"[?&]page=(\d+)"

# --- fixed values: completeness weights ------------------------------------------------------
COMPLETENESS_WEIGHTS = (
    ("external_id", 2),
    ("title", 3),
    ("company_name", 2),
    ("location_label", 2),
    ("published_at", 2),
    ("url", 2),
    ("description", 3),
    ("contract_type", 1),
)

# --- fixed values: URL schemes whose last path segment may carry ";params" ---------------------
PARAM_SCHEMES = (
    "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu", "imap", "sip", "sips", "mms",
    "sftp", "tel",
)

# --- fixed values: duplicate thresholds ---------------------------------------------------------
TITLE_RATIO_STRICT = 0.97
TITLE_RATIO_LOOSE = 0.94
COMPANY_RATIO = 0.94
LOCATION_RATIO = 0.85
LOCATION_RATIO_STRICT = 0.90
