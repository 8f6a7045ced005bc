"""Fixed values that must equal the reference behaviour for equal results.

Everything here is data, stated plainly and in its natural order.
"""

# --- fixed values: category-code prefix -> domain (20 codes, 8 domains) ---
DOMAIN_MAP = {
    "cs": "computer_science",
    "econ": "economics",
    "q-fin": "finance",
    "stat": "statistics",
    "math": "mathematics",
    "eess": "electrical_engineering",
    "q-bio": "quantitative_biology",
    "physics": "physics",
    "astro-ph": "physics",
    "cond-mat": "physics",
    "gr-qc": "physics",
    "hep-ex": "physics",
    "hep-lat": "physics",
    "hep-ph": "physics",
    "hep-th": "physics",
    "math-ph": "physics",
    "nucl-ex": "physics",
    "nucl-th": "physics",
    "quant-ph": "physics",
    "nlin": "physics",
}

# --- fixed values: academic stopwords removed from unigrams only (26 words) ---
ACADEMIC_STOPWORDS = [
    "paper", "study", "result", "method", "using", "proposed", "based",
    "analysis", "data", "model", "approach", "results", "show", "new",
    "system", "used", "performance", "however", "also", "propose",
    "algorithm", "problem", "time", "two", "one", "different",
]

# --- fixed values: English stopwords (the 181-word default English list of
# Spark ML's StopWordsRemover; stands in for the NLTK list) ---
ENGLISH_STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
]

# --- fixed values: phrases counted per quarter (first-generation pipeline) ---
SEARCH_PHRASES = [
    "machine learning",
    "artificial intelligence",
    "large language",
    "climate change",
    "renewable energy",
    "electric vehicle",
    "electric vehicles",
    "covid pandemic",
    "social distancing",
    "public health",
]

# --- fixed values: paper URL built from an id (prefix + id + suffix) ---
PAPER_URL_PREFIX = "http://arxiv.org/abs/"
PAPER_URL_SUFFIX = "v1"

# --- fixed values: thresholds and parameters ---
MIN_DF = {1: 5, 2: 3, 3: 3}          # document-frequency floor per n-gram size
MIN_DOCS_PER_YEAR = 5                 # (category, year) cells with fewer docs are skipped
TOP_TERMS_PER_CATEGORY = 1000         # terms kept per category and n
NORM_SCALE = 10000.0                  # frequency per 10k papers
NORM_FREQ_CAP = 50000.0               # outlier filter on normalised frequency
GROWTH_PCT_CAP = 5000.0               # outlier filter on growth percent
GROWTH_MIN_END = 5                    # end-year volume floor for growth
MAX_REALISTIC_COUNT = 200000          # yearly count above this marks a bad row
TREND_R2_MIN = 0.5                    # trend quality floor
TREND_TOP_N = 5                       # trends kept per category
TRAIN_YEARS_BACK = 5                  # training window = max_year-5 .. max_year (six years)
FORECAST_TARGET_YEAR = 2030
PREDICT_MIN_POINTS = 3
PREDICT_HORIZON = 3
ROLLING_PERIODS = 4
BELL_TOP_N = 21
SUNBURST_TOP_N = 12
CATEGORY_TOP_N = 5
WORDCLOUD_MAX_WORDS = 150
YEAR_COLUMN_RANGE = (1990, 2030)
# Fixed value: year range of the sunburst chart's table.
SUNBURST_YEAR_RANGE = (1900, 2030)
# Header names of the term column, in order of preference.
TERM_ALIASES = ["bigram", "term", "keyword", "word", "ngram", "unnamed: 0", "_c0"]
FETCH_CAP_PER_PERIOD = 10000
