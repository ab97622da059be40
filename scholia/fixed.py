"""Word lists, constants and patterns whose exact content decides the results."""

# Article sources in search order.
SOURCES = ["PubMed", "CrossRef", "Scopus", "ScienceDirect", "ArXiv", "PLOS"]
NOISY_SOURCES = ["CrossRef", "ArXiv"]
PAYWALLED_SOURCES = ["Scopus", "ScienceDirect"]
OPEN_SOURCES = ["PubMed", "ArXiv"]
MAX_RESULTS = 20

# Region phrases for the geographic filter.
REGION_TERMS = [
    "Gulf of California",
    "Golfo de California",
    "Baja California Gulf",
    "California Gulf",
    "Mexican Pacific",
    "Pacífico mexicano",
    "Pacifico mexicano",
    "Mexico Pacific",
]

# Words that say nothing about the subject of a question.
GENERIC_WORDS = [
    "a", "an", "the", "in", "of", "on", "at", "to", "for", "by", "and", "or", "but", "with", "from", "into",
    "over", "under", "is", "are", "was", "were", "be", "been", "using", "based", "study", "review",
    "analysis", "model", "modeling", "modelling", "method", "approach", "system", "data", "result", "results",
    "performance", "evaluation", "assessment", "detection", "classification", "estimation", "prediction",
    "predicting", "forecast", "forecasting", "machine", "learning", "deep", "neural", "network", "algorithm",
    "framework", "technique", "novel", "new", "improved", "efficient", "robust", "accurate", "high", "low",
    "large", "small", "multiple", "various", "applied", "application", "applications", "toward", "towards",
]

# English stop words for embedding text.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its",
    "of", "on", "or", "that", "the", "to", "was", "will", "with", "this", "but", "can", "could", "do", "does",
    "did", "have", "had", "if", "me", "my", "not", "she", "so", "than", "them", "these", "they", "we", "what",
    "when", "where", "which", "who", "why", "you", "your", "how", "about", "between", "into", "through",
    "during", "before", "after", "above", "below", "up", "down", "out", "off", "over", "under", "again",
    "further", "then", "once",
]

# Knowledge-graph vocabulary.
ENTITY_TYPES = ["Species", "Method", "Location", "Concept", "Author", "Paper"]
RELATION_TYPES = [
    "studies", "found_in", "interacts_with", "measured_by", "published_in", "co_occurs_with",
]

# Population parameters, (source column, parameter, unit) per source table.
GROWTH_COLUMNS = [("K", "K", "yr⁻¹"), ("Loo", "Linf", "cm"), ("to", "t0", "yr")]
LENGTH_WEIGHT_COLUMNS = [("a", "a", "g·cm⁻ᵇ"), ("b", "b", "dimensionless")]
ECOLOGY_COLUMNS = [("FoodTroph", "TrophicLevel", "dimensionless")]
MATURITY_COLUMNS = [("Lm", "Lmat", "cm"), ("tm", "Amat", "yr")]
QB_COLUMNS = [("QB", "QB", "yr⁻¹")]
REQUIRED_PARAMETERS = ["K", "Linf", "t0", "a", "b", "TrophicLevel", "Lmat", "Amat", "QB"]
MISSING_SENTINELS = [-999.0, -9999.0]

# Messages of article validation.
PROBLEM_NO_TITLE = "Título vacío"
PROBLEM_NO_ABSTRACT = "Sin resumen (recomendado para mejor contexto)"
PROBLEM_SHORT_TITLE = "Título muy corto"
PROBLEM_SHORT_ABSTRACT = "Resumen muy corto"
PROBLEM_NO_AUTHORS = "Sin autores"
PROBLEM_NO_YEAR = "Sin año de publicación"
NO_DATA = "sin datos"

# Texts of the rendered context block.
CONTEXT_TITLE = "## Fragmentos de papers científicos relevantes\n"
CONTEXT_EMPTY = "No se encontraron fragmentos relevantes en el índice."
UNKNOWN_AUTHORS = "Autores desconocidos"
RELATIONS_TITLE = "Relaciones:"
GRAPH_TITLE = "## Grafo de conocimiento\n"
GRAPH_FRAGMENTS_TITLE = "## Fragmentos de papers científicos\n"

# BM25 defaults (Okapi with an epsilon floor for negative idf).
BM25_K1, BM25_B, BM25_EPSILON = 1.5, 0.75, 0.25

# Reciprocal rank fusion and the table channel.
RRF_K = 60
SEMANTIC_WEIGHT, KEYWORD_WEIGHT, TABLE_WEIGHT = 0.6, 0.4, 0.5
CANDIDATES, TABLE_CANDIDATES = 30, 80
TABLE_MIN_BM25, TABLE_RESERVED_MIN_BM25, TABLE_RESERVED_SLOTS = 5.0, 15.0, 2
TABLE_INNER_WEIGHT = 0.5
TOP_K = 8
MIN_SCORE = 0.2
