"""Results depend on these being exactly as stated."""

# Text patterns of the raw catalogue.
YEAR_PATTERN = r"\((\d{4})\)"
YEAR_STRIP_PATTERN = r"\s*\(\d{4}\)\s*"
GENRE_PATTERN = r"\|"

# The text that is embedded for one catalogue entry.
CONTEXT_TEMPLATE = "Filme: {title}. Gêneros: {genres}. Sinopse: {overview}"

# Ageing of ratings (days after which a rating counts half) and the popularity penalty.
HALF_LIFE_DAYS = 1460
POPULARITY_OFFSET = 9.0

# Factorisation and re-ranking.
RANK = 10
MAX_ITER = 10
REG_PARAM = 0.1
SEED = 42
CANDIDATES_PER_USER = 50
KEPT_PER_USER = 10

# Vectors and search.
EMBEDDING_DIM = 768
SEARCH_LIMIT = 5

# External lookup.
LOOKUP_INTERVAL_S = 0.1
DETAIL_DEFAULTS = {
    "overview": "",
    "poster_path": "",
    "budget": 0,
    "revenue": 0,
    "vote_average": 0.0,
}
