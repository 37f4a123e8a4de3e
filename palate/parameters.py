"""Parameters of the registered queries on the supplied test tables.

The library's defaults are the published thresholds. Averages on the test tables sit
near 2.75 and 0.5, where those select nothing; these select a part of each result at
sf0.01. Relevance thresholds are in basis points, as the derived scores are.
"""

RELEVANCE_SCALE = 10000.0
SCALE = 6  # decimals of every reported average
COMPARE_SCALE = 9  # decimals at which an average of averages is compared

MIN_COUNT = 210
MIN_AVG = 2.75
MIN_SCORE = 5500
MIN_MOVIES = 100
MIN_AVG_SCORE = 5800
MIN_DISTINCT = 115
MIN_LIKED = 4.0
TARGET = "42"
TOP_K = 10
ANOMALY_TAGS = ("NATION_3", "NATION_7", "NATION_11")
MIN_TAG_SCORE = 5200
MAX_RATING = 2.75
