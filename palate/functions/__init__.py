from palate.functions.genres import NO_GENRES, explode_genres, genre_list
from palate.functions.numeric import cosine, fixed, pearson, weighted_mean

__all__ = ["NO_GENRES", "cosine", "explode_genres", "fixed", "genre_list", "pearson", "weighted_mean"]
