from palate.operators.aggregates import argmax_per_group, iceberg
from palate.operators.joins import lookup_join, spread_join
from palate.operators.profiles import cosine_components, cosine_to_target, user_profiles
from palate.operators.ranking import topk_ranked
from palate.operators.skyline import dominated, skyline
from palate.operators.staging import stage

__all__ = [
    "argmax_per_group",
    "cosine_components",
    "cosine_to_target",
    "dominated",
    "iceberg",
    "lookup_join",
    "skyline",
    "spread_join",
    "stage",
    "topk_ranked",
    "user_profiles",
]
