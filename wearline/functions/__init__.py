"""Column expressions: labels, numeric clean-up and scaling, class probabilities."""

from wearline.functions.labels import binary_label, remaining_life, three_class_label
from wearline.functions.numeric import min_max_scaled, nan_to_num
from wearline.functions.probability import proba_columns, proba_map

__all__ = [
    "binary_label",
    "min_max_scaled",
    "nan_to_num",
    "proba_columns",
    "proba_map",
    "remaining_life",
    "three_class_label",
]
