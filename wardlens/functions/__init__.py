from wardlens.functions.expressions import (
    bbox_valid, bucketize, classify, contains_any, fold_case, map_codes, null_safe_flag, planar_km,
    standardize_address, with_share,
)

__all__ = ["bbox_valid", "bucketize", "classify", "contains_any", "fold_case", "map_codes",
           "null_safe_flag", "planar_km", "standardize_address", "with_share"]
