from .columns import (category_group, dot, hash_bucket, inverted_threshold,
                      safe_ratio, sq_dist, sq_norm, threshold)

__all__ = ["category_group", "dot", "hash_bucket", "inverted_threshold",
           "safe_ratio", "sq_dist", "sq_norm", "threshold"]
