from weftline.plans.blocks import block_sums, first_two_sum
from weftline.plans.chaining import chain_metrics, count_bin_enrich

__all__ = ["block_sums", "chain_metrics", "count_bin_enrich", "first_two_sum"]
