from weftline.operators.bloom import BloomFilter, bloom_filter
from weftline.operators.counting import chain_word_count, word_count
from weftline.operators.filtering import distinct_keys, grep, hotlist_filter, top_n
from weftline.operators.inverted import frequency_lists, posting_lists, postings, token_lists
from weftline.operators.joins import (
    cartesian,
    grid_join,
    keyed_join,
    last_per_key,
    replicated_join,
)
from weftline.operators.summarize import (
    avg_count,
    median_std,
    median_std_histogram,
    merge_averages,
    min_max_count,
    value_histogram,
)

__all__ = [
    "BloomFilter", "avg_count", "bloom_filter", "cartesian", "chain_word_count", "distinct_keys",
    "frequency_lists", "grep", "grid_join", "hotlist_filter", "keyed_join", "last_per_key", "median_std",
    "median_std_histogram", "merge_averages", "min_max_count", "posting_lists",
    "postings", "replicated_join", "token_lists", "top_n", "value_histogram", "word_count",
]
