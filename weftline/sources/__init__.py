from weftline.sources.lines import (
    blocks_of_rows,
    n_line_records,
    number_lines,
    read_lines,
    read_ordered_lines,
)
from weftline.sources.parsers import (
    parse_docs,
    parse_entities,
    parse_pairs,
    parse_profiles,
    parse_words,
)
from weftline.sources.synthetic import (
    WordList,
    index_words,
    listed_words,
    random_posts,
    render_post,
    row_numbers,
)
from weftline.sources.tables import read_table, spread

__all__ = [
    "WordList", "blocks_of_rows", "index_words", "listed_words", "n_line_records", "number_lines",
    "parse_docs",
    "parse_entities", "parse_pairs", "parse_profiles", "parse_words", "random_posts",
    "read_lines", "read_ordered_lines", "read_table", "render_post", "row_numbers",
    "spread",
]
