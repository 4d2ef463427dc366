
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import render
from weftline.functions.tokens import split_non_empty
from weftline.operators import (
    avg_count,
    cartesian,
    chain_word_count,
    distinct_keys,
    frequency_lists,
    grep,
    hotlist_filter,
    keyed_join,
    median_std,
    median_std_histogram,
    merge_averages,
    min_max_count,
    postings,
    replicated_join,
    token_lists,
    top_n,
    value_histogram,
    word_count,
)
from weftline.plans import block_sums, chain_metrics, count_bin_enrich, first_two_sum
from weftline.sources import (
    blocks_of_rows,
    listed_words,
    parse_docs,
    parse_entities,
    parse_pairs,
    parse_profiles,
    random_posts,
    read_table,
    spread,
)

try:  # the corpus operators, and what they import, can be left out as a whole
    import corpus_pipeline
    from weftline.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

SEED = 42
GREP_PATTERN = r"[A-Za-z0-9._%+-]@[A-Za-z0-9.-]+\.[A-Za-z]{2,}|[Ll]icense"
BLOCK = 4
POSTING_CHUNK = 64
HEAVY_NATION = 0.04


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents"), "doc_id")


def _lines(df: DataFrame, key: str, line: str, *columns: str) -> DataFrame:
    """``id`` and the columns joined to one line that starts with the id."""
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in (key, *columns)])
    return df.select(F.col(key).alias("id"), text.alias(line))


def _tokens(df: DataFrame, text: str) -> DataFrame:
    tokens = df.select(F.explode(split_non_empty(F.col(text))).alias("token"))
    return tokens.where("token <> ''").distinct()


# --- line formats -----------------------------------------------------------


def _parse_pairs(spark, sf):
    line = F.concat_ws(" ", "l_suppkey", F.col("l_quantity").cast("int"))
    return parse_pairs(read_table(spark, sf, "lineitem").select(line.alias("value")))


def _parse_docs(spark, sf):
    """Host and path of a URL between the colons that end the id and the body."""
    rest = F.element_at(F.split("url", ":"), 2)
    line = F.concat_ws(":", F.col("page_id").cast("string"), rest, "url")
    return parse_docs(read_table(spark, sf, "pages").select(line.alias("value")))


def _parse_entities(spark, sf):
    line = F.concat_ws(" ", "o_custkey", "o_orderkey", "o_orderpriority")
    return parse_entities(read_table(spark, sf, "orders").select(line.alias("value")))


def _parse_profiles(spark, sf):
    line = F.concat_ws(
        " ", "c_custkey", F.lit("firstName:"), "c_name",
        F.lit("reputation:"), F.col("c_acctbal").cast("decimal(12,2)"),
    )
    return parse_profiles(read_table(spark, sf, "customer").select(line.alias("value")))


# --- counts and summaries ---------------------------------------------------


def _word_count(spark, sf):
    return word_count(_documents(spark, sf), "text")


def _chain_word_count(spark, sf):
    return chain_word_count(_documents(spark, sf), "text")


def _quantities(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("id"), F.col("l_quantity").cast("int").alias("freq")
    )


def _min_max_count(spark, sf):
    return min_max_count(_quantities(spark, sf))


def _min_max_lines(spark, sf):
    summary = min_max_count(_quantities(spark, sf))
    return summary.select(
        F.concat_ws("\t", F.col("id").cast("string"), render.min_max()).alias("line")
    )


def _avg_count(spark, sf):
    out = avg_count(_quantities(spark, sf))
    return out.withColumn("average", F.round("average", 6))


def _avg_count_merged(spark, sf):
    quantities = read_table(spark, sf, "lineitem").select(
        F.struct("l_suppkey", "l_returnflag").alias("part"),
        F.col("l_quantity").cast("int").alias("freq"),
    )
    parts = avg_count(quantities, "part").select(
        F.col("part.l_suppkey").alias("id"), "cnt", "average"
    )
    return merge_averages(parts).withColumn("average", F.round("average", 6))


def _median_std(spark, sf):
    out = median_std(_quantities(spark, sf))
    return out.withColumn("std", F.round("std", 6))


def _median_std_histogram(spark, sf):
    prices = read_table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        "l_returnflag",
        F.col("l_extendedprice").alias("freq"),
    )
    parts = value_histogram(prices, ["id", "l_returnflag"])
    out = median_std_histogram(parts)
    return out.withColumn("std", F.round("std", 4))


def _avg_count_lines(spark, sf):
    halves = F.ceil(F.avg("l_quantity") * 2) / 2
    summary = read_table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(
        F.count("*").alias("cnt"), halves.alias("average")
    )
    return summary.select(
        F.concat_ws("\t", F.col("id").cast("string"), render.count_average()).alias("line")
    )


def _median_std_lines(spark, sf):
    summary = median_std(_quantities(spark, sf)).withColumn("std", F.ceil(F.col("std") * 2) / 2)
    return summary.select(
        F.concat_ws("\t", F.col("id").cast("string"), render.median_std()).alias("line")
    )


def _inverted_index(spark, sf):
    return postings(_documents(spark, sf), "doc_id", "text")


def _inverted_index_lists(spark, sf):
    lists = token_lists(_documents(spark, sf), "doc_id", "text", chunk_docs=POSTING_CHUNK)
    return lists.select("token", "chunk", render.id_list("doc_ids").alias("doc_ids"))


def _inverted_index_by_frequency(spark, sf):
    """Rare tokens with one list, frequent ones with several."""
    lists = frequency_lists(_documents(spark, sf), "doc_id", "text", list_ids=POSTING_CHUNK)
    return lists.select("token", "chunk", render.id_list("doc_ids").alias("doc_ids"))


# --- filters ------------------------------------------------------------------


def _distinct_keys(spark, sf):
    return distinct_keys(read_table(spark, sf, "events"), "user_id")


def _distributed_grep(spark, sf):
    found = grep(_documents(spark, sf), GREP_PATTERN, "text")
    return found.select("doc_id", "text")


def _distributed_grep_ids(spark, sf):
    return distinct_keys(grep(_documents(spark, sf), GREP_PATTERN, "text"), "doc_id")


def _hotlist_filter(spark, sf):
    words = _tokens(read_table(spark, sf, "benchmark"), "text")
    kept = hotlist_filter(_documents(spark, sf), words, text="text")
    return kept.select("doc_id", "text")


def _hotlist_filter_joined(spark, sf):
    words = _tokens(read_table(spark, sf, "part"), "p_name").union(
        _tokens(read_table(spark, sf, "benchmark"), "text")
    )
    conversations = read_table(spark, sf, "conversations")
    kept = hotlist_filter(conversations, words, text="text", inline_rows=0)
    return kept.select("conv_id", "turn", "text")


def _top_ten(spark, sf):
    return top_n(
        read_table(spark, sf, "orders"),
        10,
        key="o_custkey",
        payload="o_orderpriority",
        order_by="o_orderkey",
    )


# --- joins ----------------------------------------------------------------------


def _labels_and_events(spark, sf):
    labels = read_table(spark, sf, "labels")
    events = read_table(spark, sf, "events")
    return (
        _lines(labels, "doc_id", "left_line", "quality", "toxic"),
        _lines(events, "user_id", "right_line", "event_id", "event_type"),
    )


def _join_inner(spark, sf):
    """Labels without an event, and events of users without a label, on either side."""
    return keyed_join(*_labels_and_events(spark, sf), "inner")


def _join_leftouter(spark, sf):
    return keyed_join(*_labels_and_events(spark, sf), "leftouter")


def _join_rightouter(spark, sf):
    labels, pages = read_table(spark, sf, "labels"), read_table(spark, sf, "pages")
    return keyed_join(
        _lines(labels, "doc_id", "left_line", "quality", "toxic"),
        _lines(pages, "page_id", "right_line", "url"),
        "rightouter",
    )


def _join_orders_items(spark, sf):
    orders, items = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    return keyed_join(
        _lines(orders, "o_orderkey", "left_line", "o_custkey", "o_orderpriority"),
        _lines(items, "l_orderkey", "right_line", "l_linenumber", "l_partkey", "l_returnflag"),
        "leftouter",
    )


def _join_skewed(spark, sf):
    """Nations with many customers are joined apart from the others."""
    customers, suppliers = read_table(spark, sf, "customer"), read_table(spark, sf, "supplier")
    return keyed_join(
        _lines(customers, "c_nationkey", "left_line", "c_custkey"),
        _lines(suppliers, "s_nationkey", "right_line", "s_suppkey"),
        "fullouter",
        heavy_share=HEAVY_NATION,
        heavy_min_rows=1,
    )


def _join_fullouter(spark, sf):
    return keyed_join(*_labels_and_events(spark, sf), "fullouter")


def _join_anti(spark, sf):
    return keyed_join(*_labels_and_events(spark, sf), "anti")


def _replicated_join_inner(spark, sf):
    orders = _lines(read_table(spark, sf, "orders"), "o_custkey", "big_line", "o_orderkey")
    labels = read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"),
        F.concat_ws(" ", "quality", "toxic").alias("small_line"),
        "quality",
    )
    return replicated_join(orders, labels, "inner", order_by="quality")


def _replicated_join_leftouter(spark, sf):
    orders = read_table(spark, sf, "orders")
    events = read_table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("small_line"), "event_id"
    )
    comments = _lines(orders, "o_custkey", "big_line", "o_orderkey")
    return replicated_join(comments, events, "leftouter", order_by="event_id")


def _cartesian_product(spark, sf):
    return cartesian(
        read_table(spark, sf, "customer"),
        read_table(spark, sf, "nation"),
        left_line="c_name",
        right_line="n_name",
    )


# --- chained plans, blocks, generator -------------------------------------------


def _job_chaining(spark, sf):
    """Some customers have a label of their number, others none."""
    labels = read_table(spark, sf, "labels").withColumn("mark", F.col("quality").cast("string"))
    return count_bin_enrich(
        read_table(spark, sf, "orders"),
        labels,
        key="o_custkey",
        user_key="doc_id",
        attribute="mark",
        order_by="toxic",
    )


def _job_chaining_bins(spark, sf):
    return _job_chaining(spark, sf).groupBy("bin").agg(F.count("*").alias("cnt"))


def _chain_metrics(spark, sf):
    return chain_metrics(read_table(spark, sf, "orders"), "o_custkey")


def _n_line_records(spark, sf):
    line = F.concat_ws(" ", "user_id", F.col("value").cast("decimal(18,4)"))
    events = read_table(spark, sf, "events").select("event_id", line.alias("line"))
    return blocks_of_rows(events, BLOCK, order="event_id", line="line")


def _multiline_sum(spark, sf):
    total = F.col("user_id") + F.col("value").cast("decimal(18,4)")
    sums = block_sums(read_table(spark, sf, "events"), BLOCK, order="event_id", value=total)
    return sums.withColumn("total", F.col("total").cast("double"))


def _first_two_sum(spark, sf):
    orders = _lines(
        read_table(spark, sf, "orders"), "o_custkey", "line", "o_orderkey", "o_orderpriority"
    )
    numbered = orders.withColumn("line_no", F.split_part("line", F.lit(" "), F.lit(2)).cast("bigint"))
    return block_sums(numbered, BLOCK, order="line_no", value=first_two_sum("line"))


def _random_data_generator(spark, sf):
    rows = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("row"))
    words = listed_words(_tokens(_documents(spark, sf), "text"))
    return random_posts(rows, words, SEED)


def entry(spark: SparkSession) -> DataFrame:
    """Word count over the smallest documents table."""
    return _word_count(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "parse_pairs": _parse_pairs,
        "parse_docs": _parse_docs,
        "parse_entities": _parse_entities,
        "parse_profiles": _parse_profiles,
        "word_count": _word_count,
        "chain_word_count": _chain_word_count,
        "min_max_count": _min_max_count,
        "min_max_lines": _min_max_lines,
        "avg_count": _avg_count,
        "avg_count_merged": _avg_count_merged,
        "avg_count_lines": _avg_count_lines,
        "median_std": _median_std,
        "median_std_lines": _median_std_lines,
        "median_std_histogram": _median_std_histogram,
        "inverted_index": _inverted_index,
        "inverted_index_lists": _inverted_index_lists,
        "inverted_index_by_frequency": _inverted_index_by_frequency,
        "distinct_keys": _distinct_keys,
        "distributed_grep": _distributed_grep,
        "distributed_grep_ids": _distributed_grep_ids,
        "hotlist_filter": _hotlist_filter,
        "hotlist_filter_joined": _hotlist_filter_joined,
        "top_ten": _top_ten,
        "reduce_side_join_inner": _join_inner,
        "reduce_side_join_leftouter": _join_leftouter,
        "reduce_side_join_rightouter": _join_rightouter,
        "reduce_side_join_fullouter": _join_fullouter,
        "reduce_side_join_anti": _join_anti,
        "reduce_side_join_orders": _join_orders_items,
        "reduce_side_join_skewed": _join_skewed,
        "replicated_join_inner": _replicated_join_inner,
        "replicated_join_leftouter": _replicated_join_leftouter,
        "cartesian_product": _cartesian_product,
        "job_chaining": _job_chaining,
        "job_chaining_bins": _job_chaining_bins,
        "chain_metrics": _chain_metrics,
        "n_line_records": _n_line_records,
        "multiline_sum": _multiline_sum,
        "first_two_sum": _first_two_sum,
        "random_data_generator": _random_data_generator,
    } | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {}


# --- SQL oracles ------------------------------------------------------------------

_SPACE = r"[ \t\n\x0B\f\r]+"
_SPACE_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_TOKENIZER = r"[ \t\n\r\f]+"


def _sql_words(table: str, column: str) -> str:
    return (
        f"select unnest(regexp_split_to_array({column}, '{_TOKENIZER}')) as token from {table}"
    )


_SQL_DOC_TOKENS = f"""
  select doc_id, unnest(regexp_split_to_array(text, '{_SPACE}')) as token from documents"""

_SQL_QUANTITIES = "select l_suppkey as id, cast(trunc(l_quantity) as int) as freq from lineitem"

_SQL_LABELS = "select doc_id as id, concat_ws(' ', doc_id, quality, toxic) as l from labels"
_SQL_EVENTS = "select user_id as id, concat_ws(' ', user_id, event_id, event_type) as r from events"

_SQL_POSTS = "select o_custkey as user_id, count(*) as posts from orders group by 1"
_SQL_BINNED = f"""
  with counts as ({_SQL_POSTS}),
  g as (select sum(posts) / cast(count(*) as double) as a from counts)
  select user_id, posts, cast(quality as varchar) as attribute,
    case when posts < a then 'multiplebelow' else 'multipleabove' end as bin
  from counts cross join g left join labels on doc_id = user_id"""


def _sql_hex(digits: str, start: str, length: int) -> str:
    return f"cast('0x' || substr({digits}, {start}, {length}) as bigint)"


_SQL_RANDOM = f"""
  with vocabulary as (
    select distinct token as word from ({_sql_words('documents', 'text')}) t where token <> ''),
  words as (
    select row_number() over (order by substr(md5(word), 1, 3), word) - 1 as idx, word
    from vocabulary),
  size as (select count(*) as v from words),
  posts as (
    select o_orderkey as row, md5('{SEED}:' || o_orderkey || ':a') as a,
      md5('{SEED}:' || o_orderkey || ':b') as b
    from orders),
  slots as (
    select row, i, {_sql_hex("md5('" + str(SEED) + ":' || row || ':w' || (i // 4))",
                             'i % 4 * 8 + 1', 8)} % v as idx
    from (select row, unnest(range(1 + {_sql_hex('b', '25', 8)} % 30)) as i from posts) s
    cross join size),
  texts as (
    select row, string_agg(word, ' ' order by i) || ' ' as text
    from slots join words using (idx) group by row),
  clock as (
    select *, {_sql_hex('b', '13', 12)} % (6210 * 86400000::bigint) as ms from posts)
  select row, {_sql_hex('a', '1', 12)} % 1000000000 as id,
    {_sql_hex('a', '13', 12)} % 100000000 as post_id,
    {_sql_hex('a', '25', 8)} % 15000 as score, text,
    strftime(timestamp '2008-01-01 00:00:00' + to_milliseconds(ms), '%Y-%m-%dT%H:%M:%S.%g')
      as creation_date,
    {_sql_hex('b', '1', 12)} % 1000000 as user_id
  from clock join texts using (row)"""


def oracle_sql() -> dict[str, str]:
    return {
        "parse_pairs": """
          select cast(l_suppkey as int) as id, cast(trunc(l_quantity) as int) as freq
          from lineitem""",
        "parse_docs": """
          select cast(page_id as int) as id, split_part(url, ':', 2) as body,
            page_id || ':' || split_part(url, ':', 2) || ':' || url as value
          from pages""",
        "parse_entities": """
          select cast(o_custkey as int) as id,
            concat_ws(' ', o_custkey, o_orderkey, o_orderpriority) as value
          from orders""",
        "parse_profiles": """
          select cast(c_custkey as varchar) as user_id,
            cast(cast(c_acctbal as decimal(12,2)) as varchar) as attribute
          from customer""",
        "word_count": f"""
          select token, count(*) as cnt from (
            select unnest(case when text = '' then [''] when body = '' then []::varchar[]
              else regexp_split_to_array(body, '{_SPACE}') end) as token
            from (select text, rtrim(text, {_SPACE_CHARS}) as body from documents) d) t
          group by token""",
        "chain_word_count": f"""
          select upper(replace(token, 'ß', 'SS')) as token, count(*) as cnt
          from ({_sql_words('documents', 'text')}) t where token <> '' group by 1""",
        "min_max_count": f"""
          select id, min(freq) as min_freq, max(freq) as max_freq, count(*) as cnt
          from ({_SQL_QUANTITIES}) t group by id""",
        "min_max_lines": f"""
          select id || chr(9) || 'Min: ' || min(freq) || ' Max: ' || max(freq)
            || ' Count: ' || count(*) as line
          from ({_SQL_QUANTITIES}) t group by id""",
        "avg_count": f"""
          select id, count(*) as cnt, round(avg(freq), 6) as average
          from ({_SQL_QUANTITIES}) t group by id""",
        "avg_count_merged": f"""
          select id, count(*) as cnt, round(avg(freq), 6) as average
          from ({_SQL_QUANTITIES}) t group by id""",
        "avg_count_lines": """
          select l_suppkey || chr(9) || cast(cast(count(*) as float) as varchar) || chr(9)
            || cast(cast(ceil(avg(l_quantity) * 2) / 2 as float) as varchar) as line
          from lineitem group by l_suppkey""",
        "median_std_lines": f"""
          select id || chr(9) || cast(cast(median(freq) as float) as varchar) || ' '
            || coalesce(cast(cast(ceil(stddev_samp(freq) * 2) / 2 as float) as varchar), 'NaN')
            as line
          from ({_SQL_QUANTITIES}) t group by id""",
        "median_std": f"""
          select id, cast(median(freq) as double) as median, round(stddev_samp(freq), 6) as std
          from ({_SQL_QUANTITIES}) t group by id""",
        "median_std_histogram": """
          select l_suppkey as id,
            median(l_extendedprice) as median, round(stddev_samp(l_extendedprice), 4) as std
          from lineitem group by 1""",
        "inverted_index": f"""
          select token, doc_id, count(*) as tf from ({_SQL_DOC_TOKENS}) t
          where token <> '' group by token, doc_id""",
        "inverted_index_lists": f"""
          select token, doc_id // {POSTING_CHUNK} as chunk,
            ': ' || string_agg(cast(doc_id as varchar), ' ' order by doc_id) as doc_ids
          from ({_SQL_DOC_TOKENS}) t where token <> '' group by 1, 2""",
        "inverted_index_by_frequency": f"""
          with tokens as (select * from ({_SQL_DOC_TOKENS}) t where token <> ''),
          counts as (
            select token, count(*) as n, min(doc_id) as low, max(doc_id) as high
            from tokens group by 1),
          ranges as (
            select token, low, case when n > {POSTING_CHUNK} then least(
              (high - low + (n + {POSTING_CHUNK - 1}) // {POSTING_CHUNK})
                // ((n + {POSTING_CHUNK - 1}) // {POSTING_CHUNK}), {64 * POSTING_CHUNK}) end as width
            from counts)
          select token, coalesce((doc_id - low) // width, 0) as chunk,
            ': ' || string_agg(cast(doc_id as varchar), ' ' order by doc_id) as doc_ids
          from tokens join ranges using (token) group by 1, 2""",
        "distinct_keys": "select distinct user_id from events",
        "distributed_grep": f"""
          select doc_id, text from documents where regexp_matches(text, '{GREP_PATTERN}')""",
        "distributed_grep_ids": f"""
          select distinct doc_id from documents where regexp_matches(text, '{GREP_PATTERN}')""",
        "hotlist_filter": f"""
          select doc_id, text from documents where doc_id in (
            select doc_id from ({_SQL_DOC_TOKENS}) t where token in (
              select token from ({_sql_words('benchmark', 'text')}) h) and token <> '')""",
        "hotlist_filter_joined": f"""
          select conv_id, turn, text from conversations where (conv_id, turn) in (
            select (conv_id, turn) from (
              select conv_id, turn, unnest(regexp_split_to_array(text, '{_SPACE}')) as token
              from conversations) t
            where token <> '' and token in (
              select token from ({_sql_words('part', 'p_name')}) p
              union all select token from ({_sql_words('benchmark', 'text')}) h))""",
        "top_ten": """
          select o_custkey, arg_max(o_orderpriority, o_orderkey) as o_orderpriority
          from orders group by 1 order by 1 desc limit 10""",
        "reduce_side_join_inner": f"""
          select a.id, l as left_line, r as right_line
          from ({_SQL_LABELS}) a join ({_SQL_EVENTS}) b on a.id = b.id""",
        "reduce_side_join_leftouter": f"""
          select a.id, l as left_line, coalesce(r, 'EmptyText') as right_line
          from ({_SQL_LABELS}) a left join ({_SQL_EVENTS}) b on a.id = b.id""",
        "reduce_side_join_rightouter": f"""
          select page_id as id, coalesce(l, 'EmptyText') as left_line,
            concat_ws(' ', page_id, url) as right_line
          from ({_SQL_LABELS}) a right join pages on a.id = page_id""",
        "reduce_side_join_orders": """
          select o_orderkey as id,
            concat_ws(' ', o_orderkey, o_custkey, o_orderpriority) as left_line,
            case when l_orderkey is null then 'EmptyText'
              else concat_ws(' ', l_orderkey, l_linenumber, l_partkey, l_returnflag)
              end as right_line
          from orders left join lineitem on o_orderkey = l_orderkey""",
        "reduce_side_join_skewed": """
          select coalesce(c_nationkey, s_nationkey) as id,
            case when c_custkey is null then 'EmptyText'
              else concat_ws(' ', c_nationkey, c_custkey) end as left_line,
            case when s_suppkey is null then 'EmptyText'
              else concat_ws(' ', s_nationkey, s_suppkey) end as right_line
          from customer full join supplier on c_nationkey = s_nationkey""",
        "reduce_side_join_fullouter": f"""
          select coalesce(a.id, b.id) as id, coalesce(l, 'EmptyText') as left_line,
            coalesce(r, 'EmptyText') as right_line
          from ({_SQL_LABELS}) a full join ({_SQL_EVENTS}) b on a.id = b.id""",
        "reduce_side_join_anti": f"""
          select coalesce(a.id, b.id) as id, coalesce(l, 'EmptyText') as left_line,
            coalesce(r, 'EmptyText') as right_line
          from ({_SQL_LABELS}) a full join ({_SQL_EVENTS}) b on a.id = b.id
          where a.id is null or b.id is null""",
        "replicated_join_inner": """
          select o_custkey as id, concat_ws(' ', o_custkey, o_orderkey) as big_line,
            concat_ws(' ', quality, toxic) as small_line
          from orders join labels on doc_id = o_custkey""",
        "replicated_join_leftouter": """
          select o_custkey as id, concat_ws(' ', o_custkey, o_orderkey) as big_line,
            coalesce(small_line, 'emptyText') as small_line
          from orders left join (
            select user_id, arg_max(event_type, event_id) as small_line
            from events group by 1) e on user_id = o_custkey""",
        "cartesian_product": """
          select c_name as left_line, n_name as right_line from customer cross join nation""",
        "job_chaining": _SQL_BINNED,
        "job_chaining_bins": f"select bin, count(*) as cnt from ({_SQL_BINNED}) t group by bin",
        "chain_metrics": f"""
          select cast(sum(posts) as bigint) as records, count(*) as users,
            sum(posts) / cast(count(*) as double) as avg_posts
          from ({_SQL_POSTS}) t""",
        "n_line_records": f"""
          select min(event_id) as first_line,
            string_agg(user_id || ' ' || cast(value as decimal(18,4)), chr(10) order by event_id)
              || chr(10) as record
          from events group by event_id // {BLOCK}""",
        "multiline_sum": f"""
          select min(event_id) as first_line,
            cast(sum(user_id + cast(value as decimal(18,4))) as double) as total
          from events group by event_id // {BLOCK}""",
        "first_two_sum": f"""
          select min(o_orderkey) as first_line, cast(sum(o_custkey + o_orderkey) as bigint) as total
          from orders group by o_orderkey // {BLOCK}""",
        "random_data_generator": _SQL_RANDOM,
    } | (llm.oracle_sql() if llm else {})
