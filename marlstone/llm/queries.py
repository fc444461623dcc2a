"""Queries over the text tables for the problems 8 to 10, with the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import leakage, tokenize, truncation
from marlstone.sources.tables import table


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return tokenize.encode(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as it comes back from its ids, null texts as empty ones."""
    return tokenize.decode(p8_ids(spark, folder), "doc_id", "ids").withColumnRenamed("id", "doc_id")


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return leakage.hits(docs, "doc_id", "text", table(spark, folder, "eval_item", "item_id", "text"), "item_id", "text")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a passage of a held-out item, with the items."""
    return _hits(spark, folder).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).distinct()


def p9_items(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents leak each item."""
    return p9_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


def p9_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The documents with leaks, their passages cut out."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    return leakage.without_spans(docs, "doc_id", "text", _hits(spark, folder)).withColumnRenamed("doc", "doc_id")


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.judged(table(spark, folder, "documents", "doc_id", "text", "source"), "doc_id", "text", "source")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """The documents whose text was cut off."""
    return _judged(spark, folder).filter("truncated").select(F.col("doc").alias("doc_id"))


def p10_sources(spark: SparkSession, folder: str) -> DataFrame:
    """How many texts of each source are cut."""
    return truncation.shares(_judged(spark, folder))


QUERIES = {"p8_ids": p8_ids, "p8_decoded": p8_decoded, "p9_found": p9_found, "p9_items": p9_items, "p9_cleaned": p9_cleaned, "p10_found": p10_found, "p10_sources": p10_sources}

GRAMS_SQL = """with i as (select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from eval_item where text is not null),
  d as (select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents where text is not null),
  g as (select distinct item_id, array_to_string(list_slice(w, k, k + 11), ' ') as gram from (select item_id, w, unnest(generate_series(1, len(w) - 11)) as k from i)),
  h as (select distinct doc_id, array_to_string(list_slice(w, k, k + 11), ' ') as gram from (select doc_id, w, unnest(generate_series(1, len(w) - 11)) as k from d)),
  f as (select distinct doc_id, item_id from h join g using (gram))"""

#: Words and what lies between them, put together again without the words of any window that hits.
CLEANED_SQL = """with i as (select regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from eval_item where text is not null),
  g as (select distinct array_to_string(list_slice(w, k, k + 11), ' ') as gram from (select w, unnest(generate_series(1, len(w) - 11)) as k from i)),
  d as (select doc_id, text, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents where text is not null),
  h as (select doc_id, k, array_to_string(list_slice(w, k, k + 11), ' ') as gram from (select doc_id, w, unnest(generate_series(1, len(w) - 11)) as k from d)),
  r as (select doc_id, list(distinct k) as ks from h semi join g using (gram) group by doc_id),
  p as (select d.doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}]+') as words, regexp_split_to_array(text, '[\\p{L}\\p{N}]+') as between, list_distinct(flatten(list_transform(ks, lambda k: generate_series(k, k + 11)))) as gone from d join r using (doc_id))
  select doc_id, between[1] || array_to_string(list_transform(generate_series(1, len(words)), lambda x: case when list_contains(gone, x) then '' else words[x] end || case when list_contains(gone, x) and list_contains(gone, x + 1) then '' else between[x + 1] end), '') as text,
    len(gone) as removed_words from p"""

RE2_TOKEN = truncation.TOKEN.replace("++", "+").replace("*+", "*")
SIGNS_SQL = r"regexp_extract({w}, '[^\p{L}9\s]+(?:\s*[^\p{L}9\s]+)*$')"
#: Words that begin with a last word are found by comparing it with every word of its context.
JUDGED_SQL = rf"""with d as (select doc_id, source, rtrim(text, '{truncation.BLANKS}') as t from documents where text is not null),
  f as (select *, case when regexp_matches(right(t, {truncation.LONGEST_OMISSION}), '{truncation.OMISSION}') then true when len(regexp_split_to_array(t, '{truncation.FENCE}')) % 2 = 0 then true
    when regexp_matches(string_split(t, chr(10))[-1], '{truncation.LINK}') then not regexp_matches(string_split(t, chr(10))[-1], '{truncation.WHOLE_LINK}')
    when regexp_matches(string_split(t, chr(10))[-1], '{truncation.BARE_MARK}') then true end as form from d where t <> ''),
  k as (select t, regexp_extract_all('{truncation.START}' || translate(lower(t), '012345678', '999999999'), '{RE2_TOKEN}') as w from (select distinct t from f)),
  p as (select case when i > 2 then w[i - 2] else '' end as w1, case when i > 1 then w[i - 1] else '' end as w2, w[i] as w3, i = len(w) as last from (select w, unnest(generate_series(1, len(w))) as i from k)),
  g as (select w1, w2, w3, {SIGNS_SQL.replace("{w}", "w2")} as c1, case when w3 like 'http%' then 'u' when w3 like '9%' then regexp_replace(regexp_extract(w3, '^9+(?:[.,:/]9+)*'), '9+', '9', 'g') when regexp_matches(w3, '^{truncation.HAN}') then 'h' else 'a' end
    || regexp_replace({SIGNS_SQL.replace("{w}", "w3")}, '[\p{{So}}\p{{Sk}}]+', '☺', 'g') as shape, count(*) as n, count(*) filter (last) as e from p group by all),
  q as (select distinct case when len(w) > 2 then w[-3] else '' end as w1, case when len(w) > 1 then w[-2] else '' end as w2, w[-1] as w3 from k join f using (t) where form is null),
  q1 as (select q.*, g.c1, g.shape from q join g using (w1, w2, w3)), r as (select sum(e) / sum(n) as rate from g),
  y0 as (select c1, shape, sum(n) as n, sum(e) as e from g group by 1, 2),
  x0 as (select o.c1, o.shape, sum(y0.n) as n, max(y0.e) filter (y0.shape = o.shape) as e from (select distinct c1, shape from q1) o join y0 on o.c1 = y0.c1 and starts_with(y0.shape, o.shape) group by 1, 2),
  y1 as (select c1, w3, sum(n) as n, sum(e) as e from g group by 1, 2), y2 as (select w2, w3, sum(n) as n, sum(e) as e from g group by 1, 2),
  x1 as (select o.c1, o.w3, sum(y1.n) as n, max(y1.e) filter (y1.w3 = o.w3) as e from (select distinct c1, w3 from q1) o join y1 on o.c1 = y1.c1 and starts_with(y1.w3, o.w3) group by 1, 2),
  x2 as (select o.w2, o.w3, sum(y2.n) as n, max(y2.e) filter (y2.w3 = o.w3) as e from (select distinct w2, w3 from q1) o join y2 on o.w2 = y2.w2 and starts_with(y2.w3, o.w3) group by 1, 2),
  x3 as (select o.w1, o.w2, o.w3, sum(g.n) as n, max(g.e) filter (g.w3 = o.w3) as e from q1 o join g on o.w1 = g.w1 and o.w2 = g.w2 and starts_with(g.w3, o.w3) group by 1, 2, 3),
  s0 as (select q1.*, rate, (x0.e - 1 + {truncation.WEIGHT} * rate) / (x0.n - 1 + {truncation.WEIGHT}) as p from q1 join x0 using (c1, shape), r),
  s1 as (select s0.* replace ((x1.e - 1 + {truncation.WEIGHT} * p) / (x1.n - 1 + {truncation.WEIGHT}) as p) from s0 join x1 using (c1, w3)),
  s2 as (select s1.* replace ((x2.e - 1 + {truncation.WEIGHT} * p) / (x2.n - 1 + {truncation.WEIGHT}) as p) from s1 join x2 using (w2, w3)),
  s3 as (select s2.* replace ((x3.e - 1 + {truncation.WEIGHT} * p) / (x3.n - 1 + {truncation.WEIGHT}) as p) from s2 join x3 using (w1, w2, w3)),
  j as (select doc_id, source, coalesce(form, p < cast({truncation.RARE} as double) * rate) as truncated from f join k using (t) left join s3 on s3.w3 = k.w[-1] and s3.w2 = case when len(w) > 1 then w[-2] else '' end and s3.w1 = case when len(w) > 2 then w[-3] else '' end)"""

ORACLE = {
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p9_found": GRAMS_SQL + " select doc_id, item_id from f",
    "p9_cleaned": CLEANED_SQL,
    "p10_found": JUDGED_SQL + " select doc_id from j where truncated",
    "p10_sources": JUDGED_SQL + " select source, count(*) as texts, cast(sum(truncated::int) as bigint) as truncated, round(sum(truncated::int) / count(*), 6) as share from j group by 1",
    "p9_items": GRAMS_SQL + " select item_id, count(*) as documents from f group by 1",
}
