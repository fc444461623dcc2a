"""Texts cut off before their end, found in SQL from how rarely a text ends where they end.

Words carry the signs that follow them, so that the end of a sentence, of a table row or of a
payload is a word trigram like any other. Trigrams are counted over all texts: how often each
occurs, and how often as a text's last one. A final trigram that is frequent inside texts but
almost never terminal marks a cut, and so does one whose last word is only the beginning of words
that go on in its place. Where trigrams are too rare to tell, the counts of the last two words, of
the last word and of its shape weigh in by degrees; no step has a threshold in counts, so that the
verdict on a text doesn't depend on how many others there are. Only ends without a word to count
are read by their form: marks of omission, links, code blocks that stay open, bare list marks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marlstone.session import keep_at, scratch
from marlstone.sources.tables import bounded

#: Letters other than Han characters, which are words of their own.
LETTER, HAN = r"[^\P{L}\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]", r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]"
#: A word: letters, a number (every digit is a 9 by then), a Han character or a link; and the signs after it.
TOKEN = rf"(?:https?://[^\s]*+|{LETTER}++(?:[-_\x27’]{LETTER}++)*+|9++(?:[.,:/]9++)*+|{HAN})(?:\s*+[^\s\p{{L}}9]++)*+"
#: Stands before every text, so that signs before its first word belong to a word too.
START = "ǃ "
#: What may follow a text without belonging to it: blanks and invisible marks.
BLANKS = " \t\r\n\x0b\x0c" + "".join(map(chr, (0x85, 0xA0, 0xAD, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)))
#: Marks of omission and halves of escapes, looked for in the last characters.
OMISSION = r"(?:…|\.\.\.|\[(?:more|cut|truncated|continued|…|\.\.\.)\]|\x{FFFD}|\\u[0-9a-fA-F]{0,3}|\\|&#?\w{0,8})\z"
LONGEST_OMISSION = 16
MOST_BROADCAST = 1_000_000
FENCE, LINK, WHOLE_LINK, BARE_MARK = r"(?m)^[ \t]*```", r"(?:^|\s)https?:[^\s]*\z", r"https?://[^\s/]+/(?:[^\s/]+/)*[0-9]+\z", r"^\s*(?:[-*+•>]|[0-9]+[.)])\s*\z"
#: How many cases the next wider context counts for against a context's own.
WEIGHT = 50
#: A text is cut if texts end where it ends in less than this part of the share they have of all words.
RARE = 0.8

TOKENS = rf"""
select doc, source, a, b, form, regexp_extract_all('{START}' || translate(lower(t), '012345678', '999999999'), r'{TOKEN}', 0) as tokens
from (
  select *, xxhash64(t) as a, xxhash64(t, 1) as b, case
    when right(t, {LONGEST_OMISSION}) rlike r'{OMISSION}' then 'mark'
    when contains(t, '```') and size(split(t, r'{FENCE}')) % 2 = 0 then 'open block'
    when contains(line, 'http') and line rlike r'{LINK}' then if(line rlike r'{WHOLE_LINK}', 'link', 'cut link')
    when length(line) < 32 and line rlike r'{BARE_MARK}' then 'bare mark'
  end as form
  from (select *, substring_index(t, '\n', -1) as line from (select doc, source, trim(trailing '{{blanks}}' from text) as t from {{docs}} where text is not null) where t <> '')
)
"""

#: The rows whose text another row has, but for the first of them.
COPIES = """
select t.rid from {tokens} t join (select a, b, min(rid) as first from {tokens} group by 1, 2 having count(*) > 1) f on t.a = f.a and t.b = f.b where t.rid <> f.first
"""

#: Every trigram of every distinct text: how often it occurs (n), and how often as the last one (e).
GRAMS = """
select coalesce(w1, '') as w1, coalesce(w2, '') as w2, w3, count(*) as n, sum(last) as e
from (select tokens from {tokens} t left anti join {copies} c on t.rid = c.rid)
lateral view inline(arrays_zip(
  concat(array('', ''), slice(tokens, 1, greatest(size(tokens) - 2, 0))), concat(array(''), slice(tokens, 1, size(tokens) - 1)), tokens, concat(array_repeat(0, size(tokens) - 1), array(1))
)) g as w1, w2, w3, last
where w3 is not null
group by 1, 2, 3
"""

FINALS = """
select rid, doc, source, form, coalesce(try_element_at(tokens, -3), '') as w1, coalesce(try_element_at(tokens, -2), '') as w2, element_at(tokens, -1) as w3
from {tokens}
"""

#: The signs that end a word.
SIGNS = r"regexp_extract({w}, r'[^\p{L}9\s]+(?:\s*[^\p{L}9\s]+)*\z', 0)"
#: A word's kind (link, skeleton of a number, Han character, letters) and its signs, pictures being one sign.
SHAPE = (
    rf"concat(case when w3 like 'http%' then 'u' when w3 like '9%' then regexp_replace(regexp_extract(w3, r'^9+(?:[.,:/]9+)*', 0), '9+', '9') when w3 rlike r'^{HAN}' then 'h' else 'a' end, "
    rf"regexp_replace({SIGNS.replace('{w}', 'w3')}, r'[\p{{So}}\p{{Sk}}]+', '☺'))"
)

#: Every pair of words with the signs of the first and the shape of the second; the same of the trigrams asked for.
PAIRS = """
select w2, w3, {before} as c1, {shape} as shape, n, e from (select w2, w3, sum(n) as n, sum(e) as e from {grams} group by 1, 2)
"""
ASKED = """
select *, w2 as c2, concat_ws('\x1f', w1, w2) as c3, {before} as c1, {shape} as shape from (select distinct w1, w2, w3 from {finals} where form is null)
"""

#: Per context and last word: how often words that begin with it stand there (n), and how often it ends a text (e).
#: Words are sorted within a context and their first two characters; words of one character are summed up by it.
LEVEL = """
with all_words as (select {context} as c, {word} as w, sum(n) as n, sum(e) as e from {counts} group by 1, 2),
asked as (select distinct {context} as c, {word} as w from {asked}),
words as (select a.* from all_words a left semi join (select distinct c from asked) q on a.c = q.c),
points as (
  select c, w, 1 as side, n, w as word from words
  union all select c, w, 0, 0, w from asked where length(w) > 1
  union all select c, concat(w, '\U0010FFFF'), 2, 0, w from asked where length(w) > 1
),
summed as (select c, word, side, sum(n) over (partition by c, left(word, 2) order by w, side rows between unbounded preceding and current row) as upto from points),
longer as (select c, word, max(if(side = 2, upto, 0)) - max(if(side = 0, upto, 0)) as n from summed where side <> 1 group by 1, 2),
single as (select c, left(w, 1) as word, sum(n) as n from words group by 1, 2)
select q.c, q.w, coalesce(l.n, s.n) as n, w.e
from asked q join words w on w.c = q.c and w.w = q.w
left join longer l on l.c = q.c and l.word = q.w
left join single s on length(q.w) = 1 and s.c = q.c and s.word = q.w
"""

#: The share of cases in which a text ends there, without the text in question: from all words to the trigram.
SCORED = """
with q as (select *, (select sum(e) / sum(n) from {grams}) as rate from {asked}),
p0 as (select q.*, (x.e - 1 + {weight} * rate) / (x.n - 1 + {weight}) as p from q join {l0} x on x.c = q.c1 and x.w = q.shape),
p1 as (select p0.* except (p), (x.e - 1 + {weight} * p) / (x.n - 1 + {weight}) as p from p0 join {l1} x on x.c = p0.c1 and x.w = p0.w3),
p2 as (select p1.* except (p), (x.e - 1 + {weight} * p) / (x.n - 1 + {weight}) as p from p1 join {l2} x on x.c = p1.c2 and x.w = p1.w3),
p3 as (select p2.* except (p), (x.e - 1 + {weight} * p) / (x.n - 1 + {weight}) as p from p2 join {l3} x on x.c = p2.c3 and x.w = p2.w3)
select w1, w2, w3, p < cast({rare} as double) * rate as rare from p3
"""

JUDGED = """
select f.doc, f.source, coalesce(f.form, 'counts') as decided_by, case when f.form is null then s.rare else f.form <> 'link' end as truncated
from {finals} f left join {scored} s on f.form is null and s.w1 = f.w1 and s.w2 = f.w2 and s.w3 = f.w3
"""


def _sql(spark: SparkSession, text: str, frames: dict[str, DataFrame], **values: object) -> DataFrame:
    """The query ``text`` with {names} replaced by frames, seen as views while it is analysed, and by values."""
    views = {name: f"truncation_{name}_{uuid.uuid4().hex}" for name in frames}
    for name, view in views.items():
        frames[name].createOrReplaceTempView(view)
    for name, value in (values | views).items():
        text = text.replace("{" + name + "}", str(value))
    try:
        return spark.sql(text)
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)


def judged(docs: DataFrame, doc_id: str, text: str, source: str, weight: int = WEIGHT, rare: float = RARE) -> DataFrame:
    """(doc, source, decided_by, truncated) for every text that isn't null, empty or blank.

    decided_by is ``counts``, or the form that decided: ``mark`` (of omission), ``open block``,
    ``link`` (whole) or ``cut link``, ``bare mark`` (of a list). By counts a text is cut if the share of
    cases in which a text ends where it ends, its own case left out, is below ``rare`` times the
    share of texts in all words: if texts end there more rarely than anywhere. Each share is that
    of its context, ``weight`` cases of the next wider one added: trigram, two words, word after
    the same signs, shape after the same signs, all. What was never seen has the overall share,
    and isn't called cut. Every row gets a verdict, repeated rows too; counts take equal texts
    (equal in 128 bits) once.
    """
    spark = docs.sparkSession
    rows = docs.selectExpr(f"`{doc_id}` as doc", f"`{text}` as text", f"`{source}` as source")
    root = scratch(spark, "truncation")
    run = lambda name, sql, frames, **values: keep_at(_sql(spark, sql, frames, **values), f"{root}/{name}")
    derived = {"before": SIGNS.replace("{w}", "w2"), "shape": SHAPE}
    # texts are read and split once; all else works on the words and, after that, on counts
    split = _sql(spark, TOKENS, {"docs": rows}, blanks=BLANKS).selectExpr("monotonically_increasing_id() as rid", "*")
    tokens = keep_at(split, f"{root}/tokens")
    copies = run("copies", COPIES, {"tokens": tokens})
    grams = run("grams", GRAMS, {"tokens": tokens, "copies": bounded(copies, MOST_BROADCAST)})
    finals = run("finals", FINALS, {"tokens": tokens})
    pairs, asked = run("pairs", PAIRS, {"grams": grams}, **derived), run("asked", ASKED, {"finals": finals}, **derived)
    frames = {"grams": grams, "asked": asked}
    for name, counts, context, word in (("l0", pairs, "c1", "shape"), ("l1", pairs, "c1", "w3"), ("l2", pairs, "w2", "w3"), ("l3", grams, "concat_ws('\x1f', w1, w2)", "w3")):
        frames[name] = run(name, LEVEL, {"counts": counts, "asked": asked}, context=context, word=word)
    scored = run("scored", SCORED, frames, weight=weight, rare=rare)
    return _sql(spark, JUDGED, {"finals": finals, "scored": scored})


def shares(judgements: DataFrame) -> DataFrame:
    """(source, texts, truncated, share): how often each source cuts; null is a source of its own."""
    return judgements.selectExpr("source", "cast(truncated as bigint) as t").groupBy("source").agg({"*": "count", "t": "sum"}).selectExpr(
        "source", "`count(1)` as texts", "`sum(t)` as truncated", "round(`sum(t)` / `count(1)`, 6) as share"
    )
