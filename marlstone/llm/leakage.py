"""Passages of held-out test items inside a training corpus.

The items' word n-grams form a hash set, broadcast once its size is checked. Every window of
every text is looked up by hash; hits are verified word by word, and the verified spans can be
cut out of the texts, or their documents dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.session import keep
from marlstone.sources.tables import bounded

WORD = r"[\p{L}\p{N}]+"
WORDS_SHARED = 12
MOST_BROADCAST = 1_000_000


def words(text: Column) -> Column:
    """The runs of letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _windows(hashed: Column, n: int) -> Column:
    """One 64-bit hash per window of ``n`` word hashes, in order; empty for shorter texts.

    ``hashed`` must be a column, not an expression: what stands in a lambda is evaluated per window.
    """
    starts = F.when(F.size(hashed) >= n, F.sequence(F.lit(1), F.size(hashed) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(hashed, i, n)))


def item_grams(items: DataFrame, item_id: str, text: str, n: int = WORDS_SHARED) -> DataFrame:
    """(hash, gram, items): every distinct n-gram of the items with the items that hold it."""
    w = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") >= n)
    grams = w.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).select(F.xxhash64(F.transform("gram", lambda x: F.xxhash64(x))).alias("hash"), "gram", "items")


def hits(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, n: int = WORDS_SHARED, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(doc, item, at): verified windows; ``at`` is the position of the window's first word, from 0.

    A document holds an item's passage if ``n`` consecutive words are equal. Null and empty
    texts hold nothing; items of fewer than ``n`` words can't be found. Copies of a document
    under one id count once; documents or items without id can't be told and are left out.

    The hash set is broadcast if it proves to hold at most ``most_broadcast`` grams and few enough
    bytes, else it meets the windows in a shuffle. So are the windows that hit: the texts to be
    verified are then picked out of a second scan, where only these are split into words again.
    """
    grams = keep(item_grams(items, item_id, item_text, n), "grams")
    texts = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(text).alias("t"))
    hashed = texts.select("doc", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    probed = hashed.select("doc", F.posexplode(_windows(F.col("h"), n)).alias("at", "hash"))
    candidates = keep(probed.join(bounded(grams.select("hash").distinct(), most_broadcast), "hash", "left_semi").groupBy("doc").agg(F.collect_set("at").alias("ats")), "hits")
    chosen = texts.join(bounded(candidates, most_broadcast), "doc").select("doc", words(F.col("t")).alias("w"), "ats")
    windows = chosen.select("doc", F.explode(F.transform("ats", lambda a: F.struct(a.alias("at"), F.slice("w", a + 1, n).alias("gram")))).alias("c"))
    found = windows.select("doc", "c.at", "c.gram").join(bounded(grams.select("gram", "items"), most_broadcast), "gram")
    return found.select("doc", F.explode("items").alias("item"), "at").distinct()


def without_spans(docs: DataFrame, doc_id: str, text: str, found: DataFrame, n: int = WORDS_SHARED) -> DataFrame:
    """(doc, text, removed_words): the texts of hit documents with every verified span cut out."""
    spans = found.groupBy("doc").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).join(spans, "doc")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        word = regex.compile(WORD)
        for b in batches:
            texts, removed = [], []
            for t, ats in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lowered, origin = [], []
                for i, ch in enumerate(t):
                    for low in ch.lower():
                        lowered.append(low)
                        origin.append(i)
                at = [m.span() for m in word.finditer("".join(lowered))]
                gone = sorted({w for a in ats for w in range(a, a + n)})
                out, upto, previous = [], 0, None
                for w in gone:
                    first, last = origin[at[w][0]], origin[at[w][1] - 1] + 1
                    if previous is None or w != previous + 1:
                        out.append(t[upto:first])
                    upto, previous = last, w
                texts.append("".join([*out, t[upto:]]))
                removed.append(len(gone))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int64())], names=["doc", "text", "removed_words"])

    return rows.select("doc", "text", "ats").mapInArrow(cut, f"doc {rows.schema['doc'].dataType.simpleString()}, text string, removed_words bigint")
