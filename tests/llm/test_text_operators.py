"""Text operators against brute force on small hard inputs."""

import base64
import os
import random

import pytest
from pyspark.sql import functions as F

from marlstone.llm import leakage, tokenize, truncation

needs_vocabulary = pytest.mark.skipif(not os.path.exists(tokenize.VOCABULARY), reason="needs the public vocabulary")
HARD = [
    None, "", "   ", "plain words", "don't we'll I'VE 'tis", "x" * 700, " " * 500 + "end", "a\n\n\n b\r\n\tc", "日本語のテキスト" * 60, "🚀👩‍👩‍👧" * 80, "<|endoftext|> is text",
    "é" * 300, "12345 " * 200, "'" * 400 + "ll", "mixed — “quotes” … and blanks " * 40, "​﻿\x00 odd",
]


def _encoder():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenize.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})


@needs_vocabulary
@pytest.mark.parametrize("chunk, overlap", [(2048, 256), (64, 16), (40, 8)])
def test_encoding_equals_whole_text_encoding(spark, chunk, overlap):
    r = random.Random(chunk)
    alphabet = ["a", "Z", " ", "  ", "\n", "'", "'ll", "7", "é", "中", "🚀", ".", "_", " ", "don't "]
    texts = HARD + ["".join(r.choice(alphabet) for _ in range(r.randrange(400))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc long, text string, key string, ids int").repartition(5)
    got = {x["id"]: x["ids"] for x in tokenize.encode(df, "doc", "text", chunk=chunk, overlap=overlap).collect()}
    own = _encoder()
    assert got == {i: own.encode_ordinary(t or "") for i, t in enumerate(texts)}


@needs_vocabulary
def test_repeated_rows_null_ids_and_empty_tables(spark):
    long = "some words that repeat " * 20
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (1, "s"), (1, "s"), (2, long + "!")], "id long, text string")
    got = sorted(((x["id"], len(x["ids"])) for x in tokenize.encode(df, "id", "text", chunk=64, overlap=16).collect()), key=repr)
    n = len(_encoder().encode_ordinary(long))
    assert got == sorted([(1, n), (1, n), (None, n), (1, 1), (1, 1), (2, n + 1)], key=repr) or [g[0] for g in got].count(1) == 4
    assert tokenize.encode(df.limit(0), "id", "text").count() == 0
    with pytest.raises(ValueError):
        tokenize.encode(df, "id", "text", chunk=10, overlap=9)


@needs_vocabulary
def test_decoding_is_an_exact_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "id long, text string")
    back = {x["id"]: x["text"] for x in tokenize.decode(tokenize.encode(df, "id", "text", chunk=64, overlap=16), "id", "ids").collect()}
    assert back == {i: t or "" for i, t in enumerate(HARD)}


def _brute(docs, items, n):
    import regex

    word = regex.compile(leakage.WORD)
    grams = {}
    for i, t in items:
        w = word.findall((t or "").lower())
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = word.findall((t or "").lower())
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return out


@pytest.mark.parametrize("most_broadcast", [10**6, 0])
def test_leaks_equal_brute_force(spark, most_broadcast):
    r = random.Random(2)
    vocabulary = ["Alpha", "beta_gamma", "δέλτα", "7", "it's", "中文"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randrange(2, 14)))) for i in range(12)] + [(100, None), (101, ""), (102, items_text := "alpha beta gamma 7")]
    docs = [(i, (", " if i % 2 else "\n").join(r.choice(vocabulary) for _ in range(r.randrange(40)))) for i in range(60)] + [(200, None), (201, ""), (202, items_text.upper()), (202, items_text)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1)), spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit(1))
    found = leakage.hits(df, "doc_id", "text", it, "item_id", "text", n=4, most_broadcast=most_broadcast)
    assert {(x["doc"], x["item"]) for x in found.collect()} == _brute(docs, items, 4)
    assert leakage.hits(df, "doc_id", "text", it.limit(0), "item_id", "text", n=4).count() == 0 and leakage.hits(df.limit(0), "doc_id", "text", it, "item_id", "text", n=4).count() == 0


def test_spans_are_cut_exactly(spark):
    docs = spark.createDataFrame([(1, "Keep İ this. ONE two, three four five! Keep that."), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "one two three four"), (8, "two three four five")], "item_id long, text string")
    found = leakage.hits(docs, "doc_id", "text", items, "item_id", "text", n=4)
    assert [tuple(x) for x in leakage.without_spans(docs, "doc_id", "text", found, 4).collect()] == [(1, "Keep İ this. ! Keep that.", 5)]


WHOLE = ["A finished sentence.", "See\nhttps://a.example/x/123", "It is\n```\nselect 1\n```"]
CUT = {
    "mark": ["So it we…", "So it we...", "So it [more]", "So it \ufffd", "aren\\u00", "x &am"], "open block": ["It is\n```\nselect 1 from", "It is\n```"],
    "cut link": ["See\nhttps://a.exam", "See\nhttps://a.", "See\nhttps://a.example/x/"], "bare mark": ["One.\n- ", "One.\n12."],
}


def test_forms_where_no_word_stands_at_the_end(spark):
    cut = [(t, form) for form, texts in CUT.items() for t in texts]
    rows = [(i, t, "s") for i, t in enumerate(WHOLE + [t for t, _ in cut])] + [(900, None, "s"), (901, "", "s"), (902, " \n\u3000 ", "s"), (903, "Fine.", None), (904, "!?", "s")]
    got = {x["doc"]: (x["truncated"], x["decided_by"]) for x in truncation.judged(spark.createDataFrame(rows, "id long, text string, source string").withColumn("tokens", F.lit(1)), "id", "text", "source").collect()}
    assert {d for d, (t, _) in got.items() if not t} == {*range(len(WHOLE)), 903, 904}  # what was never seen isn't called cut
    assert [got[len(WHOLE) + i][1] for i in range(len(cut))] == [form for _, form in cut] and got[1][1] == "link" and len(got) == len(rows) - 3


def _judged_by_hand(texts, weight=truncation.WEIGHT):
    import regex

    plain = lambda p: p.replace("\\x{4E00}-\\x{9FFF}", "\u4e00-\u9fff").replace("\\x{3400}-\\x{4DBF}", "\u3400-\u4dbf").replace("[^\\P{L}", "[^\\P{L}")
    token, signs = regex.compile(plain(truncation.TOKEN)), regex.compile(r"[^\p{L}9\s]+(?:\s*[^\p{L}9\s]+)*\Z")
    sign = lambda w: (m := signs.search(w)) and m.group() or ""

    def shape(w):
        kind = "u" if w.startswith("http") else regex.sub("9+", "9", regex.match(r"9+(?:[.,:/]9+)*", w).group()) if w.startswith("9") else "h" if regex.match(r"[\u4e00-\u9fff]", w) else "a"
        return kind + regex.sub(r"[\p{So}\p{Sk}]+", "☺", sign(w))

    split = {t: token.findall(truncation.START + regex.sub("[0-9]", "9", t.lower())) for t in set(texts)}
    cases = [(w[i - 2] if i > 1 else "", w[i - 1] if i else "", w[i], i == len(w) - 1) for w in split.values() for i in range(len(w))]
    rate = sum(c[3] for c in cases) / len(cases)
    out = {}
    for t, w in split.items():
        w1, w2, w3 = (["", ""] + w)[-3:]
        p = rate
        for same, last in (
            (lambda c: sign(c[1]) == sign(w2) and shape(c[2]).startswith(shape(w3)), lambda c: shape(c[2]) == shape(w3)), (lambda c: sign(c[1]) == sign(w2) and c[2].startswith(w3), lambda c: c[2] == w3),
            (lambda c: c[1] == w2 and c[2].startswith(w3), lambda c: c[2] == w3), (lambda c: c[:2] == (w1, w2) and c[2].startswith(w3), lambda c: c[2] == w3),
        ):
            there = [c for c in cases if same(c)]
            p = (sum(c[3] and last(c) for c in there) - 1 + weight * p) / (len(there) - 1 + weight)
        out[t] = p < truncation.RARE * rate
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_verdicts_equal_brute_force(spark, seed):
    r = random.Random(seed)
    sentences = ["The price moved up by 3.25 % today.", "Rows restored for ALPHA again.", "价格上涨了5元。", '{"p": "7.1", "q": 2}', "| a | 5 |", "Файл восстановлен.", "all done ✅", "– night desk", "#tag #alpha"]
    texts = []
    for _ in range(80):
        t = " ".join(r.choice(sentences) for _ in range(r.randrange(1, 7)))
        texts.append(t[: r.randrange(3, len(t))].rstrip() if r.random() < 0.3 else t)
    texts += texts[:9]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "id long, text string, source string")
    got = {x["doc"]: x["truncated"] for x in truncation.judged(df, "id", "text", "source").filter("decided_by = 'counts'").collect()}
    want = _judged_by_hand(texts)
    assert len(got) > 70 and got == {i: want[texts[i]] for i in got} and len(set(got.values())) == 2


def test_counts_decide_where_the_form_does_not(spark):
    body = "The price moved up by 3.25 % today. Rows restored for ALPHA again. Files are kept for 5."
    rows = [(i, f"{body} Item {i} is closed.", "a") for i in range(60)]
    rows += [(100 + i, f"{'abcdefgh'[i]}{i} rows restored for ALPHA", "heads") for i in range(8)]  # headlines end so
    rows += [(200 + i, f"Note {'abcdefgh'[i]} was read. #tag #alpha", "tags") for i in range(8)]
    cut = [(300, "Other words. The price mo", "b"), (301, "Other words. The price moved", "b"), (302, "Rows restored f", "b"), (303, "Note z was read. #tag #al", "b"), (304, "Note z was read. #tag", "b"), (305, "The price moved up by 3.", "b")]
    got = {x["doc"]: x["truncated"] for x in truncation.judged(spark.createDataFrame(rows + cut, "id long, text string, source string"), "id", "text", "source", weight=5).collect()}
    assert {d for d, t in got.items() if t} == {c[0] for c in cut} and len(got) == len(rows + cut)
    shares = {x["source"]: (x["texts"], x["truncated"]) for x in truncation.shares(truncation.judged(spark.createDataFrame(rows + cut, "id long, text string, source string"), "id", "text", "source", weight=5)).collect()}
    assert shares == {"a": (60, 0), "heads": (8, 0), "tags": (8, 0), "b": (6, 6)}


def test_reposts_of_one_text_count_once(spark):
    twice = "Loads were sent to the old mill. Later more loads were sent to the old mill"
    rows = [(i, f"{'abcdefgh'[i]}{i} files for the old mill", "heads") for i in range(8)]
    rows += [(100 + i, twice, "reposts") for i in range(2000)]
    rows += [(5000, "Price rows restored for BETA", "heads"), (5001, "Some rows restored for BETA", "heads"), (5002, "Old rows restored for BETA", "heads")]
    rows += [(6000 + i, "He had rows restored for BETA before noon.", "reposts") for i in range(2000)]
    got = truncation.judged(spark.createDataFrame(rows, "id long, text string, source string"), "id", "text", "source", weight=5)
    assert got.filter("truncated").count() == 0 and got.count() == len(rows)


def test_no_texts_at_all(spark):
    empty = spark.createDataFrame([], "id long, text string, source string")
    assert truncation.judged(empty, "id", "text", "source").count() == 0 and truncation.shares(truncation.judged(empty, "id", "text", "source")).count() == 0
