"""Encoding of whole corpora with a public byte-level BPE vocabulary.

Texts are cut into overlapping chunks, which are pre-tokenised in parallel. Pre-tokenising
from any position soon falls into step with pre-tokenising from the start, and from a shared
boundary on both agree: neighbouring chunks are stitched at the first boundary of their
overlap that both have; where they have none, the chunks stay one piece. The pieces between
stitches consist of whole pre-tokens, so their encodings join into the encoding of the text.
Decoding concatenates the tokens' raw bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_CHARS, OVERLAP_CHARS = 2048, 256
#: A pre-token's end may depend on this many characters after it (the longest contraction).
LOOKAHEAD = 3

_encoders: dict[int, tuple] = {}


def _ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


def _coder(shared, pattern: str):
    """The encoder and token bytes of a broadcast vocabulary, built once a worker."""
    key = (hash(shared.value), pattern)
    if key not in _encoders:
        import tiktoken

        ranks = _ranks(shared.value)
        _encoders.clear()
        _encoders[key] = (tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), {v: k for k, v in ranks.items()})
    return _encoders[key]


def _share(df: DataFrame, vocabulary: str):
    """The vocabulary file's bytes for all executors; its size is fixed by the file."""
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _mapped(df: DataFrame, columns: list[str], made: dict[str, pa.DataType], schema: str, fn: Callable[..., tuple]) -> DataFrame:
    """Add the columns ``made`` by ``fn(*lists)`` to ``columns`` of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [b.column(b.schema.get_field_index(c)) for c in columns]
            new = fn(*(b.column(i).to_pylist() for i in range(b.num_columns)))
            arrays = [pa.array(v, t) for v, t in zip(new, made.values())]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=[*columns, *made])

    return df.mapInArrow(run, schema)


def _chunked(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, no, last, start, text): the overlapping chunks of each long text, spread over tasks."""
    step = chunk - overlap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                count = max(1, -(-(len(text) - overlap) // step))
                for low in range(0, count, 256):
                    nos = list(range(low, min(count, low + 256)))
                    yield pa.RecordBatch.from_pydict({
                        "key": [key] * len(nos), "no": nos, "last": [n == count - 1 for n in nos],
                        "start": [n * step for n in nos], "text": [text[n * step : n * step + chunk] for n in nos],
                    }, schema=pa.schema([("key", pa.string()), ("no", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()), ("text", pa.string())]))

    return docs.mapInArrow(run, "key string, no bigint, last boolean, start bigint, text string").repartition("key", "no")


def _edges(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, no, head, tail): boundaries in the overlap with the chunk before, and with the next.

    The tail leaves out boundaries that what follows the chunk could still move. Boundaries after
    a blank are left out too: where a run of blanks is cut depends on what comes after it, so a
    piece that ended there would be pre-tokenised differently on its own.
    """
    step = chunk - overlap

    def boundaries(keys, nos, lasts, starts, texts):
        import regex

        cut, blank = regex.compile(pattern), regex.compile(r"\s")
        heads, tails = [], []
        for start, text in zip(starts, texts):
            ends = [start + m.end() for m in cut.finditer(text) if not blank.match(text, m.end() - 1)]
            heads.append([e for e in ends if e < start + overlap])
            tails.append([e for e in ends if start + step <= e <= start + len(text) - LOOKAHEAD])
        return heads, tails

    made = {"head": pa.list_(pa.int64()), "tail": pa.list_(pa.int64())}
    return _mapped(chunks, ["key", "no"], made, "key string, no bigint, head array<bigint>, tail array<bigint>", boundaries)


def encode(df: DataFrame, id_column: str, text_column: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(id, ids array<int>) for every row of ``df``; strings of special tokens are ordinary text.

    Empty and null texts both get the empty list. Repeated rows and rows with a null id give a
    row each. Texts of any length are encoded whole: chunks of one long text go to many tasks;
    only a run longer than the overlap that offers no boundary to stitch at (one word of
    thousands of letters) is encoded in one piece, as it must be. Other columns don't matter.
    """
    if not LOOKAHEAD < overlap < chunk // 2:
        raise ValueError("the overlap must be longer than the lookahead and shorter than half a chunk")
    shared = _share(df, vocabulary)
    docs = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def whole(texts: list[str]) -> list[list[int]]:
        return _coder(shared, pattern)[0].encode_ordinary_batch(texts, num_threads=1)

    id_type = docs.schema["id"].dataType.simpleString()

    def encoded(rows: DataFrame) -> DataFrame:
        return _mapped(rows.select("id", "text"), ["id"], {"ids": pa.list_(pa.int32())}, f"id {id_type}, ids array<int>", lambda ids, texts: (whole(texts),))

    short = encoded(docs.filter(F.char_length("text") <= chunk))
    named = docs.filter(F.char_length("text") > chunk).withColumn("key", F.sha2(F.concat_ws("\x1f", F.coalesce(F.col("id").cast("string"), F.lit("\x00")), "text"), 256))
    chunks = _chunked(named.select("key", "text"), chunk, overlap).dropDuplicates(["key", "no"])
    by_no = Window.partitionBy("key").orderBy("no")
    met = _edges(chunks, pattern, chunk, overlap).withColumn("stitch", F.array_min(F.array_intersect("head", F.lag("tail").over(by_no)))).select("key", "no", "stitch")
    opens = (F.col("stitch").isNotNull() | (F.col("no") == 0)).cast("int")
    placed = met.withColumns({"until": F.lead("stitch").over(by_no), "piece": F.sum(opens).over(by_no.rowsBetween(Window.unboundedPreceding, 0))})
    counted = placed.withColumn("chunks", F.count(F.lit(1)).over(Window.partitionBy("key", "piece")))
    # a piece's first chunk gives what follows its stitch, its others what follows their overlap, its last what precedes the next stitch
    parts = chunks.join(counted, ["key", "no"])
    first = F.when(F.col("stitch").isNotNull(), F.col("stitch") - F.col("start")).when(F.col("no") == 0, F.lit(0)).otherwise(F.lit(overlap))
    end = F.when(F.col("until").isNotNull(), F.col("until") - F.col("start")).otherwise(F.char_length("text"))
    cut = parts.select("key", "no", "piece", "chunks", F.substring("text", first + 1, F.greatest(end - first, F.lit(0))).alias("part"))
    alone = cut.filter("chunks = 1").select("key", "piece", "part")
    run = cut.filter("chunks > 1").groupBy("key", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("no", "part"))), lambda p: p["part"]), "").alias("part"))
    encoded_parts = _mapped(alone.unionByName(run), ["key", "piece"], {"ids": pa.list_(pa.int32())}, "key string, piece bigint, ids array<int>", lambda keys, pieces, texts: (whole(texts),))
    joined = encoded_parts.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda p: p["ids"])).alias("ids"))
    long = named.select("id", "key").join(joined, "key").select("id", "ids")
    return short.unionByName(long)


def decode(df: DataFrame, id_column: str, ids_column: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, text) from token ids: raw bytes concatenated, then read as UTF-8 (bad bytes replaced)."""
    shared = _share(df, vocabulary)
    rows = df.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))

    def texts(ids, lists):
        table = _coder(shared, PATTERN)[1]
        return ([None if x is None else b"".join(table[i] for i in x).decode("utf-8", "replace") for x in lists],)

    return _mapped(rows, ["id"], {"text": pa.string()}, f"id {rows.schema['id'].dataType.simpleString()}, text string", texts)
