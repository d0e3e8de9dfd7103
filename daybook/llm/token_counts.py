"""Token counts: every distinct pre-token is counted once.

1. Lexicon: pre-tokens (chunks between spaces and newlines) with their corpus
   frequency.  Each task sums its own pre-tokens before the shuffle.
2. Each distinct pre-token is given to the tokenizer once; only its number of
   pieces is kept.
3. Per document, pre-token frequencies.  The ``hot`` most frequent pre-tokens
   (a fixed number, each at most 64 characters) travel as a broadcast and are
   joined in the task; the other frequencies are joined to the lexicon in a
   shuffle.  Their keys cannot be hot: the hot ones are gone.
4. Sum of frequency times pieces per document.  No ids are materialised.

Null texts count as empty; every row of ``docs`` gives one row, repeated or
null ids included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import handoff, slices

HOT_PRETOKENS = 300_000
HOT_CHARS = 64
FLUSH = 400_000


def _pretokens(text: str) -> list[str]:
    return text.replace("\n", " ").split(" ")


def _lexicon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-tokens of a task with their frequencies, flushed at a bounded size."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["pretoken", "freq"])
    counts: Counter = Counter()
    for part in slices(batches):
        for text in part.column(0).to_pylist():
            if text:
                counts.update(_pretokens(text))
        counts.pop("", None)
        if len(counts) >= FLUSH:
            yield rows(counts)
            counts = Counter()
    yield rows(counts)


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from daybook.llm.wordbpe import encoder
        encode = encoder(path).encode_chunk
        for part in slices(batches, 8192):
            pieces = [len(encode(p)) // 4 for p in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(pieces, pa.int64())],
                names=["pretoken", "freq", "pieces"])
    return count


def _documents(hot):
    """Per document: bytes, tokens of its hot pre-tokens, frequencies of the others."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = hot.value.get
        for part in slices(batches):
            n_bytes, n_hot, rest = [], [], []
            for text in part.column(1).to_pylist():
                text = text or ""
                freq = Counter(_pretokens(text))
                freq.pop("", None)
                total, other = 0, []
                for pretoken, n in freq.items():
                    pieces = get(pretoken)
                    if pieces is None:
                        other.append({"pretoken": pretoken, "n": n})
                    else:
                        total += n * pieces
                n_bytes.append(len(text.encode()))
                n_hot.append(total)
                rest.append(other)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_hot, pa.int64()),
                 pa.array(rest, pa.list_(pa.struct([("pretoken", pa.string()), ("n", pa.int64())])))],
                names=["id", "n_bytes", "hot_tokens", "rest"])
    return count


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 hot: int = HOT_PRETOKENS) -> DataFrame:
    """``id_col, n_bytes, n_tokens`` of every row of ``docs``.

    ``tokenizer`` is the path of a word-level BPE file.  Ids must be integers.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    counted = docs.select("text").mapInArrow(_lexicon, "pretoken string, freq bigint")
    lexicon = handoff(counted.groupBy("pretoken").agg(F.sum("freq").alias("freq"))
                      .mapInArrow(_counter(tokenizer), "pretoken string, freq bigint, pieces bigint"),
                      "lexicon")
    short = (lexicon.where(F.length("pretoken") <= HOT_CHARS)
             .withColumn("level", F.floor(16 * F.log2(F.col("freq").cast("double")))))
    levels = short.groupBy("level").count().collect()        # at most 16 for each doubling
    cut, kept = None, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        kept += r["count"]
        if kept > hot:
            break
        cut = r["level"]
    top = short.where(F.col("level") >= F.lit(cut)).select("pretoken", "pieces")
    frequent = {r[0]: r[1] for r in top.collect()}  # at most ``hot`` short strings
    sent = spark.sparkContext.broadcast(frequent)
    per_doc = handoff(docs.mapInArrow(
        _documents(sent), "id bigint, n_bytes bigint, hot_tokens bigint, "
                          "rest array<struct<pretoken:string,n:bigint>>")
        .withColumn("row", F.monotonically_increasing_id()), "frequencies")
    others = (per_doc.select("row", F.explode("rest").alias("p"))
              .select("row", F.col("p.pretoken").alias("pretoken"), F.col("p.n").alias("n"))
              .join(lexicon.select("pretoken", "pieces"), "pretoken")
              .groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("other_tokens")))
    return (per_doc.select("row", "id", "n_bytes", "hot_tokens").join(others, "row", "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    (F.col("hot_tokens") + F.coalesce("other_tokens", F.lit(0))).alias("n_tokens")))
