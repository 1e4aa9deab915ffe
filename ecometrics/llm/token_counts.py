"""Token counts by a map-side two-tier lookup.

A *pre-token* here is a run of white space with the run of other characters after it; merges
and the library's own splitting never cross its borders.  The lengths of the most frequent ones
are broadcast as one small hash table.  Whatever is not in it is encoded by the library in the
worker, once per worker, through a bounded cache.  No pre-token is ever shuffled.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ecometrics.llm.common import frequent_items, prepared, texts, worker_state

# The characters of Unicode's White_Space property, at which the library splits.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRE_TOKEN = f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"

def pre_tokens(text: str) -> list[str]:
    return re.findall(PRE_TOKEN, text)


def _encoder(path: str):
    """The worker's tokenizer; special strings inside texts count as the library's default takes them."""
    state = worker_state("token_counts")
    if state.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_file(path)
        encoder.no_truncation()
        encoder.no_padding()
        state.update(path=path, encoder=encoder, cache=None)
    return state["encoder"]


def lengths(encoder, items: list[str]) -> list[int]:
    return [len(x.ids) for x in encoder.encode_batch_fast(items, add_special_tokens=False)]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    table_items: int = 8192,
    cache_items: int = 600_000,
) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).

    ``tokenizer`` is the path of a tokenizers file that every worker has.  ``table_items`` bounds the
    broadcast table and ``cache_items`` a worker's cache; neither changes a count.  Null text counts as
    empty (0, 0, false); null and repeated ids are kept row by row; an empty table gives no rows;
    other columns of ``docs`` are not read.
    """
    spark = prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    common = frequent_items(rows.select("text"), pre_tokens, table_items)
    table = spark.sparkContext.broadcast(dict(zip(common, lengths(_encoder(tokenizer), common))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known, state = _encoder(tokenizer), table.value, worker_state("token_counts")
        if state["cache"] is None:
            state["cache"] = dict(known)
        for batch in batches:
            raw = texts(batch)
            split = [pre_tokens(x.decode()) for x in raw]
            cache = state["cache"]
            new = set().union(*split).difference(cache)
            if len(cache) + len(new) > cache_items:
                cache = state["cache"] = dict(known)
                new = set().union(*split).difference(cache)
            missing = list(new)
            cache.update(zip(missing, lengths(encoder, missing)))
            n = [sum(map(cache.__getitem__, x)) for x in split]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array([len(x) for x in raw], pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()),
                    "over_limit": pa.array([x > limit for x in n], pa.bool_()),
                }
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
