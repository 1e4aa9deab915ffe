"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints are one node.  Two fingerprints that differ in at most ``d`` of 64 bits agree in at
least two of ``d + 2`` blocks of bits, so every link lies inside a bucket of fingerprints that share
a pair of blocks.  In a bucket, each fingerprint's Hamming distances to many fixed references form a
table.  By the triangle inequality a pair whose coordinates differ by more than ``d`` anywhere is no
link; it is discarded, and only survivors are compared bit by bit.  A bucket hands on a spanning forest of
its links, never its pairs, and the forest's components are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.llm.common import components, prepared, texts, worker_state
from ecometrics.session import settle

SEED = 42
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)
SMALL_BUCKET = 32


def shingle_hashes(words: list[bytes], words_per_shingle: int) -> np.ndarray:
    """A hash of each run of ``words_per_shingle`` words; fewer words make one run."""
    joined = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[:n].tolist()
    stops = (ends[min(len(words), words_per_shingle) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(text: bytes, words_per_shingle: int = 4) -> int:
    """64 bits: set where over half of the shingles' hashes have it; 0 without words."""
    words = text.lower().split()  # of bytes: lowers A-Z alone
    if not words:
        return 0
    hashes = shingle_hashes(words, words_per_shingle)
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("simhash")
        for batch in batches:
            found = np.array([fingerprint(x, words_per_shingle) for x in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def block_masks(distance: int) -> list[int]:
    """For each pair of the ``distance + 2`` blocks the mask of its bits, as a signed long."""
    cuts = np.linspace(0, 64, distance + 3).round().astype(int)
    blocks = [sum(1 << int(bit) for bit in range(a, b)) for a, b in zip(cuts, cuts[1:])]
    return [int(np.array([x | y], np.uint64).view(np.int64)[0]) for x, y in combinations(blocks, 2)]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Row by row the distances to the references."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :])


def linked(fps: np.ndarray, table: np.ndarray, i, j, distance: int) -> np.ndarray:
    """Which pairs (i, j) are links; coordinates are looked at a few at a time, on what is left."""
    left = np.arange(max(np.size(i), np.size(j)))
    i, j = np.broadcast_to(i, left.shape), np.broadcast_to(j, left.shape)
    for at in range(0, table.shape[1], 4):
        a, b = table[i[left], at : at + 4].astype(np.int16), table[j[left], at : at + 4]
        left = left[np.abs(a - b).max(axis=1, initial=0) <= distance]
        if not left.size:
            return left
    return left[np.bitwise_count(fps[i[left]] ^ fps[j[left]]) <= distance]


def forest(fps: np.ndarray, starts: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning links (positions) inside the runs that begin at ``starts``."""
    table = pivot_table(fps)
    sizes = np.diff(np.append(starts, len(fps)))
    run = np.repeat(np.arange(len(starts)), sizes)
    small = sizes[run] <= SMALL_BUCKET
    links: list[tuple[int, int]] = []
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for lag in range(1, min(SMALL_BUCKET, int(sizes.max(initial=1)))):
        i = np.flatnonzero(small[:-lag] & (run[:-lag] == run[lag:]))
        for k in i[linked(fps, table, i, i + lag, distance)].tolist():
            a, b = root(k), root(k + lag)
            if a != b:
                parent[a] = b
                links.append((k, k + lag))
    for start, size in zip(starts.tolist(), sizes.tolist()):
        if size <= SMALL_BUCKET:
            continue
        # Walk the links; what has been reached is never compared again.
        rest = np.arange(start, start + size)
        while rest.size:
            queue, rest = [int(rest[0])], rest[1:]
            while queue and rest.size:
                here = queue.pop()
                near = linked(fps, table, np.int64(here), rest, distance)
                if near.size:
                    found = rest[near].tolist()
                    links += [(here, x) for x in found]
                    queue += found
                    rest = np.delete(rest, near)
    return links


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """(a, b): fingerprints at ``distance`` or fewer bits, enough of them to connect each group."""
    masks = block_masks(distance)
    keyed = nodes.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in masks])).alias("pair", "key")
    )
    dealt = keyed.repartition("pair", "key").sortWithinPartitions("pair", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(columns):
            pair, key, fp = columns
            starts = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (key[1:] != key[:-1]))) if len(fp) else np.empty(0, int)
            many = np.repeat(np.diff(np.append(starts, len(fp))) > 1, np.diff(np.append(starts, len(fp))))
            kept = np.flatnonzero(many)
            first = np.flatnonzero(np.isin(kept, starts))
            found = forest(fp[kept].view(np.uint64), first, distance) if kept.size else []
            ends = np.array(found, np.int64).reshape(-1, 2)
            a, b = fp[kept][ends[:, 0]], fp[kept][ends[:, 1]]
            return pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

        held: list[list[np.ndarray]] = []  # whole buckets wait here until there are enough rows
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([batch.column(c).to_numpy() for c in ("pair", "key", "fp")])
            rows += batch.num_rows
            if rows < 100_000:
                continue
            pair, key, fp = (np.concatenate(x) for x in zip(*held))
            open_from = int(np.flatnonzero((pair != pair[-1]) | (key != key[-1]))[-1]) + 1 if (pair[0], key[0]) != (pair[-1], key[-1]) else 0
            if open_from:
                yield out([x[:open_from] for x in (pair, key, fp)])
            held, rows = [[x[open_from:] for x in (pair, key, fp)]], len(fp) - open_from
        if held:
            yield out([np.concatenate(x) for x in zip(*held)])

    return dealt.select("pair", "key", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def components_of(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, root): for every fingerprint the name of the group that links of at most ``distance`` bits connect."""
    nodes = settle(prints.select("fp").distinct(), "nodes")
    roots = components(settle(links(nodes, distance), "near"))
    return settle(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root")), "grouped")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    distance: int = 4,
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (least doc_id that links reach).

    Null, empty and wordless texts have fingerprint zero and link like any other; fewer words than a
    shingle make one shingle; null ids are never a component's id unless it has no other; repeated rows are
    kept; an empty table gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    prints = settle(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    grouped = components_of(prints, distance)
    of_print = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    first = settle(of_print.join(grouped, "fp").groupBy("root").agg(F.min("first_id").alias("component_id")), "first")
    named = settle(grouped.join(first, "root").select(F.col("fp").alias("node"), "component_id"), "named")
    return prints.join(named, prints.fp == named.node).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 4,
    distance: int = 4,
) -> DataFrame:
    """One row, all columns, of each group of ``near_duplicates``: the least by (id, digest of the text).

    Rows are told by id and text, so of rows that share an id the right one stays, and equal rows are one; rows
    without an id come after those with one.  Null, empty and wordless texts have fingerprint zero and are one
    group with whatever links to it; an empty table gives no rows.
    """
    prepared(docs.sparkSession)
    text_digest = F.md5(F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary"))
    keyed = docs.select(F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), text_digest.alias("digest")).alias("key"), docs[text_col].alias("text"))
    prints = settle(fingerprints(keyed, "key", "text", words_per_shingle), "fingerprints")
    of_print = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    grouped = components_of(prints, distance)
    first = of_print.join(grouped, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = settle(first.select(F.col("first.id").alias("__first_id"), F.col("first.digest").alias("__first_digest")), "kept")
    same = docs[id_col].eqNullSafe(F.col("__first_id")) & (text_digest == F.col("__first_digest"))
    return docs.join(kept, same, "left_semi").dropDuplicates([id_col, text_col])
