"""Document fingerprints by Order MinHash, and each document beside its successor.

A text's k-mers (code points) are numbered by occurrence, so repeats count.  Each of the hash functions
selects the two occurrence-numbered k-mers of least hash; the two k-mers, in the order in which the
text has them, are hashed into one value of the signature.  The share of equal values estimates a
similarity that falls with edit distance, because it needs shared k-mers in the same order.

The successor of a document is the next one in descending id.  Ids are cut at quantiles into slices of
bounded rows; a slice is sorted and streamed, and the first document of the next slice comes along
as a copy, so that texts are moved once, compressed, and no task holds more than two documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.llm.common import prepared, texts

K, HASHES = 8, 64
MULTIPLIERS = np.random.default_rng(5).integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
NONE = np.iinfo(np.uint32).max
BASE = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 2048
MOST_SLICES = 20_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(points: np.ndarray) -> np.ndarray:
    """A hash for every k-mer; a shorter text is one k-mer."""
    n = max(len(points) - K + 1, 1 if len(points) else 0)
    codes = np.zeros(n, np.uint64)
    for i in range(min(K, len(points))):
        codes = codes * BASE + points[i : i + n]
    return mixed(codes)


def numbered(codes: np.ndarray) -> np.ndarray:
    """Codes of (k-mer, which occurrence of it this is)."""
    ordered = np.sort(codes)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not repeated.size:
        return codes
    at = np.searchsorted(repeated, codes)
    at[at == repeated.size] = 0
    places = np.flatnonzero(repeated[at] == codes)
    group = at[places]
    order = np.argsort(group, kind="stable")
    sorted_groups = group[order]
    first = np.searchsorted(sorted_groups, sorted_groups)
    occurrence = np.empty(len(places), np.uint64)
    occurrence[order] = np.arange(len(places)) - first
    out = codes.copy()
    out[places] = mixed(codes[places] + occurrence * BASE)
    return out


def two_least(hashes: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Row by row the two least values and their places, counted from ``at``."""
    rows = np.arange(len(hashes))
    first = hashes.argmin(axis=1)
    values, places = [hashes[rows, first]], [first + at]
    if hashes.shape[1] > 1:
        hashes[rows, first] = NONE
        second = hashes.argmin(axis=1)
        values.append(hashes[rows, second])
        places.append(second + at)
    return np.array(values), np.array(places)


def signature(points: np.ndarray) -> np.ndarray:
    """One 32-bit value per hash function; zeros for the empty text."""
    if not len(points):
        return np.zeros(HASHES, np.uint32)
    codes = numbered(kmers(points))
    short = (codes >> np.uint64(32)).astype(np.uint32)
    values, places = np.empty((0, HASHES), np.uint32), np.empty((0, HASHES), np.int64)
    for at in range(0, len(codes), CHUNK):
        found = two_least(short[None, at : at + CHUNK] * MULTIPLIERS[:, None], at)
        values, places = np.concatenate([values, found[0]]), np.concatenate([places, found[1]])
        order = np.argsort(values, axis=0, kind="stable")[:2]
        values, places = np.take_along_axis(values, order, 0), np.take_along_axis(places, order, 0)
    ahead, behind = places.min(axis=0), places.max(axis=0)
    pairs = mixed(codes[ahead] * BASE + codes[behind])
    return (pairs >> np.uint64(32)).astype(np.uint32)


def to_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def hexed(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many from the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


class Slices:
    """Ranges of ids, the least ids first; null ids come before all of them."""

    def __init__(self, bounds: list[int], heads: dict[int, int | None]):
        self.bounds, self.heads = np.array(bounds, np.int64), heads
        filled = sorted(heads)
        # The head of a slice follows the last document of the slice above; the uppermost head follows the very last one.
        self.copied_to = dict(zip(filled, [*filled[1:], filled[0]])) if filled else {}

    def of(self, ids: list[int | None]) -> list[int]:
        values = np.searchsorted(self.bounds, np.array([0 if x is None else x for x in ids], np.int64), side="left")
        return [0 if x is None else int(v) for x, v in zip(ids, values)]


def slices_of(rows: DataFrame) -> Slices:
    """Quantiles of the ids and the greatest id of each slice; reads ids alone."""
    ids = rows.select("doc_id")
    n = min(MOST_SLICES, 4 * ids.rdd.getNumPartitions())
    cuts = [i / n for i in range(1, n)] or [0.5]
    bounds = ids.agg(F.percentile_approx("doc_id", cuts, max(10_000, 10 * n)).alias("b")).first()["b"] or []
    shape = Slices(sorted(set(bounds)), {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_pydict({"slice": pa.array(shape.of(column), pa.int32()), "doc_id": pa.array(column, pa.int64())})

    heads = ids.mapInArrow(run, "slice int, doc_id bigint").groupBy("slice").agg(F.max("doc_id").alias("head")).collect()
    return Slices(sorted(set(bounds)), {row["slice"]: row["head"] for row in heads})


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Ids are integers.  Descending ids have nulls last; rows that share an id follow each other in the order
    of a hash of their texts; a single row is its own successor.  Null text counts as empty, whose
    fingerprint is all zeros and like itself; an empty table gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))
    slices = slices_of(rows)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, home, text in zip(ids, slices.of(ids), texts(batch)):
                tie, packed = int.from_bytes(hashlib.blake2b(text, digest_size=7).digest(), "big"), pack(text)
                out.append((home, False, doc_id, tie, packed))
                if slices.heads[home] == doc_id:
                    out.append((slices.copied_to[home], True, doc_id, tie, packed))
            kinds = {"slice": pa.int32(), "copy": pa.bool_(), "doc_id": pa.int64(), "tie": pa.int64(), "packed": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(kinds.items())})

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        kinds = {
            "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
            "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
        }
        before = None  # the row that waits for its successor
        for batch in batches:
            out: list[tuple] = []
            for home, copy, doc_id, packed in zip(*(batch.column(x).to_pylist() for x in ("slice", "copy", "doc_id", "packed"))):
                same = before is not None and before[0] == home and not before[1]
                if copy and not same:
                    continue
                text = unpack(packed).decode()
                row = (home, copy, doc_id, text, signature(to_points(text)))
                if same:
                    changed = edited(before[3], text)
                    new = signature(to_points(changed))
                    out.append((
                        before[2], len(before[3]), hashlib.sha256(changed.encode()).hexdigest(), hexed(before[4]), hexed(new),
                        likeness(before[4], new), likeness(before[4], row[4]),
                    ))
                before = row
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(kinds.items())})

    routed = rows.mapInArrow(route, "slice int, copy boolean, doc_id bigint, tie bigint, packed binary")
    dealt = routed.repartition(max(1, len(slices.heads)), "slice")
    return dealt.sortWithinPartitions("slice", "copy", F.col("doc_id").desc_nulls_last(), "tie").mapInArrow(
        walk,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
