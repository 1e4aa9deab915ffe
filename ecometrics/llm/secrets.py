"""Secret scans: fixed patterns, and strings that pass a battery of randomness tests.

A candidate is a long run of key characters.  Its encoding is the smallest alphabet that holds all of them.
Three tests ask whether it could be drawn evenly from that alphabet: chi-squared on the letters, the number of runs
of one character class, and the serial correlation of neighbours.  Their p-values are combined by Fisher's method.

A short ordinary string may pass as well, so discoveries are controlled by length: all running text of the corpus,
cut into pieces of the same length, each mapped to alphabets of every size, tells how often ordinary strings pass, and in
each alphabet and length the procedure of Benjamini and Hochberg sets the p-value from which on a candidate is taken.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.llm.common import prepared, texts, worker_state

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
# Runs are taken whole, so asking for the least length at once finds what dropping shorter runs would leave.
ACCESS = re.compile("AKIA[A-Z0-9]{12,}")
HEX = re.compile("[0-9a-f]{32,}")
CANDIDATE = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")

DIGITS, UPPER, LOWER = string.digits, string.ascii_uppercase, string.ascii_lowercase
# The encodings, smallest first; of two as small the first that holds all characters is inferred.
ENCODINGS = {
    "decimal": DIGITS,
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "lower": LOWER,
    "upper": UPPER,
    "base32": UPPER + "234567",
    "lower36": DIGITS + LOWER,
    "upper36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/",
    "base64url": UPPER + LOWER + DIGITS + "-_",
}
LENGTHS = (16, 20, 24, 32, 40, 64)  # a candidate is judged with ordinary pieces of the greatest length up to its own
BINS = 100
LOWEST = 8.5  # a sum of weights from which on the combined p-value is in the lowest bin


class Alphabet:
    """Places, character classes and what the tests expect of even draws."""

    def __init__(self, letters: str):
        self.size = k = len(letters)
        self.members = frozenset(letters)
        self.place = {x: i for i, x in enumerate(letters)}
        kinds = ["d" if x in DIGITS else "u" if x in UPPER else "l" if x in LOWER else "o" for x in letters]
        if len(set(kinds)) == 1:  # then the halves of the alphabet
            kinds = [i * 2 // k for i in range(k)]
        names = sorted(set(kinds))
        self.kind = np.array([names.index(x) for x in kinds], np.uint8)
        share = np.bincount(self.kind) / k
        self.change = 1 - float((share**2).sum())
        self.twice = float((share * (1 - share) ** 2).sum())  # a change on both sides of a letter


ALPHABETS = [Alphabet(x) for x in ENCODINGS.values()]
# Alphabets of one size share what ordinary pieces tell, which are mapped to the first of them.
SIZES = sorted({x.size for x in ALPHABETS})
FIRST = [next(x for x in ALPHABETS if x.size == k) for k in SIZES]


PLAIN = (DIGITS + UPPER + LOWER).encode()  # what running text is made of
SYMBOL = np.full(256, len(PLAIN), np.uint8)
SYMBOL[list(PLAIN)] = np.arange(len(PLAIN))


def mapping(alphabet: Alphabet) -> np.ndarray:
    """Places for the letters and digits: one of the alphabet, in either case, has its own; others go by their code."""

    def place(x: str) -> int:
        return next((alphabet.place[y] for y in (x, x.lower(), x.upper()) if y in alphabet.place), ord(x) % alphabet.size)

    return np.array([place(x) for x in PLAIN.decode()], np.uint8)


MAPPINGS = [mapping(x) for x in FIRST]
# Sums of places and of their squares are products with the counts of symbols; whole numbers this small are exact in floats.
WEIGHTS = np.concatenate([[x, x**2] for x in (m.astype(np.float32) for m in MAPPINGS)])


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z) to seven decimals (the polynomial of Abramowitz and Stegun, 26.2.17), not below 1e-7."""
    x = np.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * series
    return np.clip(np.where(z < 0, 1 - upper, upper), 1e-7, 1.0)


def evenness(squares: np.ndarray, n: int, alphabet: Alphabet) -> np.ndarray:
    """p-values of chi-squared, by the sum of the letters' squared counts (Wilson and Hilferty)."""
    freedom = alphabet.size - 1.0
    chi = squares * (alphabet.size / n) - n
    return normal_tail((np.cbrt(chi / freedom) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)))


def runs(changes: np.ndarray, n: int, alphabet: Alphabet) -> np.ndarray:
    """p-values of the number of changes of class."""
    p, q = alphabet.change, alphabet.twice
    variance = (n - 1) * p * (1 - p) + 2 * (n - 2) * (q - p * p)
    return 2 * normal_tail(np.abs(changes - (n - 1) * p) / math.sqrt(variance))


def serial(total: np.ndarray, squares: np.ndarray, products: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """p-values of the correlation of neighbours, by sums of places, their squares, neighbours' products, first and last place."""
    mean = total / n
    power = squares - total * mean
    together = products - mean * (2 * total - ends) + (n - 1) * mean * mean
    correlation = np.divide(together, power, out=np.ones(len(total)), where=power > 0)
    return 2 * normal_tail(np.abs(correlation + 1 / n) * math.sqrt(n))


def weight(p: np.ndarray) -> np.ndarray:
    return -np.log(np.minimum(p, 1.0))


def combined(weights: np.ndarray) -> np.ndarray:
    """Fisher's method: the sum of three tests' weights is half of a chi-squared with six degrees."""
    return np.exp(-weights) * (1 + weights + weights**2 / 2)


def battery(strings: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    """Combined p-value of each row of (rows, length) places under even, independent draws; near 0 for ordinary text."""
    rows, n = strings.shape
    k = alphabet.size
    strings = strings.astype(np.int64)
    counts = np.bincount((np.arange(rows)[:, None] * k + strings).reshape(-1), minlength=rows * k).reshape(rows, k)
    kinds = alphabet.kind[strings]
    sums = (strings.sum(axis=1), (strings**2).sum(axis=1), (strings[:, 1:] * strings[:, :-1]).sum(axis=1))
    return combined(
        weight(evenness((counts**2).sum(axis=1), n, alphabet))
        + weight(runs((kinds[:, 1:] != kinds[:, :-1]).sum(axis=1), n, alphabet))
        + weight(serial(*sums, strings[:, 0] + strings[:, -1], n))
    )


@cache
def weight_tables(size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the two tests that depend on one whole number, for all of its values."""
    alphabet = FIRST[size]
    return weight(evenness(np.arange(n * n + 1), n, alphabet)), weight(runs(np.arange(n), n, alphabet))


def batteries(symbols: np.ndarray) -> Iterator[np.ndarray]:
    """Bins of the ``battery`` of each row of (rows, length) symbols of running text, mapped to the alphabet of every size in turn.

    Symbols are counted once; a size adds up the counts of those that share a place.  Rows that chi-squared alone puts in
    the lowest bin are spared the other tests, which can't raise a p-value.
    """
    rows, n = symbols.shape
    across = symbols.T.astype(np.intp)
    counts = np.bincount((across * rows + np.arange(rows)).reshape(-1), minlength=len(PLAIN) * rows).reshape(len(PLAIN), rows).astype(np.uint8)
    sums = WEIGHTS @ counts.astype(np.float32)
    for size, (alphabet, places) in enumerate(zip(FIRST, MAPPINGS)):
        shared = np.zeros((alphabet.size, rows), np.uint8)
        for place, count in zip(places, counts):
            shared[place] += count
        shared = shared.astype(np.uint16)
        even, run = weight_tables(size, n)
        even = even[(shared * shared).sum(axis=0, dtype=np.uint16)]
        left = np.flatnonzero(even < LOWEST)
        some = across[:, left]
        kinds, x = alphabet.kind[places][some], places.astype(np.float32)[some]
        changes = (kinds[1:] != kinds[:-1]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        moments = (*sums[2 * size : 2 * size + 2, left], np.einsum("ir,ir->r", x[1:], x[:-1]), x[0] + x[-1])
        bins = np.zeros(rows, np.int64)
        bins[left] = bins_of(combined(even[left] + run[changes] + weight(serial(*(m.astype(np.float64) for m in moments), n))))
        yield bins


def bins_of(p: np.ndarray) -> np.ndarray:
    return np.minimum(p * BINS, BINS).astype(np.int64)


def inferred(body: str) -> int | None:
    """Number of the smallest alphabet that holds all characters."""
    found = set(body)
    return next((i for i, x in enumerate(ALPHABETS) if found <= x.members), None)


def length_class(n: int) -> int:
    return max(i for i, x in enumerate(LENGTHS) if x <= n)


def candidates(text: str) -> Iterator[tuple[int, int, int, int, str]]:
    """(start, end, alphabet, length class, body without padding) of strings that have an encoding."""
    for match in CANDIDATE.finditer(text):
        body = match.group().rstrip("=")
        alphabet = inferred(body)
        if alphabet is not None:
            yield match.start(), match.end(), alphabet, length_class(len(body)), body


def score(body: str, alphabet: int) -> float:
    known = ALPHABETS[alphabet]
    return float(battery(np.array([[known.place[x] for x in body]], np.int64), known)[0])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order; matches that fail their check are dropped."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), kind, m.end()) for kind, pattern in ((1, ACCESS), (2, HEX)) for m in pattern.finditer(text)]
    return sorted(spans)


CANDIDATE_BYTES = re.compile(CANDIDATE.pattern.encode())
PIECES = 4096  # that are judged at once


def ordinary_symbols(text: bytes) -> np.ndarray:
    """Letters and digits of a text without its candidates."""
    symbols = SYMBOL[np.frombuffer(CANDIDATE_BYTES.sub(b"", text), np.uint8)]
    return symbols[symbols < len(PLAIN)]


def ordinary_pieces(symbols: np.ndarray, n: int) -> np.ndarray:
    """All of a text in pieces of ``n``, the last of which may begin in the one before; none of a shorter text."""
    pieces = symbols[: len(symbols) // n * n].reshape(-1, n)
    return np.concatenate([pieces, symbols[None, -n:]]) if len(symbols) % n and len(pieces) else pieces


def tallies(rows: DataFrame) -> DataFrame:
    """(size, length, bin, ordinary, found): ordinary pieces and distinct candidates by their combined p-value.

    Every piece counts with every size.  Tasks add pieces up; of candidates they hand on digests, so that a string counts once however often it occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("secrets")
        ordinary = np.zeros((len(SIZES), len(LENGTHS), BINS + 1), np.int64)

        def out(found: list[tuple]) -> pa.RecordBatch:
            size, length, place, n, digest = zip(*found) if found else ((), (), (), (), ())
            return pa.RecordBatch.from_pydict({
                "size": pa.array(size, pa.int32()), "length": pa.array(length, pa.int32()), "bin": pa.array(place, pa.int32()),
                "n": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.binary()),
            })

        for batch in batches:
            found: dict[bytes, tuple] = {}
            running = []
            for text in texts(batch):
                running.append(ordinary_symbols(text))
                for _, _, alphabet, length, body in candidates(text.decode()):
                    digest = hashlib.blake2b(body.encode(), digest_size=16).digest()
                    if digest not in found:
                        place = int(bins_of(score(body, alphabet)))
                        found[digest] = (SIZES.index(ALPHABETS[alphabet].size), length, place, 1, digest)
            for length, n in enumerate(LENGTHS):
                pieces = np.concatenate([ordinary_pieces(x, n) for x in running] or [np.empty((0, n), np.uint8)])
                for at in range(0, len(pieces), PIECES):
                    for size, bins in enumerate(batteries(pieces[at : at + PIECES])):
                        ordinary[size, length] += np.bincount(bins, minlength=BINS + 1)
            yield out(list(found.values()))
        yield out([(*map(int, x), int(ordinary[tuple(x)]), None) for x in np.argwhere(ordinary)])

    each = rows.mapInArrow(run, "size int, length int, bin int, n bigint, digest binary")
    once = each.groupBy("size", "length", "bin", "digest").agg(F.sum("n").alias("n"))
    return once.groupBy("size", "length", "bin").agg(
        F.sum(F.when(F.col("digest").isNull(), F.col("n")).otherwise(0)).alias("ordinary"), F.count("digest").alias("found")
    )


def least_bins(rows: DataFrame, false_share: float, least_p: float) -> np.ndarray:
    """(sizes, lengths): from which bin on a candidate is taken; beyond the last bin where none is.

    A bin's p-value is the share of ordinary pieces that do as well, each count raised by one.  Benjamini and
    Hochberg take the lowest bin at which candidates times p-value is at most ``false_share`` of those taken.
    """
    counts = np.zeros((2, len(SIZES), len(LENGTHS), BINS + 1), np.int64)
    for row in tallies(rows).collect():  # at most sizes x lengths x bins
        counts[:, row["size"], row["length"], row["bin"]] = row["ordinary"], row["found"]
    ordinary, found = counts[..., ::-1].cumsum(axis=-1)[..., ::-1]  # as good or better
    p = (1 + ordinary) / (1 + ordinary[..., :1])
    good = (found[..., :1] * p <= false_share * found) & (found > 0) & (np.arange(BINS + 1) >= least_p * BINS)
    return np.where(good.any(axis=-1), good.argmax(axis=-1), BINS + 1)


def spans_of(text: str, least: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order: base spans, and candidates beside them that are taken."""
    base = base_spans(text)
    reach, ends = 0, []  # greatest end of the base spans up to each
    for _, _, end in base:
        reach = max(reach, end)
        ends.append(reach)
    starts, found = [x[0] for x in base], []
    for start, end, alphabet, length, body in candidates(text):
        before = bisect_left(starts, end)  # base spans that begin before the candidate's end
        if before and ends[before - 1] > start:
            continue
        if int(bins_of(score(body, alphabet))) >= least[SIZES.index(ALPHABETS[alphabet].size), length]:
            found.append((start, 3, end))
    return sorted(base + found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", false_share: float = 0.05, least_p: float = 0.01
) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    ``spans`` lists kind:start:end by start, then kind, code points, end exclusive; ``base_sha256`` digests the list of
    the three fixed kinds.  Strings found random stand beside the fixed kinds, never over them.  ``false_share``
    bounds the expected share of ordinary strings among the distinct strings of one alphabet size and length that are
    taken; ``least_p`` is the p-value below which the battery rejects randomness.  Null text counts as empty (no spans); null
    and repeated ids are kept row by row; an empty table gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    least = least_bins(rows.select("text"), false_share, least_p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("secrets")
        for batch in batches:
            found = [spans_of(text.decode(), least) for text in texts(batch)]
            counts = [[sum(1 for x in spans if x[1] == kind) for spans in found] for kind in range(len(KINDS))]
            base = [hashlib.sha256(joined([x for x in spans if x[1] < 3]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                **{f"n_{kind}": pa.array(n, pa.int64()) for kind, n in zip(KINDS, counts)},
                "base_sha256": pa.array(base, pa.string()), "spans": pa.array(list(map(joined, found)), pa.string()),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{x} bigint" for x in KINDS) + ", base_sha256 string, spans string")
