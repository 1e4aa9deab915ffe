"""Quality rules by distribution divergence.

A language's reference is two histograms over all its documents: classes of characters, and its most
common words (one more bin for all other words).  A document's own histograms are compared with
every reference by the Jensen-Shannon distance (square root of the divergence in bits, 0 to 1); the
nearest reference counts, by both histograms together, so no label is needed to judge a text.  Texts
below a minimum number of words are not judged by distance, because short histograms are far from
any reference by chance.  For the same reason the distance of a short clean text is not below that of a
text without common words (0.5 where they are 42 of 100 words), so that is judged by the share of
common words instead.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecometrics.llm.common import prepared, texts

SYMBOLS = b"#*$%&|<>"
CLASSES = ("white space", "lower case", "upper case", "digit", "sentence mark", "symbol", "other sign", "beyond ASCII")


def _class_of_bytes() -> np.ndarray:
    """The class of each byte; bytes that continue a character count for nothing (the class past the last)."""
    table = np.full(256, CLASSES.index("other sign"))
    table[list(b" \t\n\x0b\x0c\r")] = CLASSES.index("white space")
    table[list(range(ord("a"), ord("z") + 1))] = CLASSES.index("lower case")
    table[list(range(ord("A"), ord("Z") + 1))] = CLASSES.index("upper case")
    table[list(b"0123456789")] = CLASSES.index("digit")
    table[list(b".,;:!?'\"()-")] = CLASSES.index("sentence mark")
    table[list(SYMBOLS)] = CLASSES.index("symbol")
    table[0x80:0xC0] = len(CLASSES)
    table[0xC0:] = CLASSES.index("beyond ASCII")
    return table


CLASS_OF = _class_of_bytes()
ODD = np.uint64(0x9E3779B97F4A7C15)
WINDOW = 5
CLASS_LIMIT, WORD_LIMIT, LEAST_COMMON = 0.3, 0.56, 0.25


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words which occurs twice or more, its first place included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    windows = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        windows = (windows ^ codes[k : k + n]) * ODD
        windows ^= windows >> np.uint64(29)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(np.isin(windows, twice))
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = Counter(x for x in text.split(b"\n") if x.split(None, 1))
    return sum(lines.values()) - len(lines)


def shannon_distance(counts: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of one histogram to each row of references (both of any total)."""
    p = counts / max(counts.sum(), 1)
    q = references / np.maximum(references.sum(axis=1, keepdims=True), 1)
    middle = (p[None, :] + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


class References:
    """Per language the words that have a bin, and the two histograms."""

    def __init__(self, words: dict[str, list[str]]):
        self.languages = sorted(words)
        self.bins = [{w.encode(): i for i, w in enumerate(words[x])} for x in self.languages]
        self.width = max([len(x) for x in self.bins], default=0) + 1
        self.classes = np.zeros((len(self.languages), len(CLASSES)))
        self.common = np.zeros((len(self.languages), self.width))

    def word_counts(self, language: int, words: Counter, total: int) -> np.ndarray:
        counts = np.zeros(self.width)
        bins = self.bins[language]
        for word in words.keys() & bins.keys():
            counts[bins[word]] = words[word]
        counts[-1] = total - counts[:-1].sum()
        return counts

    def nearest(
        self, text: bytes, words: list[bytes], class_limit: float, word_limit: float, least_common: float
    ) -> tuple[float, float, bool]:
        """Distances by characters and by words to one language, and whether it has enough of the words.

        The language is the one of least excess over the limits, among those that have enough of the words if any has.
        """
        if not self.languages or not words:
            return 0.0, 0.0, True
        by_class = shannon_distance(class_counts(text).astype(float), self.classes)
        lowered = Counter(map(bytes.lower, words))
        found = []
        for i in range(len(self.languages)):
            counts, common = self.word_counts(i, lowered, len(words)), self.common[i]
            by_word = float(shannon_distance(counts, common[None, :])[0])
            expected = len(words) * (1 - common[-1] / max(common.sum(), 1))
            enough = counts[:-1].sum() >= math.floor(least_common * expected)
            found.append((not enough, max(by_class[i] / class_limit, by_word / word_limit), float(by_class[i]), by_word))
        few, _, class_distance, word_distance = min(found)
        return class_distance, word_distance, not few

    def distances(
        self, text: bytes, words: list[bytes], class_limit: float = CLASS_LIMIT, word_limit: float = WORD_LIMIT, least_common: float = LEAST_COMMON
    ) -> tuple[float, float]:
        """To the nearest reference, by characters and by words."""
        return self.nearest(text, words, class_limit, word_limit, least_common)[:2]


def label_words(rows: DataFrame, flush: int = 200_000) -> DataFrame:
    """(lang, word, n) over all rows of ``lang`` and ``text``; tasks send partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(found), pa.string()), "word": pa.array(list(found), pa.binary()).cast(pa.string()),
                    "n": pa.array(list(found.values()), pa.int64()),
                })

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                known = counts.setdefault(lang, Counter())
                held -= len(known)
                known.update(text.lower().split())
                held += len(known)
                if held > flush:
                    yield from out()
                    counts.clear()
                    held = 0
        yield from out()

    return rows.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def references(docs: DataFrame, text_col: str, lang_col: str, languages: int, words: int) -> References:
    """Exact counts over all documents with a label: the common words of each, then the bins.

    Every label has a reference with at most ``words`` bins, for words that occur twice or more; the bins of ``languages`` labels are counted in one
    pass, so a task's partial sums are bounded whatever the number of labels.
    """
    rows = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(
        docs[lang_col].cast("string").alias("lang"), docs[text_col].alias("text")
    )
    found: dict[str, list[str]] = {row["lang"]: [] for row in rows.select("lang").distinct().collect()}
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    for row in label_words(rows).where(F.col("n") > 1).withColumn("rank", rank).where(F.col("rank") <= words).orderBy("lang", "rank").collect():
        found[row["lang"]].append(row["word"])
    out = References(found)
    cells = len(CLASSES) + out.width

    def counter(index: dict[str, int]):
        first = min(index.values())

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(index), cells), np.int64)
            for batch in batches:
                for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                    if lang in index:
                        i, split_text = index[lang], text.lower().split()
                        sums[i - first, : len(CLASSES)] += class_counts(text)
                        sums[i - first, len(CLASSES) :] += out.word_counts(i, Counter(split_text), len(split_text)).astype(np.int64)
            lang, cell = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict({"lang": (lang + first).astype(np.int64), "cell": cell.astype(np.int64), "n": sums[lang, cell]})

        return count

    for at in range(0, len(out.languages), languages):
        index = {x: at + i for i, x in enumerate(out.languages[at : at + languages])}
        counted = rows.mapInArrow(counter(index), "lang bigint, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
        for row in counted.toLocalIterator():  # at most languages x cells rows
            if row["cell"] < len(CLASSES):
                out.classes[row["lang"], row["cell"]] = row["n"]
            else:
                out.common[row["lang"], row["cell"] - len(CLASSES)] = row["n"]
    return out


def judge(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    languages: int = 32,
    words: int = 200,
    least_words: int = 50,
    class_limit: float = CLASS_LIMIT,
    word_limit: float = WORD_LIMIT,
    least_common: float = LEAST_COMMON,
) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance.

    base_failed: fewer than 10 words, or over 20 of 100 words in repeated windows.  kept: not base_failed, and
    either fewer than ``least_words`` words, or for one and the same language both distances within their limits and
    at least ``least_common`` of the share of common words that the language's documents have.  Null text has no words
    (base_failed); without any labelled text distances are 0; null and repeated ids are kept row by row;
    an empty table gives no rows; other columns are not read.
    """
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(references(docs, text_col, lang_col, languages, words))
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out: list[tuple] = []
            for text in texts(batch):
                split = text.split()
                classes = class_counts(text)
                n, symbols = len(split), int(classes[CLASSES.index("symbol")])
                chars = int(classes.sum() - classes[CLASSES.index("white space")])
                repeats = repeated_words(split)
                failed = n < 10 or 100 * repeats > 20 * n
                by_class, by_word, enough = known.nearest(text, split, class_limit, word_limit, least_common)
                kept = not failed and (n < least_words or (enough and by_class <= class_limit and by_word <= word_limit))
                out.append((n, chars, symbols, repeated_lines(text), repeats, failed, kept, by_class, by_word))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double"
    )
    names = [x.split()[0] for x in schema.split(", ")]
    return rows.mapInArrow(run, schema)
