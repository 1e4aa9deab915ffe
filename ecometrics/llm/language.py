"""Language identification with string kernels.

A text is the set of its letter n-grams of length 1 to 3 (a blended spectrum, presence only).  The
kernel of two texts is the size of the sets' intersection over the geometric mean of their sizes.
A Nyström map over a few landmark texts makes kernel ridge regression, one language against the
rest, a small linear model; scoring a batch of documents is two matrix products.

The fit uses a bounded sample of every label: ``sample_rows`` rows shared evenly, at most ``per_language`` and at
least ``LEAST_ROWS`` each, and of a longer text an excerpt of ``sample_chars`` characters.  Documents are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.llm.common import held_out, prepared, worker_state
from ecometrics.operators.ranking import first_per_class
from ecometrics.session import settle

NO_LANGUAGE = "und"
BLANK = np.uint32(32)
LEAST_ROWS, LEAST_LANDMARKS = 8, 2  # of each label
BLOCK_GRAMS = 65_536  # columns of a matrix product, whatever the size of the alphabet


@cache
def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(x).isalpha() for x in range(0x110000)), bool, 0x110000)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with one blank for each run of anything but letters, and one at each end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = letter_table()[points]
    if not inside.any():
        return np.empty(0, np.uint32)
    kept = inside | np.append(False, inside[:-1])
    points = np.where(inside, points, BLANK)[kept]
    return np.concatenate([[BLANK], points, [BLANK] if points[-1] != BLANK else []]).astype(np.uint32)


def grams(text: str | None, longest: int = 3) -> np.ndarray:
    """The sorted distinct n-grams of the lower-cased letters; runs of anything else count as one blank."""
    points = letters(text or "").astype(np.uint64)
    if not points.size:
        return points
    parts, code = [points], points
    for n in range(1, longest):
        code = (code[:-1] << np.uint64(21)) | points[n:]
        parts.append(code)
    every = np.sort(np.concatenate(parts))
    return every[np.append(True, every[1:] != every[:-1])]


class Model:
    """Landmark n-grams, the landmarks' rows over them, and a weight vector per language."""

    def __init__(self, samples: list[tuple[str, str]], landmarks: int, ridge: float):
        self.labels = sorted({label for _, label in samples})
        sets = [grams(text) for text, _ in samples]
        by_label: dict[str, list[int]] = {}
        for i, (_, label) in enumerate(samples):
            if sets[i].size:
                by_label.setdefault(label, []).append(i)
        self.labels = sorted(by_label)
        # Landmarks: the same number of each language, in the order of the sample.
        share = max(LEAST_LANDMARKS, landmarks // max(1, len(self.labels)))
        chosen = [i for label in self.labels for i in by_label[label][:share]]
        self.alphabet = np.unique(np.concatenate([sets[i] for i in chosen])) if chosen else np.empty(0, np.uint64)
        self.sizes = np.sqrt(np.array([sets[i].size for i in chosen], np.float32))
        self.places = [np.searchsorted(self.alphabet, sets[i]).astype(np.int32) for i in chosen]
        self.first_block = self.rows(0)
        used = [i for i in range(len(samples)) if sets[i].size]
        if not used:
            self.weights = np.zeros((0, 0), np.float32)
            return
        across = self.kernel([sets[i] for i in used]).astype(np.float64)
        among = self.kernel([sets[i] for i in chosen]).astype(np.float64)
        goal = np.array([[1.0 if samples[i][1] == label else -1.0 for label in self.labels] for i in used])
        # Each language weighs the same, however often the sample has it.
        weight = np.array([1.0 / len(by_label[samples[i][1]]) for i in used])[:, None]
        left = across.T @ (weight * across) + ridge * among + 1e-6 * np.eye(len(chosen))
        self.weights = np.linalg.solve(left, across.T @ (weight * goal)).astype(np.float32)

    def rows(self, at: int) -> np.ndarray:
        """Landmarks by the grams of the block that begins at ``at``."""
        block = np.zeros((len(self.places), min(BLOCK_GRAMS, self.alphabet.size - at)), np.float32)
        for row, places in enumerate(self.places):
            low, high = np.searchsorted(places, (at, at + BLOCK_GRAMS))
            block[row, places[low:high] - at] = 1
        return block

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Texts by landmarks: presence times presence, a block of the alphabet at a time."""
        out = np.zeros((len(sets), len(self.places)), np.float32)
        sizes = np.array([max(found.size, 1) for found in sets], np.float32) ** 0.5
        for at in range(0, self.alphabet.size, BLOCK_GRAMS):
            grams_here = self.alphabet[at : at + BLOCK_GRAMS]
            present = np.zeros((len(sets), grams_here.size), np.float32)
            for row, found in enumerate(sets):
                low, high = np.searchsorted(found, (grams_here[0], grams_here[-1]))
                found = found[low : high + 1]
                places = np.minimum(np.searchsorted(grams_here, found), grams_here.size - 1)
                present[row, places[grams_here[places] == found]] = 1
            out += present @ (self.rows(at) if at else self.first_block).T
        return out / (sizes[:, None] * self.sizes[None, :])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        sets = [grams(x) for x in texts]
        labels, scores = [NO_LANGUAGE] * len(texts), [0.0] * len(texts)
        has = [i for i, x in enumerate(sets) if x.size]
        if has and self.labels:
            values = self.kernel([sets[i] for i in has]) @ self.weights
            best = values.argmax(axis=1)
            for row, i in enumerate(has):
                labels[i] = self.labels[best[row]]
                scores[i] = float(np.clip((values[row, best[row]] + 1) / 2, 0, 1))
        return labels, scores


def fit(
    docs: DataFrame,
    training: Column,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = 300,
    sample_rows: int = 9_600,
    sample_chars: int = 20_000,
    landmarks: int = 128,
    ridge: float = 1e-3,
) -> Model:
    """Learn from rows where ``training`` holds and the label is known; the same rows in every run.

    Labels are counted over all data and all learned; of each the rows of least hash are taken.  An excerpt begins where
    the row's hash says, so that long texts are not known by their beginnings alone.
    """
    order = F.xxhash64(docs[id_col].cast("string"), F.md5(docs[text_col]))
    known = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang"), order.alias("order"), training.alias("training")).where(
        F.col("training") & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = settle(known.groupBy(F.col("lang").alias("label")).agg(F.count("*").alias("n")), "labels")
    each = max(LEAST_ROWS, min(per_language, sample_rows // max(1, counts.count())))
    # A share of hashes that is expected to hold a few rows more than are wanted, so that few texts are sorted.
    share = F.least(F.lit(1.0), F.lit(1.5 * each + 50) / F.col("n"))
    begin = F.pmod("order", F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    near = known.join(counts, F.col("lang") == F.col("label")).where(F.col("order").cast("double") <= share * 2.0**64 - 2.0**63)
    cut = near.select(F.substring("text", begin, F.lit(sample_chars)).alias("text"), "lang", "order")
    rows = first_per_class(cut, ["lang"], [F.col("order"), F.col("text")], each).orderBy("order", "lang", "text").collect()
    samples = [(row["text"], row["lang"]) for row in rows]
    return Model(samples, landmarks, ridge)


def predicted(docs: DataFrame, model: Model, text_col: str, keep: list[Column]) -> DataFrame:
    """The columns ``keep`` with __lid_pred and __lid_score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, docs[text_col].alias("__lid_text"))
    scored = [T.StructField("__lid_pred", T.StringType()), T.StructField("__lid_score", T.DoubleType())]
    schema = T.StructType([*rows.schema.fields[:-1], *scored])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language")
        for batch in batches:
            column = batch.column("__lid_text").to_pylist()
            labels, scores = [], []
            for at in range(0, len(column), 128):
                found = shared.value.predict(column[at : at + 128])
                labels += found[0]
                scores += found[1]
            arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
            arrays += [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def identify(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 5,
    **limits,
) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score.

    Rows whose crc32 of the id as text is a multiple of ``folds`` are held out of the fit (null ids hash
    the empty text).  Null, empty and letterless texts are ``und`` with score 0, as is everything when
    no labelled row can be learned from; ties go to the label that sorts first; rows are kept one by
    one; an empty table gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    out = held_out(id_col, folds, 0)
    model = fit(docs, ~out, text_col=text_col, lang_col=lang_col, id_col=id_col, **limits)
    found = predicted(docs, model, text_col, [docs[id_col].alias("doc_id"), out.alias("held_out")])
    return found.withColumnsRenamed({"__lid_pred": "lang_pred", "__lid_score": "score"})


def reject(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rare: float = 0.001,
    lowest: float = 0.51,
    highest: float = 0.55,
) -> DataFrame:
    """The rows, all columns, whose text is like a learned language.

    The model has no bias, so a text that shares nothing with any language scores 0.5, and one that shares letters
    but not their sequences scores less.  A text stays if its score reaches the ``rare`` quantile of the scores of
    all labelled texts, which is held between ``lowest`` and ``highest``: labelled noise can't lower it to the score of
    unlike texts, and texts well above that are never lost.  The fit learns from all labelled rows within its
    bounds.  Rows stay as they are, repeated ones too; null, empty and letterless texts go; an empty table gives no rows.
    """
    prepared(docs.sparkSession)
    model = fit(docs, F.lit(True), text_col=text_col, lang_col=lang_col, id_col=id_col)
    labelled = predicted(docs.where(docs[lang_col].isNotNull()), model, text_col, []).where(F.col("__lid_pred") != NO_LANGUAGE)
    quantile = labelled.agg(F.percentile_approx("__lid_score", rare, 10_000).alias("x")).first()["x"]
    least = min(max(lowest if quantile is None else quantile, lowest), highest)
    scored = predicted(docs, model, text_col, [docs[c] for c in docs.columns])
    return scored.where((F.col("__lid_pred") != NO_LANGUAGE) & (F.col("__lid_score") >= least)).select(*docs.columns)
