"""Language-model scores from an Elias-Fano trie of n-grams, in shards by context.

Texts are read once, into chunks of whole documents: the hashes of a chunk's distinct words, and its words by
their numbers among them.  A chunk sends each of its distinct words, pairs and triples once, with the times it
occurs in training documents, to the shard of its context.  A shard adds the counts up, builds its part of the
trie, and answers every chunk that asked; the chunk puts the answers where its words are.

A level of the trie holds contexts (a word, or two), pointers from each context to its successors, the successors,
and quantised probabilities.  Contexts and pointers are monotone sequences, and so are the successors once each context
starts where the one before it ended; all three are Elias-Fano coded.  Looking up a word is a successor search in
its context's range.  A shard's level is a file that its task maps into memory, and is kept with the answers.

Probabilities interpolate by absolute discounting.  Pairs and triples that occur ``LEAST`` times or more are kept, however many
there are, and the mass of the rest goes to the shorter context; counts of words are exact.  Nothing is broadcast and nothing but three
sums reaches the driver: shards and chunks grow in number with the input, not in size.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecometrics.llm.common import held_out, prepared, texts, worker_state
from ecometrics.llm.elias_fano import Sequence, mapped, to_bytes
from ecometrics.session import settle

BEGIN, END = b"\t", b"\n"  # no word holds white space
DISCOUNT = 0.75
LEAST = 2
KEY_BITS, SUCCESSOR_BITS = 62, 48
STEPS = 4096  # of a quantised probability, for each power of ten
ABSENT = 65535
ASKED, AT_ONCE = 500_000, 32_768  # grams that a shard answers together; of these, numbers looked up at once


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: lowers A-Z alone


def word_keys(words) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return (np.fromiter(map(digest, words), np.uint64, len(words)) >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed = (mixed + second.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The keys' range is cut evenly, so keys in order are in order of their shards."""
    return ((keys >> (KEY_BITS - 32)) * shards) >> 32


# --- packed arrays -------------------------------------------------------------------------------------------------


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of longs, first bytes first."""
    return np.ascontiguousarray(values.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(raw: bytes, at: int, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
    return out.view(np.int64).ravel()


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of longs with the bytes that each needs, compressed."""
    head = np.array([len(columns), *(x for values, width in columns for x in (len(values), width))], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes(*x) for x in columns))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    columns = int(np.frombuffer(raw, np.int64, 1)[0])
    shape = np.frombuffer(raw, np.int64, 2 * columns, 8)
    at, out = 8 + 16 * columns, []
    for n, width in shape.reshape(-1, 2).tolist():
        out.append(from_planes(raw, at, n, width))
        at += n * width
    return out


# --- chunks --------------------------------------------------------------------------------------------------------


@dataclass
class Grams:
    """Distinct grams in the order of their contexts' keys and then their successors'."""

    codes: np.ndarray  # place of the context, place of the word
    contexts: np.ndarray  # keys, each once
    runs: np.ndarray  # successors of each context
    successors: np.ndarray
    counts: np.ndarray  # in training documents
    number: np.ndarray  # of the gram at each place

    @classmethod
    def of(cls, context: np.ndarray, word: np.ndarray, context_keys: np.ndarray, word_keys: np.ndarray, trained: np.ndarray) -> Grams:
        """``context`` and ``word``, by place, are places among sorted keys."""
        codes, number = np.unique(context * np.int64(len(word_keys)) + word, return_inverse=True)
        contexts, runs = np.unique(codes // len(word_keys), return_counts=True)
        counts = np.bincount(number, weights=trained, minlength=len(codes)).astype(np.int64)
        successors = word_keys[codes % len(word_keys)] >> (KEY_BITS - SUCCESSOR_BITS)
        return cls(codes, context_keys[contexts], runs, successors, counts, number)

    def blocks(self, shards: int) -> Iterator[tuple[int, bytes]]:
        shard = shard_of(self.contexts, shards)
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        ends = np.append(0, np.cumsum(self.runs))
        for i in np.unique(shard).tolist():
            a, b = cuts[i], cuts[i + 1]
            c, d = ends[a], ends[b]
            keys = np.diff(self.contexts[a:b], prepend=0)
            yield i, pack((keys, 8), (self.runs[a:b], 4), (self.successors[c:d], SUCCESSOR_BITS // 8), (self.counts[c:d], 4))


class Chunk:
    """The words of whole documents, by their places among the sorted keys of the distinct ones."""

    def __init__(self, vocabulary: np.ndarray, words: np.ndarray, sizes: np.ndarray, held: np.ndarray):
        order = np.argsort(vocabulary, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.words, self.sizes = vocabulary[order], place[words], sizes
        self.starts = np.cumsum(sizes + 2) - sizes - 2
        self.trained = np.repeat(~held, sizes + 2).astype(np.float64)
        scored = np.ones(len(words), bool)
        scored[self.starts] = False
        self.at = np.flatnonzero(scored)  # where a probability is asked for
        self.third = np.flatnonzero(scored[self.at - 1])  # of these, where two words precede

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.words[self.at], weights=self.trained[self.at], minlength=len(self.keys)).astype(np.int64)

    def word_blocks(self, shards: int) -> Iterator[tuple[int, bytes]]:
        shard, counts = shard_of(self.keys, shards), self.word_counts()
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        for i in np.unique(shard).tolist():
            part = slice(cuts[i], cuts[i + 1])
            yield i, pack((np.diff(self.keys[part], prepend=0), 8), (counts[part], 8))

    def pairs(self) -> Grams:
        return Grams.of(self.words[self.at - 1], self.words[self.at], self.keys, self.keys, self.trained[self.at])

    def triples(self, pairs: Grams, chosen=None) -> Grams:
        """All, or those whose contexts' keys are ``chosen``."""
        # The pair that ends before each third word, numbered by the order of the pairs' keys.
        keys = pair_keys(self.keys[pairs.codes // len(self.keys)], self.keys[pairs.codes % len(self.keys)])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        context, at, keys = place[pairs.number[self.third - 1]], self.at[self.third], keys[order]
        if chosen is not None:
            some = chosen(keys)[context]
            context, at = context[some], at[some]
        return Grams.of(context, self.words[at], keys, self.keys, self.trained[at])


CHUNK_SCHEMA = "chunk bigint, doc_ids array<{kind}>, held array<boolean>, sizes array<bigint>, trained bigint, body binary"


def chunks(rows: DataFrame, chunk_words: int) -> DataFrame:
    """Whole documents in chunks of about ``chunk_words`` words, a longer document in one of its own."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("lm")
        name = TaskContext.get().partitionId() << 32
        words, ids, held, size = [], [], [], 0  # words of each document

        def out() -> pa.RecordBatch:
            nonlocal name, size
            sizes = np.array([len(x) - 2 for x in words], np.int64)
            outside = pa.concat_arrays(held)
            trained = int((sizes + 1)[~outside.to_numpy(zero_copy_only=False)].sum())
            coded = pa.concat_arrays(words).dictionary_encode()
            body = pack((word_keys(coded.dictionary.to_pylist()), 8), (coded.indices.to_numpy(), 4))
            record = pa.RecordBatch.from_pydict({
                "chunk": pa.array([name], pa.int64()), "doc_ids": one_list(pa.concat_arrays(ids)), "held": one_list(outside),
                "sizes": one_list(pa.array(sizes)), "trained": pa.array([trained], pa.int64()), "body": pa.array([body], pa.binary()),
            })
            name, size = name + 1, 0
            words.clear(), ids.clear(), held.clear()
            return record

        for batch in batches:
            begun = 0
            for i, text in enumerate(texts(batch)):
                words.append(pa.array([BEGIN, *words_of(text), END], pa.large_binary()))
                size += len(words[-1])
                if size >= chunk_words or i + 1 == batch.num_rows:
                    ids.append(batch.column("doc_id").slice(begun, i + 1 - begun))
                    held.append(batch.column("held_out").slice(begun, i + 1 - begun))
                    begun = i + 1
                if size >= chunk_words:
                    yield out()
        if words:
            yield out()

    return rows.mapInArrow(run, CHUNK_SCHEMA.format(kind=kind))


def one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def read_chunk(columns, i: int) -> Chunk:
    vocabulary, words = unpack(columns.column("body")[i].as_py())
    sizes, held = (np.array(columns.column(x)[i].as_py()) for x in ("sizes", "held"))
    return Chunk(vocabulary, words, sizes.astype(np.int64), held.astype(bool))


# --- shards --------------------------------------------------------------------------------------------------------


def quantised(values: np.ndarray) -> np.ndarray:
    """Steps of a 4096th of a power of ten down from 1, the same in every shard."""
    return np.clip(np.rint(-np.log10(np.maximum(values, 1e-15)) * STEPS), 0, ABSENT - 1).astype(np.uint16)


def value_of(codes: np.ndarray) -> np.ndarray:
    return np.where(codes == ABSENT, 0.0, 10.0 ** (-codes / STEPS))


def find(sequence: Sequence, values: np.ndarray) -> np.ndarray:
    """The place of each value, or -1."""
    out = np.full(len(values), -1, np.int64)
    if sequence.n:
        inside = np.flatnonzero(values <= sequence.access(np.array([sequence.n - 1]))[0])
        for at in range(0, len(inside), AT_ONCE):
            some = inside[at : at + AT_ONCE]
            out[some] = sequence.find(values[some])
    return out


def find_repeated(sequence: Sequence, values: np.ndarray) -> np.ndarray:
    """The same for values that come more than once, in any order: each is looked up once."""
    distinct, number = np.unique(values, return_inverse=True)
    return find(sequence, distinct)[number]


class Level:
    """Contexts, their successors, and what the grams and contexts are worth."""

    SEQUENCES = ("contexts", "words", "pointers", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.contexts, self.words, self.pointers, self.ids = (
            Sequence({x: arrays[f"{name}.{x}"] for x in Sequence.PARTS}) for name in self.SEQUENCES
        )
        self.share, self.left = arrays["share"], arrays["left"]

    @classmethod
    def build(cls, contexts: np.ndarray, successors: np.ndarray, counts: np.ndarray, least: int = LEAST) -> dict[str, np.ndarray]:
        """From all grams and their counts, in order; grams below ``least`` count in their context's total alone."""
        first = np.flatnonzero(np.append(True, contexts[1:] != contexts[:-1])) if len(contexts) else np.empty(0, np.int64)
        totals = np.add.reduceat(counts, first) if len(first) else counts
        context = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(contexts))))
        kept = np.flatnonzero(counts >= least)
        share = (counts[kept] - DISCOUNT) / totals[context[kept]]
        used, context = np.unique(context[kept], return_inverse=True)
        left = np.clip(1 - np.bincount(context, weights=share, minlength=len(used)), 1e-9, 1)
        words, ids = np.unique(successors[kept], return_inverse=True)
        last = np.flatnonzero(np.append(context[1:] != context[:-1], True)) if len(kept) else np.empty(0, np.int64)
        base = np.append(0, np.cumsum(ids[last] + 1))[: len(last)]
        relative = ids + np.repeat(base, np.diff(np.append(-1, last)))
        sequences = (contexts[first][used], words, np.searchsorted(context, np.arange(len(used) + 1)), relative)
        out = {f"{name}.{k}": v for name, values in zip(cls.SEQUENCES, sequences) for k, v in Sequence.build(values).parts.items()}
        return out | {"share": quantised(share), "left": quantised(left)}

    def ranges(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each context's successors begin and end, and what their ids count from."""
        begin, end = self.pointers.access(context), self.pointers.access(context + 1)
        base = np.zeros(len(context), np.int64)
        later = np.flatnonzero(begin > 0)
        base[later] = self.ids.access(begin[later] - 1) + 1
        return begin, end, base

    def answer(self, contexts: np.ndarray, runs: np.ndarray, successors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of the mass that each context leaves, and of each gram's share of its context."""
        known = find_repeated(self.contexts, contexts)
        left = np.zeros(len(contexts), np.int64)
        some = np.flatnonzero(known >= 0)
        left[some] = self.left[known[some]]
        share = np.full(len(successors), ABSENT, np.int64)
        at = np.flatnonzero(np.repeat(known >= 0, runs))  # grams whose context is known
        context, number = np.unique(known[some], return_inverse=True)
        begin, end, base = self.ranges(context)
        number, word = np.repeat(number, runs[some]), find_repeated(self.words, successors[at])
        both = np.flatnonzero(word >= 0)
        number = number[both]
        places = find(self.ids, base[number] + word[both])
        hit = np.flatnonzero((places >= begin[number]) & (places < end[number]))
        share[at[both[hit]]] = self.share[places[hit]]
        return left, share


def parts(values: np.ndarray, blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The values that belong to each of the blocks."""
    return np.split(values, np.cumsum([len(x) for x in blocks])[:-1])


class Shard:
    """Adds up the counts of one order's blocks and answers them; the blocks wait in their packed form."""

    def __init__(self, order: int):
        self.order, self.blocks, self.held, self.waiting = order, [], [], 0
        self.total = tuple(np.empty(0, np.int64) for _ in range(2 if order == 1 else 3))

    def columns(self, block: bytes) -> list[np.ndarray]:
        found = unpack(block)
        return [np.cumsum(found[0]), *found[1:]]

    def add(self, chunk: int, block: bytes) -> None:
        self.blocks.append((chunk, block))
        found = self.columns(block)
        if self.order > 1:
            found = [np.repeat(found[0], found[1]), *found[2:]]
        trained = found[-1] > 0
        self.held.append([x[trained] for x in found])
        self.waiting += int(trained.sum())
        if self.waiting > max(500_000, len(self.total[0])):
            self.fold()

    def fold(self) -> None:
        *keys, counts = (np.concatenate(x) for x in zip(self.total, *self.held))
        order = np.argsort(keys[0], kind="stable") if self.order == 1 else np.lexsort(keys[::-1])
        keys, counts = [x[order] for x in keys], counts[order]
        changes = np.zeros(len(counts), bool)
        changes[:1] = True
        for x in keys:
            changes[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(changes)
        self.total = (*(x[first] for x in keys), np.add.reduceat(counts, first) if len(first) else counts)
        self.held, self.waiting = [], 0

    def built(self) -> dict[str, np.ndarray]:
        self.fold()
        if self.order > 1:
            return Level.build(*self.total)
        return {f"words.{k}": v for k, v in Sequence.build(self.total[0]).parts.items()} | {"counts": self.total[1]}

    def answers(self, arrays: dict[str, np.ndarray]) -> Iterator[tuple[int, bytes]]:
        if self.order > 1:
            level = Level(arrays)
            for names, (contexts, runs, successors) in self.together(3):
                left, share = level.answer(*map(np.concatenate, (contexts, runs, successors)))
                for name, a, b in zip(names, parts(left, contexts), parts(share, successors)):
                    yield name, pack((a, 2), (b, 2))
            return
        words = Sequence({x: arrays[f"words.{x}"] for x in Sequence.PARTS})
        for names, (keys,) in self.together(1):
            places = find_repeated(words, np.concatenate(keys))
            counts = np.zeros(len(places), np.int64)
            counts[places >= 0] = arrays["counts"][places[places >= 0]]
            for name, a in zip(names, parts(counts, keys)):
                yield name, pack((a, 8))

    def together(self, columns: int) -> Iterator[tuple[list[int], list[list[np.ndarray]]]]:
        """All blocks, some at a time: their chunks, and each of the first columns."""
        names, held, size = [], [[] for _ in range(columns)], 0
        for chunk, block in self.blocks:
            names.append(chunk)
            for column, values in zip(held, self.columns(block)):
                column.append(values)
            size += len(held[-1][-1])
            if size >= ASKED:
                yield names, held
                names, held, size = [], [[] for _ in range(columns)], 0
        if names:
            yield names, held


def level_file(raw: bytes) -> dict[str, np.ndarray]:
    """The arrays, mapped from a file in the executor's own folder that lives as long as the mapping."""
    with tempfile.NamedTemporaryFile(dir=SparkFiles.getRootDirectory()) as file:
        file.write(raw)
        file.flush()
        return mapped(file.name)


def answered(chunked: DataFrame, shards: int, low: int, high: int) -> DataFrame:
    """(shard, chunk, types, body): for each shard its answers by chunk, and its level with no chunk and the number of its words.

    Of the shards of words, then of pairs, then of triples those from ``low`` on and below ``high``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("lm")
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = read_chunk(batch, i)
                for order, blocks in enumerate(orders(chunk)):
                    found = [(order * shards + x, block) for x, block in blocks]
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([x for x, _ in found], pa.int32()),
                        "chunk": pa.array([batch.column("chunk")[i].as_py()] * len(found), pa.int64()),
                        "body": pa.array([x for _, x in found], pa.binary()),
                    })

    def orders(chunk: Chunk) -> Iterator[Iterator[tuple[int, bytes]]]:
        def chosen(order: int):
            def within(keys: np.ndarray) -> np.ndarray:
                shard = order * shards + shard_of(keys, shards)
                return (shard >= low) & (shard < high)

            return within

        yield chunk.word_blocks(shards) if low == 0 else iter(())
        pairs = chunk.pairs()
        yield pairs.blocks(shards) if low <= shards < high else iter(())
        yield chunk.triples(pairs, chosen(2)).blocks(shards) if high > 2 * shards else iter(())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("lm")
        name, shard = None, None

        def rows(found: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([name] * len(found), pa.int32()), "chunk": pa.array([x for x, _, _ in found], pa.int64()),
                "types": pa.array([x for _, x, _ in found], pa.int64()), "body": pa.array([x for _, _, x in found], pa.binary()),
            })

        def out() -> Iterator[pa.RecordBatch]:
            raw = to_bytes(shard.built())
            yield rows([(None, len(shard.total[0]) if shard.order == 1 else 0, raw)])
            shard.total = ()
            for chunk, body in shard.answers(level_file(raw)):
                yield rows([(chunk, 0, body)])

        for batch in batches:
            for i, place in enumerate(batch.column("shard").to_pylist()):
                if place != name:
                    if shard is not None:
                        yield from out()
                    name, shard = place, Shard(1 + place // shards)
                shard.add(batch.column("chunk")[i].as_py(), batch.column("body")[i].as_py())
        if shard is not None:
            yield from out()

    sent = chunked.mapInArrow(send, "shard int, chunk bigint, body binary")
    dealt = sent.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(answer, "shard int, chunk bigint, types bigint, body binary")


@contextmanager
def finished_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run meanwhile remove their shuffle files when they end, instead of whenever the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scored(chunk: Chunk, counts: np.ndarray, answers: list[tuple[np.ndarray, np.ndarray]], denominator: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By document: known words, log10 probability by words alone, log10 probability by the model."""
    p = (counts[chunk.words[chunk.at]] + 1) / denominator
    base = np.log10(p)
    pairs = chunk.pairs()
    for grams, (left, share), at in zip((pairs, chunk.triples(pairs)), answers, (slice(None), chunk.third)):
        p[at] = value_of(share)[grams.number] + value_of(np.repeat(left, grams.runs))[grams.number] * p[at]
    begin = np.cumsum(chunk.sizes + 1) - chunk.sizes - 1
    known = counts[chunk.words[chunk.at]] > 0
    return tuple(np.add.reduceat(x, begin) for x in (known.astype(np.int64), base, np.log10(p)))


def score(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 7,
    fold: int = 2,
    chunk_words: int = 1_000_000,
    shard_words: int = 1_000_000,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows whose crc32 of the id as text is not ``fold`` modulo ``folds`` (a null id hashes
    the empty text); all of its counts and all grams that occur twice are used, at every size of the input.
    ``chunk_words`` and ``shard_words`` say how many words there are to a chunk and, on average, to a shard; results
    do not depend on them.  Null and empty texts are one end token; without training documents every probability of a
    word is 1; repeated rows count and are scored one by one; an empty table gives no rows; other columns are not read.
    """
    spark = prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), held_out(id_col, folds, fold).alias("held_out"), docs[text_col].alias("text"))
    chunked = settle(chunks(rows, chunk_words), "chunks")
    sums = chunked.select(F.sum("trained").alias("trained"), F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b + 1)).alias("all")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sums["all"] or 0) // shard_words))
    # Words and pairs, then triples by halves: the blocks of one round are gone before the next round sends its own.
    cuts = (0, 2 * shards, 2 * shards + shards // 2, 3 * shards)
    with finished_shuffles_removed(spark):
        rounds = [settle(answered(chunked, shards, low, high), "answers") for low, high in zip(cuts, cuts[1:])]
    replies = reduce(DataFrame.union, rounds)
    n, v = sums["trained"] or 0, replies.agg(F.sum("types").alias("types")).first()["types"] or 0
    denominator = float(n + v + 1)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = read_chunk(left, 0)
        right = right.sort_by("shard")
        found: list[list[list[np.ndarray]]] = [[], [], []]
        for shard, body in zip(right.column("shard").to_pylist(), right.column("body").to_pylist()):
            found[shard // shards].append(unpack(body))
        counts, *answers = ([np.concatenate(x) for x in zip(*part)] or [np.empty(0, np.int64)] * 2 for part in found)
        known, base, model = scored(chunk, counts[0], answers, denominator)
        size = len(known)
        return pa.table({
            "doc_id": left.column("doc_ids").combine_chunks().flatten(), "held_out": left.column("held").combine_chunks().flatten(),
            "n_tokens": pa.array(chunk.sizes + 1), "n_known": pa.array(known), "train_tokens": pa.array(np.full(size, n, np.int64)),
            "base_score": pa.array(base), "score": pa.array(model),
        })

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    asked = replies.where(F.col("chunk").isNotNull()).select("chunk", "shard", "body")
    return chunked.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(finish, schema)
