"""Remove repeated passages with a sparse suffix array, sorted deep-shallow.

A byte goes if a 200-byte string that covers it starts anywhere else too.  Sorting every suffix of the
corpus would move each byte many times, so only suffixes that can matter are sorted:

1. *Anchors.*  Of the k-grams in a 200-byte string the one of least hash is its anchor.  Equal strings have
   equal anchors at the same place, so a string can only repeat if its anchor does.  Consecutive
   strings with one anchor are a run (about 75 strings); what is kept of a run is two 64-bit digests, of
   the anchor and of the text under the run.
2. *Counting.*  Runs are counted by anchor.  An anchor that occurs once rules its run out.  Runs whose whole text
   occurs again are repeated throughout; of such copies one goes on, to be compared with others.
3. *Sorting.*  The runs that are left share an anchor with others but not all of their text: these are the
   borders of repeated passages.  For each anchor, the suffixes to its right and the reversed prefixes
   to its left are put in deep-shallow order, and the common prefixes of neighbours give, for each string
   of a run, whether some other run has it.
4. *Common anchors.*  An anchor with many different surroundings is not gathered in one task: its runs
   are cut into bands of strings whose common core is counted, band by band, down to single strings.

Everything is counted by hash with partial sums before the shuffle, and texts move once, compressed
and one per distinct text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecometrics.llm.common import prepared, texts
from ecometrics.llm.deep_shallow import order
from ecometrics.session import settle

LENGTH, GRAM = 200, 48
STARTS = LENGTH - GRAM + 1  # strings that can share an anchor
PIECE = 1 << 18  # starts handled at once; a text of any length needs bounded memory
GATHERED = 1024  # runs of one anchor that are sorted together
BANDS = (64, 16, 4, 1)
BASE = 0x9E3779B97F4A7C15
U64 = np.uint64


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    n = PIECE + LENGTH + 1
    up, down = np.full(n, BASE, U64), np.full(n, pow(BASE, -1, 1 << 64), U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each window, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(U64).max, U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(text: bytes) -> tuple[np.ndarray, ...]:
    """For each run: digest of its anchor, digest of its text, the anchor's place, first and last start."""
    parts = []
    for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
        data = np.frombuffer(text[at : at + PIECE + LENGTH - 1], np.uint8).astype(U64) + U64(1)
        up, down = powers()
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(data * down[: len(data)], dtype=U64)])
        grams = mixed((sums[GRAM:] - sums[:-GRAM]) * up[: len(data) - GRAM + 1])
        # The place in the low bits makes the leftmost one least among equal hashes.
        least = sliding_least(grams & ~U64(0xFFFFFF) | np.arange(len(grams), dtype=U64), STARTS)
        anchor = (least & U64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        last = np.append(first[1:], len(anchor)) - 1
        under = mixed((sums[last + LENGTH] - sums[first]) * up[first] + U64(1))
        parts.append((grams[anchor[first]], under, anchor[first] + at, first + at, last + at))
    if not parts:
        return tuple(np.empty(0, kind) for kind in (U64, U64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))


def text_key(text: bytes) -> tuple[int, int]:
    """128 bits that stand for a text, as two longs."""
    digest = hashlib.blake2b(text, digest_size=16).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def counted_runs(rows: DataFrame) -> DataFrame:
    """(t1, t2, anchor, under, n): for each row's text the distinct runs and how often the row has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = [], []
            for text in texts(batch):
                keys.append(text_key(text))
                found.append(runs(text)[:2])
            sizes = [len(x[0]) for x in found]
            doc = np.repeat(np.arange(len(keys)), sizes)
            anchor, under = (np.concatenate([x[i] for x in found]) if found else np.empty(0, U64) for i in (0, 1))
            ranked = np.lexsort((under, anchor, doc))
            doc, anchor, under = doc[ranked], anchor[ranked], under[ranked]
            new = np.append(True, (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (under[1:] != under[:-1]))[: len(doc)]
            first = np.flatnonzero(new)
            key = np.array(keys, np.int64).reshape(-1, 2)[doc[first]]
            yield pa.RecordBatch.from_pydict({
                "t1": pa.array(key[:, 0]), "t2": pa.array(key[:, 1]), "anchor": pa.array(anchor[first].view(np.int64)),
                "under": pa.array(under[first].view(np.int64)), "n": pa.array(np.diff(np.append(first, len(doc))).astype(np.int32)),
            })

    return rows.mapInArrow(run, "t1 bigint, t2 bigint, anchor bigint, under bigint, n int")


def suspects(rows: DataFrame) -> DataFrame:
    """(t1, t2, runs): for each distinct text its runs that occur again, at least by their anchor.

    state 0: all of the run's text occurs again.  1: the run is the only one with its text.  2: as 0, and this
    text is the one to stand for all copies of the run.  common: the anchor has too many surroundings to gather.
    """
    every = counted_runs(rows)
    anchors = settle(
        every.groupBy("anchor").agg(F.sum("n").alias("all"), F.min("under").alias("low"), F.max("under").alias("high"))
        .where(F.col("all") > 1).select("anchor", (F.col("low") == F.col("high")).alias("same")),
        "anchors",
    )
    met = settle(every.join(anchors, "anchor"), "met")
    several = met.where(~F.col("same"))
    variants = settle(
        several.groupBy("anchor", "under").agg(F.sum("n").alias("copies"), F.min(F.struct("t1", "t2")).alias("first")), "variants"
    )
    sizes = settle(variants.groupBy("anchor").agg((F.count("*") > GATHERED).alias("common")), "sizes")
    known = settle(variants.join(sizes, "anchor"), "known")
    judged = several.select("t1", "t2", "anchor", "under").join(known, ["anchor", "under"]).select(
        "t1", "t2", "anchor", "under",
        F.when(F.col("copies") == 1, 1).when(F.struct("t1", "t2") == F.col("first"), 2).otherwise(0).alias("state"),
        "common",
    )
    plain = met.where("same").select("t1", "t2", "anchor", "under", F.lit(0).alias("state"), F.lit(False).alias("common"))
    listed = judged.union(plain).groupBy("t1", "t2").agg(F.collect_set(F.struct("anchor", "under", "state", "common")).alias("runs"))
    return settle(listed, "suspects")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(t1, t2, packed): each distinct text once, compressed; copies meet before the shuffle where they can."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            raw = texts(batch)
            keys = [text_key(x) for x in raw]
            yield pa.RecordBatch.from_pydict({
                "t1": pa.array([x[0] for x in keys], pa.int64()), "t2": pa.array([x[1] for x in keys], pa.int64()),
                "packed": pa.array([pack(x) for x in raw], pa.binary()),
            })

    return rows.mapInArrow(run, "t1 bigint, t2 bigint, packed binary").groupBy("t1", "t2").agg(F.first("packed").alias("packed"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint, maximal [start, end) out of any."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def without(text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans, kept_sha256 once the disjoint spans are cut out."""
    digest, done = hashlib.sha256(), 0
    for start, end in spans.tolist():
        digest.update(text[done:start])
        done = end
    digest.update(text[done:])
    return len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), digest.hexdigest()


RESULT = {"t1": pa.int64(), "t2": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
RESULT_SCHEMA = "t1 bigint, t2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
OPEN = pa.list_(pa.struct([("anchor", pa.int64()), ("place", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("copies", pa.int32()), ("common", pa.bool_())]))


def opened(rows: DataFrame) -> DataFrame:
    """Each distinct text's result, or, where runs are still open, the text with its spans so far and these runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(x).to_pylist() for x in ("t1", "t2", "packed", "runs"))
            for t1, t2, packed, listed in zip(*columns):
                text, spans, left = unpack(packed), np.empty((0, 2), np.int64), []
                if listed:
                    states = {(x["anchor"], x["under"]): (x["state"], x["common"]) for x in listed}
                    anchor, under, place, first, last = runs(text)
                    pairs = zip(anchor.view(np.int64).tolist(), under.view(np.int64).tolist())
                    sure = []
                    for i, pair in enumerate(pairs):
                        state, common = states.get(pair, (None, False))
                        if state in (0, 2):
                            sure.append(i)
                        if state == 2:
                            states[pair] = (0, common)  # one of them stands for all
                        if state in (1, 2):
                            left.append({"anchor": pair[0], "place": int(place[i]), "first": int(first[i]), "last": int(last[i]), "copies": state, "common": common})
                    spans = merged(np.stack([first[sure], last[sure] + LENGTH], axis=1))
                wait = any(x["copies"] == 1 for x in left)
                result = (None,) * 4 if wait else without(text, spans)
                out.append((t1, t2, *result, packed if left else None, spans.ravel().tolist() if wait else None, left))
            kinds = {**RESULT, "packed": pa.binary(), "spans": pa.list_(pa.int64()), "open": OPEN}
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(kinds.items())})

    return rows.mapInArrow(
        run,
        RESULT_SCHEMA + ", packed binary, spans array<bigint>, "
        "open array<struct<anchor:bigint,place:bigint,first:bigint,last:bigint,copies:int,common:boolean>>",
    )


MEMBER = {
    "anchor": pa.int64(), "t1": pa.int64(), "t2": pa.int64(), "place": pa.int64(), "near": pa.int32(), "far": pa.int32(),
    "copies": pa.int32(), "piece": pa.binary(),
}
MEMBER_SCHEMA = "anchor bigint, t1 bigint, t2 bigint, place bigint, near int, far int, copies int, piece binary"


def members(open_texts: DataFrame, common: bool) -> DataFrame:
    """One row per open run: its strings start ``near`` to ``far`` bytes before the anchor's place; their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: list[tuple] = []
            for t1, t2, packed, left in zip(*(batch.column(x).to_pylist() for x in ("t1", "t2", "packed", "open"))):
                chosen = [x for x in left if x["common"] == common]
                text = unpack(packed) if chosen else b""
                for x in chosen:
                    piece = text[x["first"] : x["last"] + LENGTH]
                    out.append((x["anchor"], t1, t2, x["place"], x["place"] - x["last"], x["place"] - x["first"], x["copies"], piece))
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(MEMBER.items())})

    return open_texts.select("t1", "t2", "packed", "open").mapInArrow(run, MEMBER_SCHEMA)


def shared_strings(group: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """(t1, t2, first start, last start) that another run of the group has too, as maximal ranges.

    A group is (t1, t2, place, near, far, copies, piece) of one anchor.  The string that starts d bytes before
    the anchor is shared by two runs if they agree in d bytes to the left and 200 - d to the right.
    """
    pieces = [x[6] for x in group]
    right, right_common = order([p[x[4] :] for x, p in zip(group, pieces)])
    left, left_common = order([p[: x[4]][::-1] for x, p in zip(group, pieces)])

    def agreement(places: list[int], common: list[int]) -> np.ndarray:
        """Member by member the common prefix: the least one between their places in the order."""
        n = len(places)
        table = np.zeros((n, n), np.int64)
        steps = np.array([*common, 0], np.int64)
        for i in range(n - 1):
            table[i, i + 1 :] = np.minimum.accumulate(steps[i : n - 1])
        table += table.T
        back = np.argsort(places)
        return table[np.ix_(back, back)]

    to_right, to_left = agreement(right, right_common), agreement(left, left_common)
    near = np.array([x[3] for x in group])
    far = np.array([x[4] for x in group])
    for i, (t1, t2, place, _, _, copies, _) in enumerate(group):
        if copies > 1:
            continue
        low = np.maximum(np.maximum(near, near[i]), LENGTH - to_right[i])
        high = np.minimum(np.minimum(far, far[i]), to_left[i])
        both = low <= high
        both[i] = False
        edges = np.zeros(STARTS + 1, np.int64)
        np.add.at(edges, low[both], 1)
        np.add.at(edges, high[both] + 1, -1)
        covered = np.concatenate([[False], np.cumsum(edges) > 0, [False]])
        turns = np.flatnonzero(covered[1:] != covered[:-1])
        for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
            yield t1, t2, place - b + 1, place - a


FOUND_SCHEMA = "t1 bigint, t2 bigint, first bigint, last bigint"


def found_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in found], pa.int64()) for i, k in enumerate(("t1", "t2", "first", "last"))})


def by_sorting(gathered: DataFrame) -> DataFrame:
    """(t1, t2, first, last): repeated starts in the open runs of anchors with at most ``GATHERED`` runs."""
    dealt = gathered.repartition("anchor").sortWithinPartitions("anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, group = None, []
        for batch in batches:
            found: list[tuple[int, int, int, int]] = []
            for row in zip(*(batch.column(x).to_pylist() for x in MEMBER)):
                if row[0] != anchor:
                    found += shared_strings(group)
                    anchor, group = row[0], []
                group.append(row[1:])
            yield found_batch(found)
        yield found_batch(list(shared_strings(group)))

    return dealt.mapInArrow(run, FOUND_SCHEMA)


def digest64(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=8).digest(), "big", signed=True)


def by_bands(runs_left: DataFrame) -> DataFrame:
    """The same for anchors of any number of runs, without gathering them.

    All strings of a band contain its core.  A core that occurs once ends the band; a band whose whole text occurs
    again is repeated throughout, and one stands for all of its text; single ones are cut into smaller bands.
    """
    found = None
    left = runs_left
    for width in BANDS:

        def cut(batches: Iterator[pa.RecordBatch], width: int = width) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for anchor, t1, t2, place, near, far, copies, piece in zip(*(batch.column(x).to_pylist() for x in MEMBER)):
                    for band in range(near // width, far // width + 1):
                        a, b = max(near, band * width), min(far, (band + 1) * width - 1)
                        own = piece[far - b : far - a + LENGTH]
                        core = piece[far - band * width : far - band * width - width + 1 + LENGTH]
                        name = anchor.to_bytes(8, "big", signed=True) + band.to_bytes(2, "big")
                        out.append((anchor, t1, t2, place, a, b, copies, own, digest64(name, b"c", core), digest64(b"s", core, name), digest64(b"o", a.to_bytes(2, "big"), own)))
                kinds = {**MEMBER, "core": pa.int64(), "check": pa.int64(), "own": pa.int64()}
                yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(kinds.items())})

        bands = settle(left.mapInArrow(cut, MEMBER_SCHEMA + ", core bigint, check bigint, own bigint"), "cut")
        texts_of = settle(
            bands.groupBy("core", "check", "own").agg(
                F.sum("copies").alias("times"), F.min(F.struct("t1", "t2", "place")).alias("stands")
            ),
            "band-texts",
        )
        cores = settle(
            texts_of.groupBy("core", "check").agg(F.sum("times").alias("all"), (F.count("*") > 1).alias("several"))
            .where(F.col("all") > 1).drop("all"),
            "cores",
        )
        met = settle(bands.join(texts_of.join(cores, ["core", "check"]), ["core", "check", "own"]), "bands")
        sure = met.where((F.col("times") > 1) & (F.col("copies") == 1)).select(
            "t1", "t2", (F.col("place") - F.col("far")).alias("first"), (F.col("place") - F.col("near")).alias("last")
        )
        found = sure if found is None else found.union(sure)
        # On go the only ones of their text, and one for each text that occurs again.
        one = (F.col("times") == 1) | (F.struct("t1", "t2", "place") == F.col("stands"))
        left = met.where(F.col("several") & one).withColumn("copies", F.least("times", F.lit(2)).cast("int")).select(*MEMBER)
    return found


def finished(rows: DataFrame) -> DataFrame:
    """Results of the texts that waited for open runs; ``more`` are their repeated starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for t1, t2, packed, spans, more in zip(*(batch.column(x).to_pylist() for x in ("t1", "t2", "packed", "spans", "more"))):
                every = np.array(spans, np.int64).reshape(-1, 2)
                if more:
                    starts = np.array([(x["first"], x["last"] + LENGTH) for x in more], np.int64)
                    every = np.concatenate([every, starts])
                out.append((t1, t2, *without(unpack(packed), merged(every))))
            yield pa.RecordBatch.from_pydict({k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate(RESULT.items())})

    return rows.mapInArrow(run, RESULT_SCHEMA)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes; matches never cross documents; a text's own repeats and overlapping ones count; all is
    judged on the input.  Null text counts as empty; texts under 200 bytes lose nothing; equal texts of at least
    200 bytes lose everything; null and repeated ids are kept row by row; an empty table gives no rows; other
    columns are not read.  Equality of copied runs rests on 128-bit digests.
    """
    prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [text_key(x) for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in keys], pa.int64()), pa.array([x[1] for x in keys], pa.int64())],
                names=["doc_id", "t1", "t2"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    ids = settle(rows.mapInArrow(key, f"doc_id {kind}, t1 bigint, t2 bigint"), "ids")
    listed = suspects(rows.select("text"))
    together = distinct_texts(rows.select("text")).join(listed, ["t1", "t2"], "left")
    state = settle(opened(together.select("t1", "t2", "packed", "runs")), "opened")
    with_open = state.where(F.size("open") > 0)
    starts = by_sorting(members(with_open, False)).union(by_bands(members(with_open, True)))
    more = starts.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "last")).alias("more"))
    waiting = state.where(F.col("n_bytes").isNull()).select("t1", "t2", "packed", "spans").join(more, ["t1", "t2"], "left")
    done = state.where(F.col("n_bytes").isNotNull()).select(*RESULT)
    results = settle(done.union(finished(waiting.select("t1", "t2", "packed", "spans", "more"))), "results")
    return ids.join(results, ["t1", "t2"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
