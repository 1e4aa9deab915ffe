"""Vector code compression: product quantisation whose codebooks are refined by dual-tree Lloyd.

A vector of integers is cut into equal parts; every part position has a codebook of entries.  A block of vectors
becomes one balanced tree per part position, its nodes with bounding boxes and cached sums; so do the
codebook's entries.  Both trees are descended together: a pair of nodes is dropped when its least distance is
above the greatest distance to another pair's entries.  A node with one entry left is assigned whole, by its
cached sum; leaves that stay uncertain compare integers.  Tasks hand on sums per entry, never vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.llm.common import prepared, worker_state
from ecometrics.session import settle

BLOCK_ROWS, LEAF_ROWS = 8192, 32
LIMB_BITS = 40  # sums travel as such pieces, which longs and decimals add up without overflow


class Tree:
    """A balanced tree for each part position over (parts, rows, width) integers, all of them level by level at once.

    Node j of part i at level l has number i * 2^l + j and the rows from j * size on, in the order of ``rows``.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        parts, n, width = points.shape
        self.depth = max(0, math.ceil(math.log2(n / leaf)))
        size = -(-n // 2**self.depth)
        rows = np.broadcast_to(np.minimum(np.arange(size << self.depth), n - 1), (parts, size << self.depth))
        weight = np.broadcast_to(np.arange(size << self.depth) < n, rows.shape)
        points = points[:, rows[0]]
        for level in range(self.depth):
            shape = (parts << level, -1)
            cells = points.reshape(*shape, width)
            widest = np.argmax(cells.max(axis=1) - cells.min(axis=1), axis=1)
            keys = np.take_along_axis(cells, widest[:, None, None], axis=2)[:, :, 0]
            order = np.argpartition(keys, keys.shape[1] // 2, axis=1)
            points = np.take_along_axis(cells, order[:, :, None], axis=1).reshape(points.shape)
            rows = np.take_along_axis(rows.reshape(shape), order, axis=1).reshape(rows.shape)
            weight = np.take_along_axis(weight.reshape(shape), order, axis=1).reshape(rows.shape)
        self.points, self.rows, self.weight, self.size = points, rows, weight, size
        leaves = points.reshape(parts << self.depth, size, width)
        counted = weight.reshape(leaves.shape[:2])
        self.low, self.high = [leaves.min(axis=1)], [leaves.max(axis=1)]
        self.sums, self.counts = [(leaves * counted[:, :, None]).sum(axis=1)], [counted.sum(axis=1)]
        for _ in range(self.depth):  # parents from pairs of children
            self.low.insert(0, self.low[0].reshape(-1, 2, width).min(axis=1))
            self.high.insert(0, self.high[0].reshape(-1, 2, width).max(axis=1))
            self.sums.insert(0, self.sums[0].reshape(-1, 2, width).sum(axis=1))
            self.counts.insert(0, self.counts[0].reshape(-1, 2).sum(axis=1))


def bounds(a: Tree, level: int, nodes: np.ndarray, b: Tree, below: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between the boxes of node pairs."""
    low, high, low_b, high_b = a.low[level][nodes], a.high[level][nodes], b.low[below][others], b.high[below][others]
    apart = np.maximum(np.maximum(low - high_b, low_b - high), 0)
    reach = np.maximum(high - low_b, high_b - low)
    return (apart * apart).sum(axis=1), (reach * reach).sum(axis=1)


def assign(tree: Tree, books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entry of every row of ``tree``, in its order; adds up ``sums`` and ``counts`` per part and entry.

    Distances are squared Euclidean, ties go to the lower entry: only what is strictly farther is dropped.
    """
    parts, entries, width = books.shape
    other = Tree(books, 1)
    labels = np.zeros(tree.rows.shape, np.uint8)
    nodes = pairs = np.arange(parts)
    level = below = 0
    while True:
        # Pairs come sorted by node; the best greatest distance of a node bounds what its rows need.
        least, greatest = bounds(tree, level, nodes, other, below, pairs)
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        best = np.repeat(np.minimum.reduceat(greatest, first), np.diff(np.append(first, len(nodes))))
        nodes, pairs = nodes[least <= best], pairs[least <= best]
        if below == other.depth:
            first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
            alone = np.diff(np.append(first, len(nodes))) == 1
            whole, part = nodes[first[alone]], nodes[first[alone]] >> level
            entry = other.rows.reshape(-1)[pairs[first[alone]]]
            labels.reshape(parts << level, -1)[whole] = entry[:, None]
            np.add.at(sums, (part, entry), tree.sums[level][whole])
            np.add.at(counts, (part, entry), tree.counts[level][whole])
            left = ~np.repeat(alone, np.diff(np.append(first, len(nodes))))
            nodes, pairs = nodes[left], pairs[left]
        if not nodes.size or (level == tree.depth and below == other.depth):
            break
        both = [(nodes, pairs)]
        if below < other.depth:
            both = [(a, 2 * b + i) for a, b in both for i in (0, 1)]
            below += 1
        if level < tree.depth:
            both = [(2 * a + i, b) for a, b in both for i in (0, 1)]
            level += 1
        nodes, pairs = (np.concatenate(x) for x in zip(*both))
        order = np.argsort(nodes, kind="stable")
        nodes, pairs = nodes[order], pairs[order]
    if nodes.size:  # uncertain leaves, those of as many candidates together
        entry = other.rows.reshape(-1)[pairs]
        order = np.lexsort((entry, nodes))
        nodes, entry = nodes[order], entry[order]
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
        many = np.diff(np.append(first, len(nodes)))
        leaves = tree.points.reshape(parts << tree.depth, tree.size, width)
        weight = tree.weight.reshape(leaves.shape[:2])
        for n in np.unique(many):
            for at in np.array_split(first[many == n], max(1, int((many == n).sum()) * n * tree.size * width // 2**22)):
                leaf, part = nodes[at], nodes[at] >> tree.depth
                candidates = entry[at[:, None] + np.arange(n)]
                apart = leaves[leaf][:, None] - books[part[:, None], candidates][:, :, None]
                nearest = np.argmin((apart * apart).sum(axis=3), axis=1)
                found = np.take_along_axis(candidates, nearest, axis=1)
                labels.reshape(leaves.shape[:2])[leaf] = found
                real = weight[leaf]
                of = np.broadcast_to(part[:, None], found.shape)[real], found[real]
                np.add.at(sums, of, leaves[leaf][real])
                np.add.at(counts, of, 1)
    return labels


def code_block(points: np.ndarray, books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts) entries and (rows,) errors of (rows, parts, width) integers."""
    tree = Tree(np.ascontiguousarray(points.transpose(1, 0, 2)), LEAF_ROWS)
    labels = assign(tree, books, sums, counts)
    apart = tree.points - np.take_along_axis(books, labels[:, :, None].astype(np.int64), axis=1)
    errors, codes = np.zeros(len(points), np.int64), np.zeros(points.shape[:2], np.uint8)
    squares = (apart * apart).sum(axis=2)
    for part in range(points.shape[1]):
        rows = tree.rows[part]
        codes[rows, part] = labels[part]
        once = np.zeros(len(points), np.int64)
        once[rows] = squares[part]  # padding repeats a row, with the same value
        errors += once
    return codes, errors


def code_exactly(vector: list[int], books: list, sums: dict, counts: np.ndarray) -> tuple[list[int], int]:
    """The same for one vector whose distances may not fit in 64 bits, in Python's integers."""
    width, code, error = len(books[0][0]), [], 0
    for part, book in enumerate(books):
        x = vector[part * width : (part + 1) * width]
        distances = [sum((a - b) ** 2 for a, b in zip(x, entry)) for entry in book]
        code.append(distances.index(min(distances)))
        error += min(distances)
        counts[part, code[-1]] += 1
        for i, a in enumerate(x):
            place = (part, code[-1], i)
            sums[place] = sums.get(place, 0) + a
    return code, error


def integers(values: np.ndarray) -> list[int]:
    """floor(256 x) of any finite numbers."""
    return [math.floor(math.ldexp(x, 8)) if abs(x) < 2.0**1000 else int(x) * 256 for x in values.tolist()]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


class Coding:
    """A pass over the kept vectors with given codebooks (lists of lists of lists of ints)."""

    def __init__(self, books: list):
        self.books, self.parts, self.entries, self.width = books, len(books), len(books[0]), len(books[0][0])
        self.limit = math.isqrt((1 << 61) // self.width) // 2  # distances within stay in 64 bits
        self.small = all(abs(x) <= self.limit for book in books for entry in book for x in entry)

    def __call__(self, table: pa.Table, sums: np.ndarray, counts: np.ndarray, large: dict) -> tuple[list[str], list[int | None]]:
        """Codes and errors of a block; an error beyond a long is None."""
        values = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        values = values.reshape(table.num_rows, self.parts * self.width)
        fits = (np.abs(values).max(axis=1) < self.limit / 256 - 1) & self.small
        codes, errors = np.zeros((table.num_rows, self.parts), np.uint8), [0] * table.num_rows
        near = np.flatnonzero(fits)
        if near.size:
            points = np.floor(256 * values[near]).astype(np.int64).reshape(len(near), self.parts, self.width)
            codes[near], found = code_block(points, np.array(self.books, np.int64), sums, counts)
            for i, error in zip(near.tolist(), found.tolist()):
                errors[i] = error
        for i in np.flatnonzero(~fits).tolist():
            codes[i], error = code_exactly(integers(values[i]), self.books, large, counts)
            errors[i] = error if error < 2**63 else None
        return [x.tobytes().hex() for x in codes], errors


def refined(kept: DataFrame, books: list) -> list:
    """One round of Lloyd: every entry becomes the floor of its parts' mean; an unused one stays.

    What reaches the driver is one sum per component of the codebooks, whatever the number of vectors.
    """
    coding = Coding(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("vector_codes")
        shape = (coding.parts, coding.entries, coding.width)
        sums, counts, large = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64), {}
        for table in blocks(batches):
            coding(table, sums, counts, large)
        cells = []
        for part, entry in np.argwhere(counts).tolist():
            cells.append((part, entry, -1, 0, int(counts[part, entry])))
            for i in range(coding.width):
                total = int(sums[part, entry, i]) + large.get((part, entry, i), 0)
                sign, total, limb = (-1 if total < 0 else 1), abs(total), 0
                while total:
                    cells.append((part, entry, i, limb, sign * (total & ((1 << LIMB_BITS) - 1))))
                    total, limb = total >> LIMB_BITS, limb + 1
        columns = list(zip(*cells)) if cells else [[]] * 5
        names = ("part", "entry", "place", "limb", "total")
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k != "total" else pa.int64()) for k, v in zip(names, columns)})

    cells = kept.mapInArrow(run, "part int, entry int, place int, limb int, total bigint")
    added = cells.groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    totals: dict[tuple[int, int, int], int] = {}
    for row in added:
        place = (row["part"], row["entry"], row["place"])
        totals[place] = totals.get(place, 0) + (int(row["total"]) << (LIMB_BITS * row["limb"]))
    return [
        [
            [totals.get((i, j, k), 0) // totals[i, j, -1] for k in range(len(entry))] if (i, j, -1) in totals else entry
            for j, entry in enumerate(book)
        ]
        for i, book in enumerate(books)
    ]


def codebooks_digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> tuple[DataFrame, int]:
    """(vec_id, label, vector) of whole, finite vectors of the commonest length that can be cut, and that length or 0."""
    finite = F.forall(vectors[vector_col], lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].alias("vector")).where(
        vectors[vector_col].isNotNull() & finite
    )
    length = F.size("vector")
    common = rows.where((length > 0) & (length % parts == 0)).groupBy(length.alias("length")).agg(F.count("*").alias("n"))
    first = common.orderBy(F.desc("n"), "length").first()
    return rows.where(length == (first["length"] if first else 0)), first["length"] if first else 0


def compress(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> DataFrame:
    """Per kept row: vec_id, code, error, label_error, codebooks_sha256.

    Rows go if their vector is null, holds a component that is null, NaN or infinite, or has another length than
    the commonest one that ``parts`` divides (ties: the shorter).  The codebooks start from the ``entries`` (at most
    256) kept rows of smallest id, null ids last, ties by vector; fewer rows make fewer entries.  Repeated rows are
    coded alike and all kept; null labels are one label; an error beyond a long is null, and so is its label's; an empty
    table gives no rows; other columns are not read.
    """
    prepared(vectors.sparkSession)
    kept, length = kept_vectors(vectors, id_col, vector_col, label_col, parts)
    kind = kept.schema
    coded_schema = T.StructType([*kind.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not length:
        empty = vectors.sparkSession.createDataFrame([], coded_schema)
        return empty.select("vec_id", "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    first = [integers(np.array(row["vector"], np.float64)) for row in start]
    width = length // parts
    books = [[x[i * width : (i + 1) * width] for x in first] for i in range(parts)]
    for _ in range(rounds):
        books = refined(kept.select("vector"), books)
    coding = Coding(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("vector_codes")
        sums = np.zeros((coding.parts, coding.entries, coding.width), np.int64)
        for table in blocks(batches):
            codes, errors = coding(table, sums, np.zeros(sums.shape[:2], np.int64), {})
            yield pa.RecordBatch.from_pydict({
                "vec_id": table.column("vec_id").combine_chunks(), "label": table.column("label").combine_chunks(),
                "code": pa.array(codes, pa.string()), "error": pa.array(errors, pa.int64()),
            })

    coded = settle(kept.mapInArrow(run, coded_schema), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    by_label = settle(
        coded.groupBy(F.col("label").alias("__label")).agg(F.when(F.count("*") == F.count("error"), total).alias("label_error")), "label-errors"
    )
    met = coded.join(by_label, coded.label.eqNullSafe(by_label["__label"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    """Assign with codebook i, and refine it."""
    return f"""
    d{i} AS (SELECT r, part, entry, CAST(sum((v - c) * (v - c)) AS HUGEINT) AS d FROM x JOIN b{i} USING (part, pos) GROUP BY ALL),
    a{i} AS (SELECT r, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d FROM d{i} GROUP BY ALL),
    m{i} AS (SELECT part, entry, pos, CAST(sum(v) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM x JOIN a{i} USING (r, part) GROUP BY ALL),
    b{i + 1} AS (SELECT part, entry, pos, CAST(CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS c
           FROM b{i} LEFT JOIN m{i} USING (part, entry, pos)),"""


#: Two rounds over components in rows; distances and sums are whole numbers, so that every engine agrees.
SQL = f"""
    WITH good AS (SELECT vec_id, label, embedding AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    width AS (SELECT len(e) AS w FROM good WHERE len(e) > 0 AND len(e) % 16 = 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS r, vec_id, label, e, w // 16 AS p FROM good, width WHERE len(e) = w),
    cells AS (SELECT r, p, unnest(range(CAST(16 * p AS BIGINT))) AS i, unnest(e) AS value FROM kept),
    x AS (SELECT r, i // p AS part, i % p AS pos, CAST(floor(256 * CAST(value AS DOUBLE)) AS BIGINT) AS v FROM cells),
    b0 AS (SELECT part, r - 1 AS entry, pos, v AS c FROM x WHERE r <= 64),
    {_round_sql(0)}{_round_sql(1)}
    d AS (SELECT r, part, entry, CAST(sum((v - c) * (v - c)) AS HUGEINT) AS d FROM x JOIN b2 USING (part, pos) GROUP BY ALL),
    a AS (SELECT r, part, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d FROM d GROUP BY ALL),
    coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a GROUP BY r),
    books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), books"""
