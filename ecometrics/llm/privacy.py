"""Personal data: fixed patterns, and terms that give protected entities away.

Every distinct email, address, card or phone number is a protected entity.  Over the whole corpus, the
words beside its mentions are counted by distinct surroundings, so copies of one passage count once.
A term discloses an entity if most documents that have the term are such surroundings and if their
pointwise mutual information is high: who reads the term can name the entity.  Disclosing terms are
found in every document, whether the entity stands beside them or not, and are generalised with it.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecometrics.llm.common import prepared, texts, worker_state
from ecometrics.session import settle

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Digits are taken whole: a start inside a run of digits can't match where the run's own start did not.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]{}"
SHORTEST = 4  # letters of a term; words with digits, hyphens or fewer letters are never terms


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the longest local part before each sign that no earlier match has taken."""
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and LOCAL.match(text, start - 1, start):
                start -= 1
            domain = DOMAIN.match(text, at + 1) if start < at else None
            if domain:
                end = domain.end()
                yield start, end
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = [int(x) * 2 for x in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(x - 9 if x > 9 else x for x in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then places; matches that fail their check are dropped."""
    spans = [(0, a, b) for a, b in emails(text)]
    spans += [
        (1, m.start(), m.end()) for m in ADDRESS.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))
    ]
    for match in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", match.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, match.start(), match.end()))
    for match in PHONE.finditer(text):
        if 8 <= sum(x.isdigit() for x in match.group()) <= 15:
            spans.append((3, match.start(), match.end()))
    return spans


class Taken:
    """The places of base spans, asked for overlaps in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        placed = sorted((a, b) for k, a, b in spans if k < 4)
        self.starts = [a for a, _ in placed]
        self.reach = list(accumulate((b for _, b in placed), max))  # greatest end so far

    def meets(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.reach[before - 1] > start


def entity(kind: int, found: str) -> str:
    """What names the same entity however it is written."""
    return f"{KINDS[kind]}:" + (found.lower() if kind < 2 else re.sub("[^0-9]", "", found))


def term(word: str) -> str | None:
    """A word without punctuation at its ends, if it is made of letters and not too short to tell anything."""
    word = word.strip(EDGES).lower()
    return word if len(word) >= SHORTEST and word.isalpha() else None


def surroundings(text: str, spans: list[tuple[int, int, int]], reach: int) -> Iterator[tuple[str, str, int]]:
    """(entity, term, digest of the surroundings) for the terms up to ``reach`` words from a mention."""
    words = [(m.start(), m.end(), m.group()) for m in WORDS.finditer(text)]
    starts = [a for a, _, _ in words]
    for kind, a, b in spans:
        first, last = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
        around = words[max(0, first - reach) : first] + words[last + 1 : last + 1 + reach]
        digest = int.from_bytes(hashlib.blake2b(" ".join(w for _, _, w in around).encode(), digest_size=8).digest(), "big", signed=True)
        name = entity(kind, text[a:b])
        for found in {term(w) for _, _, w in around} - {None}:
            yield name, found, digest


def disclosing_terms(
    rows: DataFrame, *, reach: int, support: int, share: float, bits: float, flush: int = 250_000
) -> DataFrame:
    """(term): those that disclose some entity; counts are taken over all distinct texts.

    ``support``: distinct surroundings of the entity that have the term; ``share``: of the distinct texts with the
    term, the least part that these surroundings make up; ``bits``: least pointwise mutual information.
    """

    def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("privacy")
        for batch in batches:
            out: set[tuple[str, str, int]] = set()
            for text in texts(batch):
                text = text.decode()
                spans = base_spans(text)
                if spans:
                    out.update(surroundings(text, spans, reach))
            found = sorted(out)
            yield pa.RecordBatch.from_pydict({
                "entity": pa.array([x[0] for x in found], pa.string()), "term": pa.array([x[1] for x in found], pa.string()),
                "place": pa.array([x[2] for x in found], pa.int64()),
            })

    def term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digest of the text, its terms packed), a quarter of the text's size; the digests are of 128 bits."""
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out: dict[bytes, bytes] = {}
            for text in texts(batch):
                digest = hashlib.blake2b(text, digest_size=16).digest()
                if digest not in out:
                    stripped = {w.strip(EDGES) for w in set(text.decode().lower().split())}
                    out[digest] = pack(" ".join(w for w in stripped if len(w) >= SHORTEST and w.isalpha()).encode())
            yield pa.RecordBatch.from_pydict({"digest": pa.array(list(out), pa.binary()), "terms": pa.array(list(out.values()), pa.binary())})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial document frequencies of all terms and, as the null term, the number of documents."""
        unpack, counts, documents = zstandard.ZstdDecompressor().decompress, Counter(), 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})
            counts.clear()
            return batch

        for batch in batches:
            documents += batch.num_rows
            for packed in batch.column(0).to_pylist():
                counts.update(unpack(packed).decode().split())
                if len(counts) > flush:
                    yield out()
        yield out()
        yield pa.RecordBatch.from_pydict({"term": pa.array([None], pa.string()), "n": pa.array([documents], pa.int64())})

    beside = settle(rows.mapInArrow(mentions, "entity string, term string, place bigint").distinct(), "mentions")
    pairs = settle(beside.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= support), "pairs")
    of_entity = beside.select("entity", "place").distinct().groupBy("entity").agg(F.count("*").alias("entity_n"))
    # Copies of a text have the same surroundings, so they count once here too.
    once = rows.mapInArrow(term_sets, "digest binary, terms binary").dropDuplicates(["digest"]).select("terms")
    seen = settle(once.mapInArrow(frequencies, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("term_n")), "terms")
    documents = seen.where(F.col("term").isNull()).agg(F.coalesce(F.sum("term_n"), F.lit(0)).alias("n")).first()["n"]
    information = F.log2(F.col("both") * F.lit(float(documents)) / (F.col("term_n") * F.col("entity_n")))
    return (
        pairs.join(seen, "term").join(of_entity, "entity")
        .where((F.col("both") >= share * F.col("term_n")) & (information >= bits))
        .select("term").distinct()
    )


def digest_of(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def located(
    docs: DataFrame, text_col: str, *, reach: int, support: int, share: float, bits: float, block: int
) -> DataFrame:
    """``docs`` with __pii_spans: (kind, start, end) of base matches and disclosing terms, code points, end exclusive.

    Disclosing terms are broadcast in blocks of at most ``block``; each block is one more step over the same rows.
    """
    rows = docs.select(docs[text_col].alias("text"))
    terms = settle(disclosing_terms(rows, reach=reach, support=support, share=share, bits=bits), "disclosing")
    blocks = max(1, math.ceil(terms.count() / block))
    held = [
        docs.sparkSession.sparkContext.broadcast({
            row["term"] for row in terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i).toLocalIterator()
        })
        for i in range(blocks)
    ]
    kind = T.ArrayType(T.StructType([T.StructField(x, T.IntegerType()) for x in ("kind", "start", "end")]))
    arrow = pa.list_(pa.struct([(x, pa.int32()) for x in ("kind", "start", "end")]))

    def step(shared, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                place = batch.schema.get_field_index("__pii_spans")
                earlier = [None] * batch.num_rows if first else batch.column(place).to_pylist()
                out = []
                for text, before in zip(texts(batch, text_col), earlier):
                    text = text.decode()
                    spans = base_spans(text) if first else [(x["kind"], x["start"], x["end"]) for x in before]
                    if known and not known.isdisjoint({w.strip(EDGES) for w in set(text.lower().split())}):
                        taken = Taken(spans)
                        for match in WORDS.finditer(text):
                            if term(match.group()) in known:
                                a = match.start() + len(match.group()) - len(match.group().lstrip(EDGES))
                                b = match.end() - len(match.group()) + len(match.group().rstrip(EDGES))
                                if not taken.meets(a, b):
                                    spans.append((4, a, b))
                    out.append([{"kind": k, "start": a, "end": b} for k, a, b in sorted(spans)])
                columns = [c for i, c in enumerate(batch.columns) if i != place]
                names = [n for i, n in enumerate(batch.schema.names) if i != place]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out, arrow)], names=[*names, "__pii_spans"])

        return run

    schema = T.StructType([*docs.schema.fields, T.StructField("__pii_spans", kind)])
    for i, shared in enumerate(held):
        docs = docs.mapInArrow(step(shared, i == 0), schema)
    return docs


LIMITS = {"reach": 8, "support": 3, "share": 0.6, "bits": 4.0, "block": 500_000}


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans.

    ``spans`` lists kind:start:end by kind, then start; ``base_sha256`` digests the list of the four fixed
    kinds.  Null text counts as empty (no spans); null and repeated ids are kept row by row; an empty table
    gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    spans = F.col("__pii_spans")

    def counted(kind: int):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint")

    def joined(items):
        return F.array_join(
            F.transform(items, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])), ","
        )

    found = located(rows, "text", **{**LIMITS, **limits})
    return found.select(
        "doc_id",
        *[counted(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(joined(F.filter(spans, lambda x: x["kind"] < 4)), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def sanitise(docs: DataFrame, *, text_col: str = "text", size_col: str = "n_chars", **limits) -> DataFrame:
    """All rows and columns; in the text each span is replaced by its kind in brackets, overlapping ones together.

    ``size_col``, if there is one, follows the changed text.  Null texts stay null; repeated rows are changed alike
    and all kept; an empty table gives no rows.
    """
    prepared(docs.sparkSession)
    found = located(docs, text_col, **{**LIMITS, **limits})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, columns = batch.schema.names[:-1], batch.columns[:-1]
            at = names.index(text_col)
            new, sizes = [], columns[names.index(size_col)].to_pylist() if size_col in names else []
            for i, (text, spans) in enumerate(zip(columns[at].to_pylist(), batch.column("__pii_spans").to_pylist())):
                if text is not None and spans:
                    parts, done = [], 0
                    for x in sorted(spans, key=lambda x: (x["start"], x["kind"])):
                        if x["start"] >= done:
                            parts += [text[done : x["start"]], f"[{KINDS[x['kind']].upper()}]"]
                        done = max(done, x["end"])
                    text = "".join([*parts, text[done:]])
                    if sizes:
                        sizes[i] = len(text)
                new.append(text)
            columns[at] = pa.array(new, columns[at].type)
            if sizes:
                columns[names.index(size_col)] = pa.array(sizes, columns[names.index(size_col)].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(run, docs.schema)
