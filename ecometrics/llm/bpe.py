"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

The words that carry most of the corpus are compiled, with their id sequences as output, into an
automaton that shares equal suffixes (built incrementally from sorted words).  Its arrays form one
flat file that Spark ships to every executor, where all workers map it into memory.  A word is an
arc walk; the number of words passed on the way is its place in the table of outputs.  Words that
are not in it are merged exactly, rank by rank.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import struct
import tempfile
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from ecometrics.llm.common import frequent_items, prepared, texts, worker_state
from ecometrics.llm.token_counts import SPACE

CHUNK = re.compile(f"[^{SPACE}]+")
# str.split cuts at these too, which are not white space to the library.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Of these characters every Unicode version says the same: composed already, lower case one by one.
PLAIN = re.compile("[\x00-\x1b\x20-\u012f\u0131-\u017f]*")
SHORT_WORD = 64  # characters up to which a plain loop is the faster way to merge


def chunks_of(text: str) -> list[str]:
    """The runs without white space."""
    return CHUNK.findall(text) if SEPARATORS.search(text) else text.split()


def byte_letters() -> list[str]:
    """The letter that a byte-level vocabulary has for each byte: itself if it can be seen, else one past 255."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {byte: chr(256 + i) for i, byte in enumerate(x for x in range(256) if x not in seen)}
    return [hidden.get(byte, chr(byte)) for byte in range(256)]


class Vocabulary:
    """Splitting and exact merging as a tokenizers file of kind BPE with word ends declares it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        model = declared["model"]
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.ids = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.ranks = {
            tuple(x if isinstance(x, list) else x.split(" ")): rank for rank, x in enumerate(model["merges"])
        }
        self.special = {x["content"]: x["id"] for x in declared["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = {i: letter for i, letter in enumerate(byte_letters())}
        # The file's own pattern, for chunks of plain characters; others go through the library's steps.
        steps = declared["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])

    def is_plain(self, text: str) -> bool:
        """Of plain characters and without special tokens, so that the file's own pattern finds the words."""
        return bool(PLAIN.fullmatch(text)) and not (self.cut and self.cut.search(text))

    def spelled(self, found: str) -> str:
        """A match of the pattern in the model's alphabet."""
        return found if found.isascii() else found.encode().decode("latin-1").translate(self.letters)

    def words(self, chunk: str) -> list[str | int]:
        """The words of a chunk without white space, in the model's alphabet; a special token as its id."""
        if self.is_plain(chunk):
            return [self.spelled(x) for x in self.pattern.findall(chunk.lower())]
        out: list[str | int] = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(word for word, _ in self.split(self.normalise(part)))
        return out

    def merge(self, word: str) -> list[int]:
        """Apply the merge of lowest rank, leftmost first, until none is left."""
        parts = [*word[:-1], word[-1] + self.end]
        parts = self.merge_short(parts) if len(parts) <= SHORT_WORD else self.merge_long(parts)
        return [self.ids[x] for x in parts if x in self.ids]

    def merge_short(self, parts: list[str]) -> list[str]:
        """By looking through all pairs for each merge."""
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
        return parts

    def merge_long(self, parts: list[str]) -> list[str]:
        """The same in n log n steps for n characters.

        Parts are linked to their neighbours and possible merges wait in a heap; an entry whose parts have changed
        since is passed over.
        """
        rank, last = self.ranks.get, len(parts)
        after, before = [*range(1, last), -1], [*range(-1, last - 1)]
        waiting = [(r, i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if (r := rank(pair)) is not None]
        heapify(waiting)
        while waiting:
            _, i, (left, right) = heappop(waiting)
            j = after[i]
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j], after[i] = left + right, "", after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0:
                    pair = (parts[a], parts[after[a]])
                    if (r := rank(pair)) is not None:
                        heappush(waiting, (r, a, pair))
        return [x for x in parts if x]


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The automaton of ``entries`` as one flat block of 32-bit numbers.

    A state is a run of arcs (label, target, words passed before the target); states with equal
    arcs and finality are one state.  The n-th word in byte order has its ids at ``offsets[n]``.
    """
    words = sorted((word.encode(), ids) for word, ids in entries.items())
    registry: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def register(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in registry:
            registry[key] = len(states)
            states.append(key)
        return registry[key]

    path: list[list] = [[False, []]]  # of the last word: finality and the arcs that are settled
    labels = b""
    for word, _ in words:
        same = len(os.path.commonprefix([labels, word]))
        while len(path) > same + 1:
            final, arcs = path.pop()
            path[-1][1].append((labels[len(path) - 1], register(final, arcs)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0], labels = True, word
    while len(path) > 1:
        final, arcs = path.pop()
        path[-1][1].append((labels[len(path) - 1], register(final, arcs)))
    root = register(*path[0])

    below = []  # words that end at or after a state; targets come before their sources
    for final, arcs in states:
        below.append(final + sum(below[target] for _, target in arcs))
    first, finals, label, target, passed = [], [], [], [], []
    for final, arcs in states:
        first.append(len(label))
        finals.append(int(final))
        count = int(final)
        for byte, to in arcs:
            label.append(byte)
            target.append(to)
            passed.append(count)
            count += below[to]
    first.append(len(label))
    offsets, ids = [0], []
    for _, out in words:
        ids += out
        offsets.append(len(ids))
    blocks = [first, finals, label, target, passed, offsets, ids]
    head = [root, *map(len, blocks)]
    return struct.pack(f"<{len(head)}i", *head) + b"".join(struct.pack(f"<{len(x)}i", *x) for x in blocks)


class Lexicon:
    """A mapped automaton; ``lexicon[word]`` gives its ids or None."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            numbers = memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)).cast("i")
        self.root, sizes, at = numbers[0], list(numbers[1:8]), 8
        blocks = []
        for size in sizes:
            blocks.append(numbers[at : at + size])
            at += size
        self.first, self.finals, label, self.target, self.passed, self.offsets, self.ids = blocks
        self.label = bytes(label.tolist())  # one byte an arc, which is searched for in a state's arcs

    def __getitem__(self, word: str) -> list[int] | None:
        state, place = self.root, 0
        first, find, target, passed = self.first, self.label.find, self.target, self.passed
        for byte in word.encode():
            arc = find(byte, first[state], first[state + 1])
            if arc < 0:
                return None
            place += passed[arc]
            state = target[arc]
        if not self.finals[state]:
            return None
        return list(self.ids[self.offsets[place] : self.offsets[place + 1]])


class Recent(dict):
    """A bounded cache in two generations: what the older one still has is taken over when it is asked for."""

    def __init__(self, limit: int, compute):
        super().__init__()
        self.limit, self.compute, self.older = limit // 2, compute, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Coder:
    """A worker's encoder over cached words: of each the number of ids, ids as text, tokens as text.

    Most texts are plain and split at once by the file's pattern; others go chunk by chunk.  The cache is keyed by what
    was split off: a match of the pattern, or for chunks that are not plain the word in the model's alphabet.
    """

    def __init__(self, path: str, lexicon_path: str, cache_items: int):
        self.vocabulary, self.lexicon = Vocabulary(path), Lexicon(lexicon_path)
        self.plain = Recent(cache_items, lambda found: self.code_word(self.vocabulary.spelled(found)))
        self.others = Recent(cache_items // 8, self.code_chunk)

    def code_ids(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), " ".join(map(self.vocabulary.tokens.__getitem__, ids))

    def code_word(self, word: str | int) -> tuple[int, str, str]:
        """Of a word, or of a special token by its id."""
        if isinstance(word, int):
            return self.code_ids([word])
        found = self.lexicon[word]
        return self.code_ids(self.vocabulary.merge(word) if found is None else found)

    def code_chunk(self, chunk: str) -> tuple[int, str, str]:
        return combined([self.code_word(word) for word in self.vocabulary.words(chunk)])

    def code(self, text: str) -> tuple[int, str, str]:
        """The same for a whole text."""
        if self.vocabulary.is_plain(text):
            return combined(list(map(self.plain.__getitem__, self.vocabulary.pattern.findall(text.lower()))))
        parts = []
        for chunk in chunks_of(text):
            if self.vocabulary.is_plain(chunk):
                parts += map(self.plain.__getitem__, self.vocabulary.pattern.findall(chunk.lower()))
            else:
                parts.append(self.others[chunk])
        return combined(parts)


def combined(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    if not parts:
        return 0, "", ""
    sizes, ids, tokens = zip(*parts)
    if 0 in sizes:
        ids, tokens = filter(None, ids), [x[2] for x in parts if x[0]]
    return sum(sizes), " ".join(ids), " ".join(tokens)


def _coder(path: str, name: str, cache_items: int) -> Coder:
    state = worker_state("bpe")
    if state.get("key") != (path, name):
        state.clear()  # before the next caches fill
        state.update(key=(path, name), coder=Coder(path, SparkFiles.get(name), cache_items))
    return state["coder"]


def ship_lexicon(texts_df: DataFrame, tokenizer: str, words: int) -> str:
    """Compile the most frequent words of all texts and hand the file to every executor; its name."""
    spark, vocabulary = texts_df.sparkSession, Vocabulary(tokenizer)
    entries = {}
    for chunk in frequent_items(texts_df, chunks_of, words):
        for word in vocabulary.words(chunk):
            if isinstance(word, str) and word not in entries:
                entries[word] = vocabulary.merge(word)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), name)
    with open(path, "wb") as file:
        file.write(compile_lexicon(entries))
    spark.sparkContext.addFile(path)
    return name


def encode(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 8192,
    cache_items: int = 400_000,
    ids: bool = False,
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the ids and the decoded text.

    Equal to the library's encoding without added special tokens, truncation or padding; the file has no
    decoder, so decoding joins the tokens by blanks, special ones included.  ``words`` bounds the
    automaton and ``cache_items`` a worker's cache; neither changes a result.  Null text counts as empty
    (0 tokens, the digests of the empty string); null and repeated ids are kept row by row; an empty
    table gives no rows; other columns are not read.
    """
    prepared(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    name = ship_lexicon(rows.select("text"), tokenizer, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer, name, cache_items)
        for batch in batches:
            n, id_sha, text_sha, id_lists, decoded_texts = [], [], [], [], []
            for text in texts(batch):
                size, id_text, decoded = coder.code(text.decode())
                n.append(size)
                id_sha.append(hashlib.sha256(id_text.encode()).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if ids:
                    id_lists.append([int(x) for x in id_text.split()])
                    decoded_texts.append(decoded)
            out = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(n, pa.int64()),
                "ids_sha256": pa.array(id_sha, pa.string()),
                "decoded_sha256": pa.array(text_sha, pa.string()),
            }
            if ids:
                out |= {"ids": pa.array(id_lists, pa.list_(pa.int32())), "decoded": pa.array(decoded_texts, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + (", ids array<int>, decoded string" if ids else ""))
