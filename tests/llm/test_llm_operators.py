"""Each operator against brute force, the libraries, or held-out truth; and on untidy tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import connection, differences
from pyspark.sql import functions as F

from ecometrics.llm import (
    bpe, deep_shallow, elias_fano, language, lm, mixing, order_minhash, privacy, quality, repeats, secrets, simhash, spelling,
    token_counts, vector_codes,
)
from ecometrics.llm.common import Summary, components, frequent_items
from ecometrics.llm.queries import QUERIES, SQL, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.fixture(scope="module")
def found(spark):
    """The full result of each query, by document, run once."""
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = {row.doc_id: row for row in QUERIES[name](spark, FOLDER).collect()}
        return kept[name]

    return run


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- untidy tables -------------------------------------------------------------------------------------------------

NAMES = ("text", "doc_id", "lang", "source", "n_chars", "size", "place", "slice", "copy", "t1", "anchor", "fp", "node", "root", "word",
         "n", "rare", "row", "bucket", "term", "spans", "held_out", "score", "target", "passes", "of")
EXTRA = {name: "x" for name in NAMES[5:]}


@pytest.fixture(scope="module")
def untidy(spark):
    """Nulls everywhere, empty, letterless and very long texts, repeated rows, and columns of every internal name."""
    long_text = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [
        (1, "One short text about the thing.", "en", "a", 31),
        (1, "One short text about the thing.", "en", "a", 31),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n\x0b ", "fr", "b", 5),
        (5, "12345 !!! 67", None, "b", 12),
        (None, "A text without an id and more than enough words to be kept by a rule of ten words.", "en", None, None),
        (None, None, None, None, None),
        (6, long_text, "en", "b", len(long_text)),
        (7, "é́漢字 <|endoftext|> ok <|startoftext|> A\x1cB \U0001f642", "zz", "c", 9),
    ]
    df = spark.createDataFrame([(t, i, *rest) for i, t, *rest in rows], "text string, doc_id bigint, lang string, source string, n_chars bigint")
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()})


def word_bpe():
    return tokenizer_path("word_bpe_49k.json")


PER_ROW = {
    "mixing": mixing.mix,
    "bpe": lambda d: bpe.encode(d, word_bpe()),
    "repeats": repeats.remove_repeats,
    "language": language.identify,
    "order_minhash": order_minhash.fingerprint,
    "quality": quality.judge,
    "privacy": privacy.find,
    "lm": lm.score,
    "simhash": simhash.near_duplicates,
    "token_counts": lambda d: token_counts.count_tokens(d, tokenizer_path("byte_bpe_50k.json")),
    "secrets": secrets.scan,
}
STAGES = {"reject": language.reject, "keep_first": simhash.keep_first, "sanitise": privacy.sanitise, "take": mixing.take}


@pytest.mark.parametrize("name", PER_ROW)
def test_untidy_rows_all_have_a_result(untidy, name):
    rows = PER_ROW[name](untidy).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (r.doc_id for r in untidy.select("doc_id").collect())))
    by_id = defaultdict(list)
    for row in rows:
        by_id[row.doc_id].append(row)
    assert len(set(map(str, by_id[1]))) == 1 or name == "order_minhash"
    empty = by_id[3][0]
    expected = {
        "mixing": lambda: (empty.size, empty.taken) == (0, 0),
        "bpe": lambda: (empty.n_tokens, empty.ids_sha256) == (0, sha("")),
        "repeats": lambda: (empty.n_bytes, empty.n_removed, empty.n_spans, empty.kept_sha256) == (0, 0, 0, sha("")),
        "language": lambda: (empty.lang_pred, empty.score) == ("und", 0.0) and by_id[5][0].lang_pred == "und",
        "order_minhash": lambda: set(empty.fingerprint) == {"0"} and empty.edited_sha256 == sha(""),
        "quality": lambda: empty.base_failed and not empty.kept and empty.n_words == 0,
        "privacy": lambda: empty.spans == "" and empty.base_sha256 == sha(""),
        "lm": lambda: empty.n_tokens == 1 and math.isclose(empty.score, by_id[2][0].score),
        "simhash": lambda: empty.fingerprint == "0" * 16 and empty.component_id == 2,
        "secrets": lambda: (empty.spans, empty.base_sha256) == ("", sha("")),
        "token_counts": lambda: (empty.n_bytes, empty.n_tokens, empty.over_limit) == (0, 0, False),
    }
    assert expected[name]()


@pytest.mark.parametrize("name", [*PER_ROW, *STAGES])
def test_empty_tables_give_empty_results(untidy, name):
    assert (PER_ROW | STAGES)[name](untidy.filter("false")).count() == 0


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_and_whole_rows(untidy, name):
    out = STAGES[name](untidy)
    assert out.schema.names == untidy.schema.names
    before = [tuple(r) for r in untidy.collect()]
    after = [tuple(r) for r in out.collect()]
    assert set(after) <= set(before)
    ids = [r[1] for r in after]
    if name == "reject":  # the letterless ones go
        assert sorted(map(str, ids)) == sorted(["1", "1", "6", "7", "None"])
    if name == "keep_first":  # 2, 3, 4 and a row without an id have no words, 1 is there twice
        assert sorted(map(str, ids)) == sorted(["1", "2", "5", "6", "7", "None"])
    if name == "sanitise":
        assert len(after) == len(before)


# --- shared helpers ------------------------------------------------------------------------------------------------


def test_summaries_miss_no_frequent_item():
    rng = random.Random(1)
    items = [rng.choice("abcdef") if rng.random() < 0.5 else str(rng.randrange(5000)) for _ in range(20_000)]
    parts = [Summary(50) for _ in range(7)]
    for i, item in enumerate(items):
        parts[i % 7].update([item])
    whole = Summary(50)
    for part in parts:
        whole.update(dict(zip(*part.row())))
    kept, counts = whole.row()
    true = Counter(items)
    assert {x for x, n in true.items() if n > len(items) / 50 * 2} <= set(kept)
    assert all(n <= true[x] for x, n in zip(kept, counts))


def test_frequent_items_cover_all_partitions(spark):
    df = spark.createDataFrame([("a b b",), (None,), ("b c",), ("",)] * 20, "text string").repartition(9)
    assert frequent_items(df, str.split, 10) == ["b", "a", "c"]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(10, 60)]
    edges = [*chain, *[(100, 100 + i) for i in range(1, 40)], (5, 5), (70, 69), (69, 70)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    roots = {r.node: r.root for r in components(df).collect()}
    assert {roots[i] for i in range(10, 61)} == {10} and {roots[i] for i in range(100, 140)} == {100}
    assert roots[5] == 5 and roots[70] == 69


# --- 1: mix --------------------------------------------------------------------------------------------------------


def test_mix_agrees_with_sql(spark):
    assert differences(QUERIES["op1_mixing"](spark, FOLDER), connection(FOLDER), SQL["op1_mixing"]) == []


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    sources = [None, "a", "b", "c", "d", "é"]
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(sources + ["a"] * 5)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(df).collect()
    by_source = defaultdict(list)
    for (_, _, source), row in zip(rows, sorted(out, key=lambda r: r.doc_id)):
        by_source[source].append(row)
    sizes = {s: sum(r.size for r in v) for s, v in by_source.items()}
    weight = dict(zip(sorted((s for s in sizes if s is not None)), (3, 1, 2, 3, 1))) | {None: 2}
    goal, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:  # water filling, one by one
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * unit >= 2 * sizes[s]]
        for s in full or free:
            goal[s] = 2 * sizes[s] if full else weight[s] * unit
        left -= sum(2 * sizes[s] for s in full)
        free = free - set(full) if full else set()
    for source, members in by_source.items():
        assert all(math.isclose(r.target, goal[source]) and r.source_size == sizes[source] for r in members)
        assert abs(sum(r.taken for r in members) - goal[source]) <= max(r.size for r in members) / 2 + 1e-6
        assert all(r.taken <= 2 * r.size for r in members)


def test_budgets_are_nested(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9 + 1), "ab"[i % 2]) for i in range(400)], "doc_id bigint, text string, source string")
    less, more = ({r.doc_id: r.copies for r in mixing.mix(df, share=share).collect()} for share in ((1, 2), (1, 1)))
    assert all(less[i] <= more[i] for i in less)


# --- 2 and 10: tokenizers ------------------------------------------------------------------------------------------


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name))


def odd_texts(n, seed):
    rng = random.Random(seed)
    alphabet = [*"abABthe1 \n\t\x0b\x1c\x1f\x85\xa0 .'!?é́漢ΣςİßǅＡ🙂²½ŉſ", "<|endoftext|>", "<|startoftext|>", "'re", "the ", "    "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_lexicon_holds_exactly_its_words(tmp_path):
    entries = {w: [len(w), i] for i, w in enumerate(["a", "an", "nation", "station", "stations", "漢字", "zz"])}
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon(entries))
    lexicon = bpe.Lexicon(str(path))
    assert {w: lexicon[w] for w in entries} == entries
    assert [lexicon[w] for w in ("", "n", "stat", "stationss", "z", "漢")] == [None] * 6
    shared = len(lexicon.label)
    assert shared < sum(len(w.encode()) for w in entries)  # suffixes are shared


def test_merges_and_splits_equal_the_library(tmp_path):
    encoder, vocabulary = library("word_bpe_49k.json"), bpe.Vocabulary(word_bpe())
    path = tmp_path / "lexicon"
    path.write_bytes(bpe.compile_lexicon({w: vocabulary.merge(w) for x in ("the", "this", "abab") for w in vocabulary.words(x)}))
    coder = bpe.Coder(word_bpe(), str(path), 60)
    for text in odd_texts(4000, 3):
        ids = encoder.encode(text, add_special_tokens=False).ids
        assert coder.code(text) == (len(ids), " ".join(map(str, ids)), encoder.decode(ids, skip_special_tokens=False))


def test_bpe_equals_the_library(found, docs):
    encoder = library("word_bpe_49k.json")
    for doc in docs:
        ids = encoder.encode(doc.text, add_special_tokens=False).ids
        row = found("op2_bpe")[doc.doc_id]
        decoded = encoder.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_bpe_returns_ids_and_text(spark):
    df = spark.createDataFrame([(1, "The nation.")], "doc_id bigint, text string")
    row = bpe.encode(df, word_bpe(), ids=True).first()
    encoder = library("word_bpe_49k.json")
    assert row.ids == encoder.encode("The nation.", add_special_tokens=False).ids and row.decoded == "the</w> nation</w> .</w>"


def test_pre_tokens_cut_nothing_apart():
    encoder = library("byte_bpe_50k.json")
    for text in odd_texts(4000, 4):
        whole = len(encoder.encode(text, add_special_tokens=False).ids)
        assert sum(token_counts.lengths(encoder, token_counts.pre_tokens(text))) == whole


def test_token_counts_equal_the_library(found, docs):
    encoder = library("byte_bpe_50k.json")
    for doc in docs:
        row, n = found("op10_token_counts")[doc.doc_id], len(encoder.encode(doc.text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(doc.text.encode()), n, n > 512)


def test_small_caches_count_the_same(spark, docs):
    df = spark.createDataFrame([(d.doc_id, d.text) for d in docs[:60]], "doc_id bigint, text string")
    path = tokenizer_path("byte_bpe_50k.json")
    a, b = (
        sorted(map(tuple, token_counts.count_tokens(df, path, table_items=t, cache_items=c).collect())) for t, c in ((8192, 10**6), (5, 50))
    )
    assert a == b


# --- 3: repeats ----------------------------------------------------------------------------------------------------


def test_deep_shallow_order():
    rng = random.Random(5)
    for _ in range(400):
        letters = rng.choice([b"a", b"ab", b"abc"])
        heads = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(3)]
        strings = [rng.choice(heads) + bytes(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(0, 25))]
        places, common = deep_shallow.order(strings, rng.choice([0, 2, 16]))
        assert [strings[i] for i in places] == sorted(strings) and sorted(places) == list(range(len(strings)))
        for i, n in enumerate(common):
            a, b = strings[places[i]], strings[places[i + 1]]
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def repeats_by_brute_force(all_texts):
    seen = Counter(t[p : p + 200] for t in all_texts for p in range(len(t) - 199))
    for t in all_texts:
        marks = np.zeros(len(t) + 1, int)
        for p in range(len(t) - 199):
            if seen[t[p : p + 200]] > 1:
                marks[p] += 1
                marks[p + 200] -= 1
        gone = np.cumsum(marks)[:-1] > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        yield len(t), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum()), hashlib.sha256(kept).hexdigest()


def check_repeats(spark, all_texts):
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(all_texts)], "doc_id bigint, text string").repartition(4)
    rows = sorted(repeats.remove_repeats(df).collect(), key=lambda r: r.doc_id)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == list(repeats_by_brute_force(all_texts))


def test_repeats_in_documents(found, docs):
    expected = list(repeats_by_brute_force([d.text.encode() for d in docs]))
    rows = [found("op3_repeats")[d.doc_id] for d in docs]
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == expected
    assert any(r.n_removed for r in rows)


def test_repeats_of_any_length_and_place(spark):
    rng = random.Random(7)

    def text(n):
        return bytes(rng.choice(b"abcdefgh ") for _ in range(n))

    passages = [text(n) for n in (150, 199, 200, 201, 230, 300, 420, 900)]
    made = [
        b"".join(rng.choice([text(rng.randint(0, 120)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 40) :]]) for _ in range(rng.randint(0, 6)))
        for _ in range(150)
    ]
    periodic = [b"a" * 700, b"ab" * 400, b"xyz " * 150, b"Verung " * 120, text(300) * 3, b""]
    across = text(repeats.PIECE + 600)  # over the border of the pieces that are handled at once
    check_repeats(spark, [*made, *made[:20], *periodic, across, text(90) + across[repeats.PIECE - 300 : repeats.PIECE + 400]])


@pytest.mark.parametrize("gathered", [64, 1024])
def test_repeats_around_a_very_common_anchor(spark, monkeypatch, gathered):
    """More surroundings of one passage than are gathered in a task, and many slightly different copies of a text."""
    monkeypatch.setattr(repeats, "GATHERED", gathered)
    rng = random.Random(8)

    def text(n):
        return bytes(rng.choice(b"abcdefgh ") for _ in range(n))

    shared, base = text(260), text(500)
    near = []
    for _ in range(94):
        copy = bytearray(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(500)] = 65 + rng.randrange(20)
        near.append(bytes(copy))
    check_repeats(spark, [*(text(80) + shared + text(50) for _ in range(94)), *near])


# --- 4: language ---------------------------------------------------------------------------------------------------


def test_kernel_is_the_share_of_common_grams():
    samples = [("The cat sat", "en"), ("Die Katze saß", "de"), ("Le chat", "fr")]
    model = language.Model(samples, 3, 1e-3)
    texts = ["A cat!", "chat chat", "ß"]

    def grams(text):
        letters = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
        return {letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1)}

    sets = [language.grams(t) for t in texts]
    for i, text in enumerate(texts):
        assert len(sets[i]) == len(grams(text))
        for j, (landmark, _) in enumerate(sorted(samples, key=lambda s: s[1])):
            a, b = grams(text), grams(landmark)
            assert math.isclose(model.kernel(sets)[i, j], len(a & b) / math.sqrt(len(a) * len(b)), abs_tol=1e-6)


def test_languages_of_held_out_documents(found, docs):
    rows = found("op4_language")
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0) for d in docs)
    held = [d for d in docs if rows[d.doc_id].held_out and d.lang is not None]
    right = sum(rows[d.doc_id].lang_pred == d.lang for d in held if any(map(str.isalpha, d.text)))
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_labels_of_held_out_rows_teach_nothing(spark, docs):
    df = spark.createDataFrame([(d.doc_id, d.text, d.lang) for d in docs], "doc_id bigint, text string, lang string")
    spoiled = df.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, "xx").otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, language.identify(x).collect())) for x in (df, spoiled))
    assert a == b


# --- 5: fingerprints -----------------------------------------------------------------------------------------------


def order_minhash_by_brute_force(text):
    points = order_minhash.to_points(text)
    codes, seen, numbered = order_minhash.kmers(points).tolist(), Counter(), []
    repeated = {c for c, n in Counter(codes).items() if n > 1}
    for code in codes:
        salt = (code + seen[code] * int(order_minhash.BASE)) % 2**64
        numbered.append(int(order_minhash.mixed(np.array([salt], np.uint64))[0]) if code in repeated else code)
        seen[code] += 1
    out = []
    for by in order_minhash.MULTIPLIERS.tolist():
        hashes = [((x >> 32) * by) % 2**32 for x in numbered]
        two = sorted(range(len(hashes)), key=lambda i: (hashes[i], i))[:2]
        first, second = sorted(two if len(two) == 2 else two * 2)
        pair = (numbered[first] * int(order_minhash.BASE) + numbered[second]) % 2**64
        out.append(int(order_minhash.mixed(np.array([pair], np.uint64))[0]) >> 32)
    return np.array(out, np.uint32)


@pytest.mark.parametrize("text", ["a", "abcdefgh", "ab" * 60, "x" * 90, "the cat and the dog and the cat " * 3, "né " * 40])
def test_order_minhash(text):
    assert np.array_equal(order_minhash.signature(order_minhash.to_points(text)), order_minhash_by_brute_force(text))


def test_order_minhash_sees_order():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(300)]
    text, shuffled, close = " ".join(words), " ".join(rng.sample(words, 300)), " ".join(words[:150] + ["new"] + words[150:])
    a, b, c = (order_minhash.signature(order_minhash.to_points(t)) for t in (text, shuffled, close))
    assert order_minhash.likeness(a, c) > 0.8 > 0.4 > order_minhash.likeness(a, b)


def test_fingerprints_of_documents_and_edits(found, docs):
    rows = found("op5_order_minhash")
    ordered = sorted(docs, key=lambda d: -d.doc_id)
    prints = {d.doc_id: order_minhash.signature(order_minhash.to_points(d.text)) for d in docs}
    for i, doc in enumerate(ordered):
        after, row = ordered[(i + 1) % len(ordered)], rows[doc.doc_id]
        n = len(doc.text)
        changed = doc.text[: n - n // 2] + after.text[: n // 2]
        new = order_minhash.signature(order_minhash.to_points(changed))
        assert (row.n_chars, row.edited_sha256) == (n, sha(changed))
        assert row.fingerprint == order_minhash.hexed(prints[doc.doc_id]) and row.edited_fingerprint == order_minhash.hexed(new)
        assert row.near_edited == float((new == prints[doc.doc_id]).mean())
        assert row.near_next == float((prints[after.doc_id] == prints[doc.doc_id]).mean())


def test_successors_across_slices_and_ties(spark):
    rows = [(i * 7 % 1000, f"text {i} " * 5) for i in range(1000)] + [(5, "text again"), (None, "no id"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    out = order_minhash.fingerprint(df).collect()
    assert len(out) == len(rows)
    text = {i: t for i, t in rows[:1000]}
    for row in out:
        if row.doc_id is not None and row.doc_id not in (0, 5, 6):
            own, after = text[row.doc_id], text[row.doc_id - 1]
            assert row.edited_sha256 == sha(own[: len(own) - len(own) // 2] + after[: len(own) // 2])


# --- 6: quality ----------------------------------------------------------------------------------------------------


def test_quality_base_figures(found, docs):
    for doc in docs:
        words = WORD.findall(doc.text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        seen, repeated = set(), 0
        for line in doc.text.split("\n"):
            if WORD.search(line):
                repeated += line in seen
                seen.add(line)
        row = found("op6_quality")[doc.doc_id]
        symbols = len(re.findall(r"[#*$%&|<>]", doc.text))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), symbols, repeated, len(covered))
        assert row.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (row.base_failed and row.kept)


def test_divergence_verdicts(found, spark, docs):
    """Distances against references recomputed from all documents; documents labelled good are kept."""
    shared = quality.references(spark.read.parquet(f"{FOLDER}/documents.parquet"), "text", "lang", 32, 200)
    for i, lang in enumerate(shared.languages):
        own = [d.text.encode() for d in docs if d.lang == lang]
        assert shared.classes[i].tolist() == sum(quality.class_counts(t) for t in own).tolist()
        words = Counter(w for t in own for w in t.lower().split())
        for word, place in shared.bins[i].items():
            assert shared.common[i][place] == words[word]
        assert shared.common[i].sum() == sum(words.values())
    for doc in docs:
        row = found("op6_quality")[doc.doc_id]
        by_class, by_word = shared.distances(doc.text.encode(), doc.text.encode().split())
        assert math.isclose(row.class_distance, by_class) and math.isclose(row.word_distance, by_word)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good = [found("op6_quality")[i] for i, q in labels.items() if q == 1 and i in found("op6_quality")]
    assert all(r.kept for r in good if not r.base_failed)


def test_texts_without_common_words_fail(spark):
    """Random letter strings with normal punctuation, beside documents of which the clean ones stay."""
    rng = random.Random(8)

    def gibberish(n):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(n)]
        return " ".join(w.capitalize() + ("." if i % 9 == 8 else "") if i % 9 in (0, 8) else w for i, w in enumerate(words))

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    planted = spark.createDataFrame([(-n, gibberish(n), None, "x", 0) for n in (60, 150, 600, 3000)], docs.schema)
    rows = {r.doc_id: r for r in quality.judge(docs.unionByName(planted)).collect()}
    assert not any(rows[-n].kept or rows[-n].base_failed for n in (60, 150, 600, 3000))
    good = [r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect() if r.quality == 1]
    assert all(rows[i].kept for i in good if i in rows and not rows[i].base_failed)


def test_every_label_has_a_reference(spark):
    """A hot label, a rare one without blanks, and more labels than one pass counts."""
    rng = random.Random(9)
    hot = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(400)) for _ in range(60)]
    signs = [chr(x) for x in range(0x4E00, 0x4E00 + 500)]
    rare = [" ".join("".join(rng.choice(signs) for _ in range(8)) for _ in range(60)) for _ in range(4)]
    rows = [("hot", t) for t in hot] + [("rare", t) for t in rare] + [(f"l{i}", f"word{i} " * 3) for i in range(40)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")
    known = quality.references(df, "text", "lang", 32, 200)
    assert known.languages == sorted({lang for lang, _ in rows}) and (known.classes.sum(axis=1) > 0).all()
    words = Counter(w for t in hot for w in t.split())
    best = sorted(words, key=lambda w: (-words[w], w))[:200]
    assert list(known.bins[known.languages.index("hot")]) == [w.encode() for w in best]
    verdicts = {r.doc_id: r.kept for r in quality.judge(df).collect()}
    assert all(verdicts[60 + i] for i in range(4))


def test_both_distances_are_to_one_language():
    """Characters of one language with the words of another are near neither."""
    known = quality.References({"a": ["aa", "bb"], "b": ["55", "66"]})
    known.classes[:, 1], known.classes[:, 3] = [100, 0], [0, 100]
    known.common[:] = [[50, 50, 1], [50, 50, 1]]
    by_class, by_word = known.distances(b"5566", [b"aa", b"bb"] * 50)
    assert max(by_class / quality.CLASS_LIMIT, by_word / quality.WORD_LIMIT) > 1


def test_shannon_distance_is_bounded():
    p, q = np.array([1.0, 0, 0]), np.array([[0.0, 2, 2], [5, 0, 0], [0, 0, 0]])
    assert quality.shannon_distance(p, q)[:2].tolist() == [1.0, 0.0]


# --- 7: personal data ----------------------------------------------------------------------------------------------


def base_by_brute_force(text):
    spans = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(x) for x in m.group() if x.isdigit()]
        odd = sum(digits[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in digits[-2::-2])
        if 16 <= len(digits) <= 19 and odd % 10 == 0:
            spans.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(x.isdigit() for x in m.group()) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


def test_patterns():
    rng = random.Random(4)
    pieces = ["1.2.3.4", "a@b.c", "4111111111111111", "+1 (234) 555-6789", "300.1.1.1", *"ab@.-1+ 0(٣é%9"]
    for _ in range(30_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert privacy.base_spans(text) == base_by_brute_force(text)


def test_personal_data_in_documents(found, docs):
    for doc in docs:
        base, row = base_by_brute_force(doc.text), found("op7_privacy")[doc.doc_id]
        assert row.base_sha256 == sha(privacy.digest_of(base))
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]


@pytest.fixture(scope="module")
def leaks(spark):
    """"zarquon" stands beside one address in different places, "meeting" beside every one; a passage is copied often."""
    rng = random.Random(6)
    filler = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]

    def some(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    rows = [f"{some(9)} Zarquon, the meeting x.y@mail.example {some(9)}" for _ in range(6)]
    rows += [f"{some(9)} meeting with o{i}@mail.example {some(9)}" for i in range(40)]
    rows += [f"meeting {some(30)}" for _ in range(200)]
    rows += ["copied passage of quirrel who writes from q.r@mail.example to us"] * 9
    rows += [f"{some(5)} zarquon! {some(5)}"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


def test_terms_that_disclose_are_found_everywhere(leaks):
    rows = {r.doc_id: r for r in privacy.find(leaks).collect()}
    texts = {r.doc_id: r.text for r in leaks.collect()}
    marked = Counter()
    for i, row in rows.items():
        for span in filter(None, row.spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "term":
                marked[texts[i][int(a) : int(b)].lower()] += 1
    assert marked == {"zarquon": 7}


def test_copies_leave_the_disclosing_terms_unchanged(spark, leaks):
    limits = {x: privacy.LIMITS[x] for x in ("reach", "support", "share", "bits")}
    copied = leaks.crossJoin(spark.range(10)).select("text")
    found = [sorted(r.term for r in privacy.disclosing_terms(rows, **limits).collect()) for rows in (leaks.select("text"), copied)]
    assert found == [["zarquon"]] * 2


def test_spans_give_way_to_their_kind(leaks):
    out = {r.doc_id: r.text for r in privacy.sanitise(leaks).collect()}
    assert "[TERM], the meeting [EMAIL]" in out[0] and "zarquon" not in str(out).lower() and "@" not in str(out)
    assert out[46] == leaks.filter("doc_id = 46").first().text


# --- 8: language model ---------------------------------------------------------------------------------------------


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, most in ((1, 1), (5, 3), (1000, 10**6), (20_000, 2**40), (1000, 100), (3, 2**50)):
        values = np.sort(rng.integers(0, most, n))
        assert np.array_equal(elias_fano.Sequence.build(values).access(np.arange(n)), values)
        values = np.unique(values)
        asked = np.concatenate([values, np.minimum(rng.integers(0, most, 500), values[-1])])
        places = np.minimum(np.searchsorted(values, asked), len(values) - 1)
        expected = np.where(values[places] == asked, places, -1)
        assert np.array_equal(elias_fano.Sequence.build(values).find(asked), expected)


def tokens_of(text):
    return (text or "").encode().lower().split()


def test_base_scores(found, docs):
    counts = Counter()
    for d in docs:
        if zlib.crc32(str(d.doc_id).encode()) % 7 != 2:
            counts.update([*tokens_of(d.text), "end"])
    n, v = sum(counts.values()), len(counts)
    for d in docs:
        row, own = found("op8_lm")[d.doc_id], [*tokens_of(d.text), "end"]
        expected = math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(t in counts for t in own), n)
        assert row.held_out == (zlib.crc32(str(d.doc_id).encode()) % 7 == 2)
        assert math.isclose(row.base_score, expected, rel_tol=1e-9)


def test_model_scores(found, docs):
    """Interpolated absolute discounting over the grams that occur twice, by dictionaries."""
    words, pairs, triples = Counter(), Counter(), Counter()
    training = [["<", *tokens_of(d.text), ">"] for d in docs if zlib.crc32(str(d.doc_id).encode()) % 7 != 2]
    for text in training:
        words.update(text[1:])
    n, v = sum(words.values()), len(words)
    known = {w for w, c in words.items() if c > 1} | {"<", ">"}
    contexts = Counter(words) | Counter({"<": len(training)})
    for text in training:
        pairs.update((a, b) for a, b in zip(text, text[1:]) if a in known and b in known)
    pairs = {k: c for k, c in pairs.items() if c > 1}
    for text in training:
        triples.update(t for t in zip(text, text[1:], text[2:]) if t[:2] in pairs and t[1:] in pairs)
    triples = {k: c for k, c in triples.items() if c > 1}
    left2, left3 = defaultdict(lambda: 1.0), defaultdict(lambda: 1.0)
    for (a, _), c in pairs.items():
        left2[a] -= (c - lm.DISCOUNT) / contexts[a]
    for (a, b, _), c in triples.items():
        left3[a, b] -= (c - lm.DISCOUNT) / pairs[a, b]

    def p(a, b, c):
        low = (words[c] + 1) / (n + v + 1)
        if b in known:
            low = left2[b] * low + (max(pairs.get((b, c), 0) - lm.DISCOUNT, 0) / contexts[b] if (b, c) in pairs else 0)
        if (a, b) not in pairs:
            return low
        return left3[a, b] * low + ((triples[a, b, c] - lm.DISCOUNT) / pairs[a, b] if (a, b, c) in triples else 0)

    base = model = 0.0
    for d in docs:
        text = [None, "<", *tokens_of(d.text), ">"]
        expected = math.fsum(math.log10(p(*t)) for t in zip(text, text[1:], text[2:]))
        row = found("op8_lm")[d.doc_id]
        assert abs(row.score - expected) <= row.n_tokens / lm.STEPS  # each of two factors is off by half a step at most
        base, model = base + row.base_score, model + row.score
    assert model > base


def test_scores_do_not_depend_on_chunks_and_shards(spark, docs, found):
    one = docs[:40]
    rows = spark.createDataFrame([(d.doc_id, d.text) for d in one] + [(None, "x " * 3000 + "y")], "doc_id bigint, text string")
    results = [
        sorted(lm.score(rows, chunk_words=c, shard_words=s).collect(), key=str) for c, s in ((10**6, 10**6), (500, 300), (1, 10**6))
    ]
    assert len(results[0]) == len(one) + 1
    for other in results[1:]:
        for x, y in zip(results[0], other):
            assert x[:5] == y[:5] and np.allclose(x[5:], y[5:], rtol=1e-12, atol=0)


def test_unrelated_text_changes_no_share(spark):
    """A corpus joined by one of other words: contexts and their successors are worth the same, words follow their counts."""
    rng = random.Random(4)
    first = [(i, " ".join(rng.choice(["ba", "bo", "bu", "be"]) for _ in range(30))) for i in range(60)]
    second = [(i, " ".join(rng.choice(["xa", "xo", "xu", "xe"]) for _ in range(30))) for i in range(1000, 1300)]
    alone, joined = (
        {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()} for rows in (first, first + second)
    )
    for i, text in first:
        words = len(text.split())
        assert alone[i].n_tokens == joined[i].n_tokens == words + 1
        # BEGIN is a context of both, so the first word is worth less; else only the words' own small part changes.
        assert abs(alone[i].score - joined[i].score) < 1.5 + 0.02 * words
        assert joined[i].base_score < alone[i].base_score - 0.5 * words


def dense_level(contexts, successors, counts):
    arrays = lm.Level.build(np.array(contexts, np.int64), np.array(successors, np.int64), np.array(counts, np.int64))
    return lm.Level(arrays)


def test_level_answers_as_dictionaries_do():
    rng = np.random.default_rng(2)
    keys, words = np.unique(rng.integers(0, 2**62, 300)), np.unique(rng.integers(0, 2**48, 90))
    grams = sorted({(int(rng.choice(keys)), int(rng.choice(words))): int(rng.integers(1, 9)) for _ in range(4000)}.items())
    level = dense_level([k[0] for k, _ in grams], [k[1] for k, _ in grams], [n for _, n in grams])
    counts, totals = dict(grams), Counter()
    for (context, _), n in grams:
        totals[context] += n
    asked = np.sort(np.concatenate([keys, rng.integers(0, 2**62, 50)]))
    every = np.concatenate([words, [0, 2**48 - 1]])
    left, share = level.answer(asked, np.full(len(asked), len(every)), np.tile(every, len(asked)))
    left, share = lm.value_of(left), lm.value_of(share).reshape(len(asked), -1)
    for i, context in enumerate(asked.tolist()):
        expected = [
            (counts[context, w] - lm.DISCOUNT) / totals[context] if counts.get((context, w), 0) >= lm.LEAST else 0.0 for w in every.tolist()
        ]
        assert np.allclose(share[i], expected, rtol=3e-4, atol=0)
        assert math.isclose(left[i], 1 - sum(expected), rel_tol=3e-4)
        # What follows a context and what it leaves have probability 1.
        assert math.isclose(left[i] + share[i].sum(), 1, rel_tol=1e-3)


def test_levels_without_grams():
    level = dense_level([], [], [])
    left, share = level.answer(np.array([5, 9]), np.array([1, 2]), np.array([1, 2, 3]))
    assert left.tolist() == [0, 0] and share.tolist() == [lm.ABSENT] * 3
    level = dense_level([4, 4], [1, 2], [1, 1])  # nothing twice
    left, share = level.answer(np.array([4]), np.array([2]), np.array([1, 2]))
    assert left.tolist() == [0] and share.tolist() == [lm.ABSENT] * 2


def test_a_shard_looks_up_each_gram_once_for_all_chunks(monkeypatch):
    """Chunks that ask for the same grams are answered together, as if each had asked alone."""
    rng = np.random.default_rng(8)
    contexts, successors = np.sort(rng.integers(0, 1 << 62, 300)), np.sort(rng.integers(0, 1 << 48, 200))
    shard, expected = lm.Shard(2), {}
    grams = [np.sort(rng.choice(60_000, 20_000, replace=False)) for _ in range(8)]
    total = np.bincount(np.concatenate(grams[:6]), minlength=60_000)
    of_context = total.reshape(300, 200).sum(axis=1)
    for chunk, codes in enumerate(grams):
        context, runs = np.unique(codes // 200, return_counts=True)
        counts = np.full(len(codes), int(chunk < 6))
        keys = np.diff(contexts[context], prepend=0)
        shard.add(chunk, lm.pack((keys, 8), (runs, 4), (successors[codes % 200], 6), (counts, 4)))
        share = (total[codes] - lm.DISCOUNT) / np.maximum(of_context[codes // 200], 1)
        expected[chunk] = np.where(total[codes] >= lm.LEAST, lm.quantised(share), lm.ABSENT)
    asked, find = [], elias_fano.Sequence.find
    monkeypatch.setattr(elias_fano.Sequence, "find", lambda self, x: asked.append(len(x)) or find(self, x))
    for chunk, body in shard.answers(shard.built()):
        assert np.array_equal(lm.unpack(body)[1], expected.pop(chunk))
    assert not expected and sum(asked) < 300 + 200 + 8 * 20_000 + 1


def test_runs_of_a_bucket_that_cross_words_are_found():
    """Numbers close together fill the upper bits' words with ones."""
    rng = np.random.default_rng(9)
    for gap in (1, 2, 1 << 20):
        values = np.cumsum(np.where(rng.random(5000) < 0.01, gap * 1000, 1))
        sequence = elias_fano.Sequence.build(values)
        assert np.array_equal(sequence.access(np.arange(5000)), values)
        asked = np.unique(np.concatenate([values, values - 1, values + 1]))
        asked = asked[(asked >= 0) & (asked <= values[-1])]
        places = sequence.find(asked)
        assert np.array_equal(places >= 0, np.isin(asked, values)) and np.array_equal(values[places[places >= 0]], asked[places >= 0])


# --- 9: SimHash ----------------------------------------------------------------------------------------------------


def fingerprint_by_brute_force(text):
    words = tokens_of(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups_by_brute_force(fps, distance):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= distance).tolist():
            parent[root(i)] = root(i + 1 + j)
    return [root(i) for i in range(len(fps))]


def test_simhash_of_documents(found, docs):
    rows = [found("op9_simhash")[d.doc_id] for d in docs]
    assert [int(r.fingerprint, 16) for r in rows] == [fingerprint_by_brute_force(d.text) for d in docs]
    roots = groups_by_brute_force(np.array([int(r.fingerprint, 16) for r in rows], np.uint64), 4)
    least = {}
    for d, r in zip(docs, roots):
        least[r] = min(least.get(r, d.doc_id), d.doc_id)
    assert [r.component_id for r in rows] == [least[r] for r in roots]


def test_links_connect_what_brute_force_connects(spark):
    """Random fingerprints, dense balls, chains, and a bucket far larger than the small ones."""
    rng = random.Random(10)
    fps = {rng.getrandbits(64) for _ in range(500)}
    for _ in range(5):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)}
    step = rng.getrandbits(64)
    for i in range(0, 60, 4):
        step ^= 0b1111 << i
        fps.add(step)
    head = rng.getrandbits(22) << 42
    fps |= {head | rng.getrandbits(42) for _ in range(300)}
    values = np.array(sorted(fps), np.uint64)
    nodes = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(nodes, 4)).collect()}
    expected, mine = groups_by_brute_force(values, 4), [roots.get(int(x), int(x)) for x in values.view(np.int64)]
    assert len(set(zip(expected, mine))) == len(set(expected)) == len(set(mine))


def test_pivots_discard_no_link():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**64, 400, dtype=np.uint64)
    fps[200:] = fps[:200] ^ np.uint64(0b1011)
    table = simhash.pivot_table(fps)
    i, j = np.triu_indices(400, 1)
    kept = set(simhash.linked(fps, table, i, j, 4).tolist())
    assert kept == set(np.flatnonzero(np.bitwise_count(fps[i] ^ fps[j]) <= 4).tolist()) and len(kept) >= 200


def test_long_runs_are_merged_as_the_library_does(spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(word_bpe())
    encoder.no_truncation()
    rng = random.Random(8)
    runs = ["".join(rng.choice(letters) for _ in range(n)) for letters in ("etaoin", "abcdefghijklmnopqrstuvwxyz") for n in (64, 65, 3000)]
    vocabulary = bpe.Vocabulary(word_bpe())
    assert all(vocabulary.merge(x) == encoder.encode(x, add_special_tokens=False).ids for x in [*runs, "ab" * 500, "a" * 999])
    text = "".join(rng.choice("abcdefgh") for _ in range(300_000))
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id int, text string"), word_bpe()).first()
    assert row.ids_sha256 == sha(" ".join(map(str, encoder.encode(text, add_special_tokens=False).ids)))


# --- 4, further: every label, long texts, large alphabets -----------------------------------------------------------


def invented(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_forty_labels_and_labels_of_long_texts_are_learned(spark):
    rng = random.Random(41)
    alphabets = {f"l{i:02d}": rng.sample("abcdefghijklmnopqrstuvwxyzàéîõüçñøß", 9) for i in range(40)}
    rows = [(100 * k + j, invented(rng, letters, 60), name) for k, (name, letters) in enumerate(alphabets.items()) for j in range(12)]
    rows += [(9000 + j, invented(rng, "кляузник", 6000), "long") for j in range(12)]
    rows += [(9100 + j, invented(rng, [chr(0x4E00 + x) for x in range(3000)], 40), "cjk") for j in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    truth = {r[0]: r[2] for r in rows}
    found = language.identify(df).collect()
    assert {r.lang_pred for r in found} == set(truth.values())
    right = [r.lang_pred == truth[r.doc_id] for r in found if r.held_out]
    assert sum(right) >= 0.9 * len(right)
    assert all(r.lang_pred == truth[r.doc_id] for r in found if truth[r.doc_id] in ("long", "cjk"))


def test_predictions_equal_a_dense_ridge(docs):
    """Weights, labels and scores from the definition, with one dense matrix over all n-grams; and in small blocks."""
    samples = [(d.text, d.lang) for d in docs if d.text and d.lang][:60]
    model = language.Model(samples, 12, 1e-3)
    sets = [{tuple(x) for x in map(lambda g: (int(g),), language.grams(t))} for t, _ in samples]
    labels = sorted({lang for _, lang in samples})
    chosen = [i for label in labels for i in [i for i, x in enumerate(samples) if x[1] == label][: 12 // len(labels)]]
    kernel = np.array([[len(a & sets[i]) / math.sqrt(len(a) * len(sets[i])) for i in chosen] for a in sets])
    goal = np.array([[1.0 if lang == label else -1.0 for label in labels] for _, lang in samples])
    weight = np.diag([1 / sum(x[1] == lang for x in samples) for _, lang in samples])
    weights = np.linalg.solve(kernel.T @ weight @ kernel + 1e-3 * kernel[chosen] + 1e-6 * np.eye(len(chosen)), kernel.T @ weight @ goal)
    tested = [d.text for d in docs if d.text][:200]
    parts = [{(int(g),) for g in language.grams(t)} for t in tested]
    values = np.array([[len(a & sets[i]) / math.sqrt(max(len(a), 1) * len(sets[i])) for i in chosen] for a in parts]) @ weights
    expected = [labels[j] for j in values.argmax(axis=1)]
    for block in (language.BLOCK_GRAMS, 500):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(language, "BLOCK_GRAMS", block)
            found, scores = language.Model(samples, 12, 1e-3).predict(tested)
        sure = [i for i, a in enumerate(parts) if a and np.diff(np.sort(values[i])[-2:])[0] > 1e-3]
        assert len(sure) > 150 and all(found[i] == expected[i] for i in sure)
        assert np.allclose([scores[i] for i in sure], np.clip((values.max(axis=1)[sure] + 1) / 2, 0, 1), atol=1e-3)
    assert model.labels == labels


# --- 11: vector codes ----------------------------------------------------------------------------------------------


def test_vector_codes_agree_with_sql(spark):
    assert differences(QUERIES["op11_vector_codes"](spark, FOLDER), connection(FOLDER), SQL["op11_vector_codes"]) == []


@pytest.mark.parametrize("rows, entries, width, size", [(1, 1, 4, 5), (3, 2, 2, 2), (700, 64, 4, 200), (3000, 37, 3, 3), (9000, 64, 2, 60)])
def test_dual_trees_assign_as_brute_force_does(rows, entries, width, size):
    """Small values make many ties, which go to the lower entry."""
    rng = np.random.default_rng(rows)
    points, books = rng.integers(-size, size, (rows, 16, width)), rng.integers(-size, size, (16, entries, width))
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    codes, errors = vector_codes.code_block(points, books, sums, counts)
    distances = ((points.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(axis=3)
    nearest = distances.argmin(axis=2)
    assert (codes.T == nearest).all() and (errors == distances.min(axis=2).sum(axis=0)).all()
    for part in range(16):
        assert (counts[part] == np.bincount(nearest[part], minlength=entries)).all()
        assert all((sums[part, j] == points[nearest[part] == j, part].sum(axis=0)).all() for j in range(entries))


def brute_codes(rows, entries):
    """(id, label, integers) in order of ids, two rounds, then codes."""
    books = [[v[4 * i : 4 * i + 4] for _, _, v in rows[:entries]] for i in range(16)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(2):
        for i, book in enumerate(books):
            members = defaultdict(list)
            for _, _, v in rows:
                members[near(v[4 * i : 4 * i + 4], book)[1]].append(v[4 * i : 4 * i + 4])
            books[i] = [[sum(c) // len(c) for c in zip(*members[j])] if j in members else e for j, e in enumerate(book)]
    coded = []
    for name, label, v in rows:
        parts = [near(v[4 * i : 4 * i + 4], books[i]) for i in range(16)]
        coded.append((name, label, "".join(f"{j:02x}" for _, j in parts), sum(d for d, _ in parts)))
    return coded, sha(",".join(str(x) for book in books for e in book for x in e))


def test_vector_codes_of_untidy_tables(spark):
    rng = random.Random(11)
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 3 if i % 4 else None, [rng.gauss(0, 0.3) for _ in range(64)]) for i in range(150)]
    good[20:25] = [(5, 1, good[20][2])] * 5  # repeated rows
    good[30] = (30, 2, [1e7 * (-1) ** i for i in range(64)])  # beyond what 64-bit distances allow
    bad = [(1, 1, None), (2, 1, []), (3, 1, [0.5] * 63 + [None]), (4, 1, [nan] * 64), (6, 1, [0.1] * 63 + [inf]), (7, 1, [0.1] * 32), (None, 1, None)]
    kept = [*good, (None, None, [0.25] * 64)]
    df = spark.createDataFrame([*bad, *kept], "vec_id bigint, label int, embedding array<double>").repartition(4)
    df = df.withColumns({k: F.lit("x") for k in ("code", "error", "vector", "part", "entry", "total")})
    found = vector_codes.compress(df).collect()
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    coded, digest = brute_codes([(i, label, [math.floor(256 * x) for x in v]) for i, label, v in ordered], 64)
    assert sorted(map(str, ((r.vec_id, r.code, r.error) for r in found))) == sorted(str((i, c, e)) for i, _, c, e in coded)
    by_label = Counter()
    for _, label, _, error in coded:
        by_label[label] += error
    labels = {(i, c): label for i, label, c, _ in coded}
    assert all(r.label_error == by_label[labels[r.vec_id, r.code]] for r in found)
    assert {r.codebooks_sha256 for r in found} == {digest}
    assert vector_codes.compress(df.filter("vec_id < 5 AND code = 'y'")).count() == 0
    few = vector_codes.compress(df.filter("vec_id IN (9, 10)")).collect()
    assert {r.error for r in few} == {0} and {r.code for r in few} == {"00" * 16, "01" * 16}


def test_errors_beyond_longs_are_null(spark):
    df = spark.createDataFrame([(i, 0, [float(i) * 1e30] * 16) for i in range(70)] + [(99, 1, [0.0] * 16)], "vec_id bigint, label int, embedding array<float>")
    rows = {r.vec_id: r for r in vector_codes.compress(df).collect()}
    assert len(rows) == 71 and rows[99].error == 0 and rows[99].label_error == 0
    assert any(r.error is None for r in rows.values()) and all(r.label_error is None for i, r in rows.items() if i != 99)


# --- 12: secrets ---------------------------------------------------------------------------------------------------


def brute_base(text):
    """The fixed kinds by the letter of their definition: leftmost, non-overlapping, failing matches dropped."""
    key = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in x) for x in ("password", "passwd", "secret", "token", "api_?key"))
                     + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    spans = [(m.start(), 0, m.end()) for m in key.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_base_secrets_against_their_definition(docs, found):
    rng = random.Random(12)
    hard = ["ToKeN = 'abcdefgh' ſecret=abcdefghij toKen:x apikey==abcdefg api_key=\"a.b-c_d/e+f\"", "AKIAKIA0123456789AB AKIA0123 " + "a" * 31 + "g" + "0" * 32,
            "é password: " + "".join(rng.choice("abcdef0123456789") for _ in range(40)) + " secret=secret=secret=12345678"]
    for text in hard:
        assert ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in secrets.base_spans(text)) == brute_base(text)
    rows = found("op12_secrets")
    for d in docs:
        row, expected = rows[d.doc_id], brute_base(d.text or "")
        assert row.base_sha256 == sha(expected)
        assert [x for x in row.spans.split(",") if x and not x.startswith("random")] == [x for x in expected.split(",") if x]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(expected.count(k + ":") for k in ("assign", "access", "hex"))


@pytest.mark.parametrize("name", ["decimal", "hex", "lower", "base32", "lower36", "base62", "base64"])
def test_battery_accepts_even_draws_and_rejects_order(name):
    rng = random.Random(name)
    letters, place = secrets.ENCODINGS[name], list(secrets.ENCODINGS).index(name)
    scores = np.array([secrets.score("".join(rng.choice(letters) for _ in range(40)), place) for _ in range(600)])
    assert (scores < 0.01).mean() < 0.04 and 0.4 < scores.mean() < 0.6  # near to uniform
    ordered = (letters * 4)[:40]
    assert secrets.score(ordered, place) < 0.01 and secrets.score(letters[0] * 40, place) < 1e-4


def test_random_strings_are_found_among_ordinary_text(spark):
    """Keys of three alphabets, among names and paths of the same lengths; copies count once."""
    rng = random.Random(13)
    words = [w for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(150).collect() for w in re.findall("[a-z]{4,9}", r.text or "")]
    base62 = secrets.ENCODINGS["base62"]
    keys = ["".join(rng.choice(base62) for _ in range(rng.randint(40, 60))) for _ in range(60)]
    names = ["".join(rng.choice(words).title() for _ in range(8)) for _ in range(200)]
    texts = []
    for i in range(300):
        hidden = keys[i % 60] if i % 3 == 0 else names[i % 200]
        texts.append(" ".join(rng.choices(words, k=120)) + f" {hidden} " + " ".join(rng.choices(words, k=120)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    hits = {r.doc_id: r.spans for r in secrets.scan(df).collect()}
    right = sum(f"random:{texts[i].index(keys[i % 60])}:" in hits[i] for i in range(0, 300, 3))
    wrong = sum("random" in hits[i] for i in range(300) if i % 3)
    assert right >= 90 and wrong <= 5
    doubled = {r.doc_id: r.spans for r in secrets.scan(df.unionByName(df.filter("doc_id % 3 = 0"))).collect()}
    assert sum(doubled[i] != hits[i] for i in hits) <= 5


def test_all_ordinary_text_counts_with_every_alphabet(spark):
    """Each letter is in a piece of each length, and each piece is judged in alphabets of all sizes."""
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()] + ["", "short", "x" * 16, "Ab3" * 45]
    df = spark.createDataFrame([(x,) for x in texts], "text string").repartition(3)
    got = Counter({(r["size"], r["length"], r["bin"]): r["ordinary"] for r in secrets.tallies(df).collect() if r["ordinary"]})
    expected = Counter()
    for text in texts:
        plain = re.sub("[^A-Za-z0-9]", "", re.sub("[A-Za-z0-9+/_-]{16,}={0,2}", "", text))
        for length, n in enumerate(secrets.LENGTHS):
            pieces = [plain[at : at + n] for at in range(0, len(plain) - n + 1, n)]
            pieces += [plain[-n:]] if len(plain) % n and pieces else []
            for size, alphabet in enumerate(secrets.FIRST):
                own = {x: next((alphabet.place[y] for y in (x, x.lower(), x.upper()) if y in alphabet.place), ord(x) % alphabet.size) for x in set(plain)}
                if pieces:
                    p = secrets.battery(np.array([[own[x] for x in piece] for piece in pieces]), alphabet)
                    expected.update((size, length, int(x)) for x in secrets.bins_of(p))
    assert got == expected and got


# --- 13: spelling --------------------------------------------------------------------------------------------------


def brute_spelling(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near, wild = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            wild[w[:i] + "*" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in wild.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 2 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def test_spelling_against_brute_force(spark, docs):
    rows = QUERIES["op13_spelling"](spark, FOLDER).collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(rows) == len(found) and found == brute_spelling([(d.doc_id, d.text) for d in docs])
    assert sum(x[0] is not None for x in found.values()) > 50


def test_spelling_of_untidy_tables(spark, untidy):
    rng = random.Random(14)
    rows = [(i if i % 5 else None, " ".join(rng.choice(["Xyzzy", "xyzzys", "xyzz", "plugh\u00e9", "PLUGHÉ", "plugh×", "aaaaaaa", "aaaaaa", "aaaab", "abcde", "abdce"]) for _ in range(30))) for i in range(60)]
    rows += [(99, "q" * 30_000 + " ") for _ in range(4)] + [(98, "q" * 29_999), (98, "q" * 29_999), (98, "q" * 29_999)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({k: F.lit("x") for k in ("word", "n", "form", "root", "near")})
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df.repartition(7)).collect()}
    assert found == brute_spelling(rows)
    before = [(r.doc_id, r.text) for r in untidy.collect()]
    assert {r.word: r.n for r in spelling.group_variants(untidy).collect()} == {w: x[2] for w, x in brute_spelling(before).items()}
    assert spelling.group_variants(untidy.filter("false")).count() == 0


def test_signatures_cover_every_edit():
    rng = random.Random(15)
    ranks = {c: i for i, c in enumerate("abcdefgh")}
    for _ in range(400):
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 14)))
        i, c = rng.randrange(len(w)), rng.choice("abcdefgh")
        replaced, shorter = w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]
        own = spelling.signatures(w, ranks)
        assert set(own[spelling.SAME]) & set(spelling.signatures(replaced, ranks)[spelling.SAME])
        assert set(own[spelling.LONGER]) & set(spelling.signatures(shorter, ranks)[spelling.SHORTER])
