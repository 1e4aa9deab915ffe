"""The stages in a row, and the contract's registration."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from ecometrics.llm import language, mixing, privacy, simhash
from ecometrics.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def test_everything_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert {"op1_mixing", "op11_vector_codes"} <= set(__spark_entry__.oracle_sql()) and "pipeline" not in __spark_entry__.oracle_sql()


def test_stages_against_their_operators(spark, tmp_path):
    """Each stage's rows follow from the decisions of its operator on that stage's input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, results = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(i))
        stage(spark, results[-1], FOLDER).write.parquet(path)
        results.append(spark.read.parquet(path))
    assert all(r.columns == columns for r in results[:-1])
    rows = [[tuple(x) for x in r.collect()] for r in results]

    lettered = [r for r in rows[0] if any(map(str.isalpha, r[1]))]
    assert set(rows[1]) <= set(lettered) and len(rows[1]) >= 0.99 * len(lettered)

    groups = {x.doc_id: x.component_id for x in simhash.near_duplicates(results[1]).collect()}
    assert sorted(rows[2]) == sorted(r for r in rows[1] if groups[r[0]] == r[0])

    found = {x.doc_id: x.spans for x in privacy.find(results[2]).collect()}
    by_id = {r[0]: r for r in rows[2]}
    for doc_id, text, *_, n_chars in rows[3]:
        if not found[doc_id]:
            assert (text, n_chars) == (by_id[doc_id][1], by_id[doc_id][-1])
        else:
            assert text != by_id[doc_id][1] and n_chars == len(text)

    copies = {x.doc_id: x.copies for x in mixing.mix(results[3]).collect()}
    assert Counter(r[0] for r in rows[4]) == {i: n for i, n in copies.items() if n}

    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    text_of = {r[0]: r[1] for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for row in results[5].collect():
        ids = encoder.encode(text_of[row.doc_id], add_special_tokens=False).ids
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()

    whole = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert whole == sorted(rows[5])


def test_clean_documents_pass_the_language_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = language.reject(docs)
    assert docs.join(kept, "doc_id", "left_anti").where(F.length("text") > 40).count() == 0


def test_texts_of_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(3)
    unlike = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3,
        "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิ " * 3,
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心。" * 3,
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem. " * 2,
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(300)),
    ]
    planted = spark.createDataFrame([(-1 - i, t, None, "x", len(t)) for i, t in enumerate(unlike)], docs.schema)
    kept = language.reject(docs.unionByName(planted))
    assert kept.where("doc_id < 0").count() == 0
    assert docs.join(kept, "doc_id", "left_anti").where(F.length("text") > 40).count() == 0


def test_groups_against_brute_force(spark):
    """Fingerprints few bits apart, rows that share an id or have none, and rows that are there twice."""
    rng = random.Random(5)
    texts = []
    for _ in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 600))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            copy = list(words)
            for _ in range(rng.randint(1, 3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(copy))
    prints = [simhash.fingerprint(t.encode()) for t in texts]
    group = list(range(len(texts)))
    pairs = [(i, j) for j in range(len(texts)) for i in range(j) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert len(pairs) > 5
    for _ in texts:
        for i, j in pairs:
            group[i] = group[j] = min(group[i], group[j])
    ids = [7 if i in (0, len(texts) - 1) else None if i % 9 == 5 else 100 + i for i in range(len(texts))]
    rows = list(zip(ids, texts))
    expected = {}
    for row, g in zip(rows, group):
        expected.setdefault(g, []).append(row)
    best = [min(x, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())) for x in expected.values()]
    df = spark.createDataFrame([*rows, *rows[::7]], "doc_id bigint, text string").repartition(5)
    assert Counter(map(tuple, simhash.keep_first(df).collect())) == Counter(best)
