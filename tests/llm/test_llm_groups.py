"""Spelling variants, near-duplicate vectors and the filter audit against plain versions."""

import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import oracle
from weirgate.llm import filter_audit, spelling, vector_dedup
from weirgate.llm.kernels import flat
from weirgate.llm.queries import QUERIES, SQL


def plain(frame, *columns):
    return sorted((tuple(row) for row in frame.select(*columns or frame.columns).collect()), key=repr)


def slips(seed: int, count: int) -> list[str]:
    """Words with a base form, rarer variants, and variants of these."""
    source = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzàéßÿ"
    words = []
    for _ in range(count):
        word, times = "".join(source.choice(letters) for _ in range(source.randrange(5, 12))), 150
        while times >= 5:
            words += [word] * times
            place, what = source.randrange(len(word)), source.randrange(3)
            word = word[:place] + ("" if what == 0 else source.choice(letters)) + word[place + (what != 1):]
            times //= 5
    source.shuffle(words)
    return words


# Spelling variants ---------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def spelled():
    words = slips(1, 40) + ["Straße-Maße", "ÀÉÎÕÜ×÷", "x" * 900, "x" * 899 + "y"] * 6 + ["aaaaaaa", "aaaaaa", "aaaabaa"] * 5
    rows = [(k if k % 9 else None, " ".join(words[k::50]).upper() if k % 5 == 0 else ", ".join(words[k::50])) for k in range(50)]
    return rows + [(70, None), (71, ""), (72, "1 2 3"), (5, rows[5][1]), (5, rows[6][1])]


def test_variants_equal_brute_force(spark, spelled):
    docs = spark.createDataFrame([(*row, 1, "x") for row in spelled], "doc_id long, text string, n int, word string").repartition(3)
    counts = brute.vocabulary(spelled)
    counted = spelling.counted_words(docs)
    assert dict(plain(counted)) == counts
    want = brute.variants(counts)
    assert any(row[2] not in (row[0], row[1]) for row in want)  # chains of forms
    for limits in ({}, {"shard_words": 7, "wave_bytes": 256}):  # one wave, and many with several filters a length
        got = spelling.spelling_variants(counted, **limits)
        assert plain(got, "word", "form", "root", "n", "n_near", "form_n") == sorted(want, key=repr)


def test_no_words(spark, no_docs):
    assert spelling.spelling_variants(spelling.counted_words(no_docs)).collect() == []


def test_every_edit_is_found_and_few_others():
    source = random.Random(4)
    words = sorted({"".join(source.choice("abcdeé") for _ in range(source.randrange(4, 9))) for _ in range(3000)})
    made = spelling.Words(words)
    parts = np.ones(spelling.LONG + 1, np.int64)
    held = [(size, 0, spelling.bloom(made.hashes()[made.size == size], spelling._blocks(int((made.size == size).sum()), size)).tobytes())
            for size in range(4, 9)]
    owner, spelled = spelling.found_edits(words, spelling.Filters(parts, held))
    real = [(words[k], edit) for k, edit in zip(owner, spelled) if edit in set(words)]
    assert len(real) == len(set(real))
    near = {frozenset(pair) for pair in real}
    want = set()
    for row in brute.variants(dict.fromkeys(words, 1)):
        want.add((row[0], row[4]))
    degree = {word: 0 for word in words}
    for pair in near:
        for word in pair:
            degree[word] += 1
    assert set(degree.items()) == want
    edits = sum(len(word) * (1 + len(spelling.ALPHABET)) for word in words)
    assert len(spelled) - len(real) < edits / 100


# Vectors -------------------------------------------------------------------------------------------------------------------


def clustered(seed: int, clusters: list[tuple[int, float]], dims: int = 24) -> list[list[float]]:
    source = np.random.default_rng(seed)
    out = []
    for count, noise in clusters:
        center = source.standard_normal(dims)
        out += (center + noise * source.standard_normal((count, dims))).tolist()
    return out


def vector_frame(spark, rows):
    return spark.createDataFrame([(vec, vector, 1, "x", 2) for vec, vector in rows],
                                 "vec_id long, embedding array<double>, label int, node string, m int").repartition(4)


def test_vectors_equal_brute_force(spark):
    vectors = clustered(3, [(1, 0.0)] * 40 + [(3, 0.05), (14, 0.05), (30, 0.2), (60, 0.3), (12, 0.0)])
    rows = [(k * 3, vector) for k, vector in enumerate(vectors)]
    rows += [(1001, None), (1002, []), (1003, [0.0, 0.0]), (1004, [float("nan"), 1.0]), (1005, [float("inf"), 1.0]), (1006, [None, 1.0]),
             (None, vectors[0]), (None, vectors[50]), (None, None), (0, vectors[0]), (0, vectors[3]), (2001, [1e200, 1e200]),
             (2002, [1.0, 1.0]), (2003, [1e-200, 1e-200]), (2004, [5.0]), (2005, [2.0, 0.0, 0.0])]
    # The wide clusters have pairs on both sides of the bound, so components are not all pairs.
    want = sorted(brute.vector_links(rows), key=repr)
    for limits in ({}, {"small": 3, "block": 16}):
        got = vector_dedup.near_duplicate_vectors(vector_frame(spark, rows), missed=1e-6, **limits)
        assert plain(got) == want


def test_no_vectors(spark):
    assert vector_dedup.near_duplicate_vectors(vector_frame(spark, [])).collect() == []
    assert plain(vector_dedup.near_duplicate_vectors(vector_frame(spark, [(4, None)]))) == [(4, 0, 4, True)]


def test_recall_follows_the_bound():
    """Pairs at the least cosine share a bucket about as often as the tables promise."""
    source = np.random.default_rng(8)
    left = source.standard_normal((4000, 32))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    other = source.standard_normal((4000, 32))
    other -= (other * left).sum(axis=1, keepdims=True) * left
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    right = 0.9 * left + math.sqrt(1 - 0.81) * other
    hashing = vector_dedup.Hashing(*vector_dedup.tables_for(5000, missed=0.05))
    a, b = (vector_dedup.normalised(one) for one in (left, right))
    met = (hashing.buckets(a) == hashing.buckets(b)).any(axis=1).mean()
    assert 0.93 < met < 0.97
    differ = np.unpackbits(hashing.sign_bits(a).view(np.uint8) ^ hashing.sign_bits(b).view(np.uint8), axis=1).sum(axis=1)
    assert differ.max() <= vector_dedup.most_signs()
    strange = np.unpackbits(hashing.sign_bits(a[1:]).view(np.uint8) ^ hashing.sign_bits(b[:-1]).view(np.uint8), axis=1).sum(axis=1)
    assert (strange <= vector_dedup.most_signs()).mean() < 0.01


def test_a_hot_cluster_is_counted_in_blocks(spark):
    vectors = clustered(5, [(1500, 0.1)])
    rows = [(k, vector) for k, vector in enumerate(vectors)]
    got = plain(vector_dedup.near_duplicate_vectors(vector_frame(spark, rows), block=128))
    assert got == sorted(((k, 1499, 0, k == 0) for k in range(1500)), key=repr)


# Filter audit --------------------------------------------------------------------------------------------------------------


def test_audit_equals_brute_force(spark, odd, odd_docs):
    rows = [(doc, ["en", None, "de"][k % 3], text) for k, (doc, text) in enumerate(odd)]
    labels = [(1, 1, 0), (2, 0, 1), (4, 1, 1), (12, 1, 0), (12, 0, 0), (None, 1, 1), (21, 1, None), (999, 1, 1), (18, None, 1)]
    got = filter_audit.audit(odd_docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert plain(got) == sorted(brute.filter_audit(rows, {1, 4, 12, 21}, {2, 4, 18}), key=repr)


def test_audit_of_nothing(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(no_docs, labels).collect() == []


def test_transducer(odd, monkeypatch):
    texts = [text or "" for _, text in odd] + ["a", "", "", "B#", "#", "é É", "a\x1cb", " ", "tail"]
    monkeypatch.setattr(filter_audit, "CHUNK", 37)  # stretches end inside words and characters
    data, offsets = flat(pa.array(texts))
    found = filter_audit.transduced(data, offsets)
    for k, text in enumerate(texts):
        own = found["owner"] == k
        spans = [data[a:b].tobytes().decode() for a, b in zip(found["starts"][own].tolist(), found["ends"][own].tolist())]
        assert spans == brute.words(text)
        assert found["points"][k] == len(text)
        assert found["capitals"][k] == sum("A" <= c <= "Z" for c in text)
        assert found["symbols"][k] == sum(c in "#$%&*|" for c in text)


def test_hash_table_verifies_its_hits():
    texts = ["aa bb aa cc bb", "aa aa", "", "x" * 5000 + " " + "x" * 5000 + " " + "x" * 4999 + "y"]
    data, offsets = flat(pa.array(texts))
    found = filter_audit.transduced(data, offsets)
    spans = found["starts"], found["ends"], found["owner"]
    for hashes in (None, np.zeros(len(spans[0]), np.uint64)):  # as they are, and all alike
        fresh = filter_audit.first_of_its_kind(data, *spans, hashes)
        assert np.bincount(spans[2][fresh], minlength=4).tolist() == [3, 1, 0, 2]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, folder, name):
    assert Path(folder).is_dir()
    assert oracle.differences(QUERIES[name](spark, folder), oracle.connect(folder), SQL[name]) is None
