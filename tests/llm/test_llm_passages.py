"""Word and byte passages against plain versions."""

import random

import numpy as np
import pytest

import brute
from weirgate.llm import suffixes
from weirgate.llm.substring_dedup import remove_repeated_passages
from weirgate.llm.suffix_dedup import remove_repeated_bytes


def _rows(frame, *names):
    return sorted(((row["doc_id"], *[row[name] for name in names]) for row in frame.collect()), key=repr)


def _expected(odd, found):
    return sorted(((doc, *values) for (doc, _), values in zip(odd, found)), key=repr)


@pytest.mark.parametrize("width, gram, groups", [(20, 8, 1), (20, 8, 5), (7, 3, 3)])
def test_word_passages(odd, odd_docs, width, gram, groups):
    got = remove_repeated_passages(odd_docs, width, gram, groups=groups)
    assert _rows(got, "n_words", "n_removed", "kept_sha256") == _expected(odd, brute.passages(odd, width))


def test_kept_text_is_what_was_hashed(odd_docs):
    for row in remove_repeated_passages(odd_docs, groups=2).collect():
        assert brute.sha(row.kept_text) == row.kept_sha256
        assert len(brute.words(row.kept_text)) == row.n_words - row.n_removed


@pytest.mark.parametrize("shard_runs, groups", [(8192, 1), (1, 4), (2, 3)])
def test_byte_passages(odd, odd_docs, shard_runs, groups):
    got = remove_repeated_bytes(odd_docs, 400, 64, shard_runs, groups=groups)
    assert _rows(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == _expected(odd, brute.byte_passages(odd))


def test_branching_passages(spark):
    """Windows around one common anchor in many surroundings, some of which share more."""
    source = random.Random(7)
    common = [f"c{k}" for k in range(12)]
    tails = [[f"t{k}_{j}" for j in range(30)] for k in range(4)]
    rows = []
    for doc in range(60):
        own = [f"u{doc}_{j}" for j in range(source.randrange(0, 25))]
        rows.append((doc, " ".join(own + common + source.choice(tails)[:source.randrange(0, 31)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeated_passages(docs, 20, 8, groups=4)
    assert _rows(got, "n_words", "n_removed", "kept_sha256") == _expected(rows, brute.passages(rows))
    for shard_runs in (1000, 3):
        got = remove_repeated_bytes(docs, 60, 16, shard_runs, groups=4)
        assert (_rows(got, "n_bytes", "n_removed", "n_spans", "kept_sha256")
                == _expected(rows, brute.byte_passages(rows, 60)))


def test_empty_tables(no_docs):
    assert remove_repeated_passages(no_docs).collect() == []
    assert remove_repeated_bytes(no_docs).collect() == []


@pytest.mark.parametrize("data", [b"", b"a", b"banana", b"a" * 300, bytes(range(256)) * 3, b"abcabcabd" * 40])
def test_suffix_array(data):
    array = np.frombuffer(data, np.uint8)
    order, rank = suffixes.suffix_order(array, 64)
    want = sorted(range(len(data)), key=lambda k: data[k:k + 64])
    assert [data[k:k + 64] for k in order] == [data[k:k + 64] for k in want]
    shared = suffixes.common_prefixes(array, order, rank, 64)
    for place in range(1, len(data)):
        a, b = data[order[place - 1]:], data[order[place]:]
        common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        if common + max(order[place - 1], order[place]) < len(data):  # not cut by the end
            assert shared[place] == min(common, 64)


def test_versions_of_one_document_count_once(spark):
    """Rows that share an id: equal places are one place."""
    text = " ".join(f"w{k}" for k in range(120))
    docs = spark.createDataFrame([(1, text), (1, text), (2, "other")], "doc_id long, text string")
    assert {row.n_removed for row in remove_repeated_passages(docs).collect()} == {0}
    assert {row.n_removed for row in remove_repeated_bytes(docs).collect()} == {0}


@pytest.mark.parametrize("doc, five", [(None, True), (None, False), (4, False)])
def test_texts_that_share_an_id_are_documents_of_their_own(spark, doc, five):
    """One header at offset 0 of several texts without an id, or with one id: each text counts."""
    header = " ".join(f"head{k}" for k in range(90))
    rows = [(doc, f"{header} " + " ".join(f"t{k}w{j}" for j in range(40))) for k in range(5)]
    rows += [(5, f"{header} tail")] if five else []
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = sorted(row.n_removed for row in remove_repeated_bytes(docs, groups=3).collect())
    assert len(gone) == len(rows) and gone[0] >= len(header)
    gone = sorted(row.n_removed for row in remove_repeated_passages(docs, groups=3).collect())
    assert gone == [0] + [90] * (len(rows) - 1)
