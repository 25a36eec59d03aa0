"""Quality rules, personal data, token counts and id matrices against plain versions."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from weirgate.llm import binary_output, pii, quality
from weirgate.llm.pretokens import Encoder, Table
from weirgate.llm.token_counts import count_tokens, tokenizer_file


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    import random

    source = random.Random(3)
    parts = ["'s", "'t", "'re", "'r", "'ll", "'l", "'", "''", " ", "  ", "\n", "\t", " ", "　", "a", "Zé", "ß", "1", "²",
             "٣", "!", "<|endoftext|>", "<|endo", "中文", "🙂", "́", "\r\n", "'S", "ve", "\x1c", "\x00", "'d ", "_"]
    texts = ["".join(source.choice(parts) for _ in range(source.randrange(14))) for _ in range(4000)] + ["", None, "x" * 5000]
    ids, bounds = Encoder(tokenizer_file()).encode(pa.array(texts))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == _ids(library, text), text


def test_cache_that_is_full_is_started_anew(library):
    small = Encoder(tokenizer_file())
    small.ROOM = 50
    small.clear()
    texts = [f"word{k} other{k * 7} third" for k in range(300)]
    for k in range(0, 300, 20):
        ids, bounds = small.encode(pa.array(texts[k:k + 20]))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [_ids(library, t) for t in texts[k:k + 20]]


def test_one_slice_with_more_pretokens_than_the_cache_holds(library):
    numbers = " ".join(str(k) for k in range(450_000))
    encoder = Encoder(tokenizer_file())
    for text in ("1 2 3 seen before", numbers, "4 5 6 seen after"):
        assert encoder.encode(pa.array([text]))[0].tolist() == _ids(library, text)


def test_hash_table():
    source = np.random.default_rng(1)
    keys = np.unique(source.integers(1, 1 << 63, 5000).astype(np.uint64))
    table = Table(len(keys))
    table.add(keys, np.arange(len(keys), dtype=np.int32))
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1)) == -1).sum() >= len(keys) - 5


@pytest.mark.parametrize("frequent", [0, 3, 65_536])
def test_token_counts(odd, odd_docs, library, frequent):
    got = sorted(tuple(row) for row in count_tokens(odd_docs, tokenizer_file(), 100, max(frequent, 1)).collect()
                 if row.doc_id is not None)
    want = sorted((doc, len((text or "").encode()), len(_ids(library, text)), len(_ids(library, text)) > 100)
                  for doc, text in odd if doc is not None)
    assert got == want


def test_id_matrix_round_trip(odd, odd_docs, library):
    rows = binary_output.packed_ids(odd_docs, tokenizer_file(), length=128, shard_tokens=5000).collect()
    found = {}
    for row in rows:
        ids, positions = np.frombuffer(row.ids, "<u2"), np.frombuffer(row.positions, "<u2")
        assert len(ids) == len(positions) == 128 and row.cu_seqlens[-1] == row.n_tokens
        for k, (doc, start) in enumerate(zip(row.doc_ids, row.starts)):
            a, b = row.cu_seqlens[k:k + 2]
            assert positions[a:b].tolist() == list(range(b - a))
            found.setdefault(doc, []).append((start, ids[a:b].tolist()))
        assert (ids[row.n_tokens:] == 50_256).all()
    for doc in {doc for doc, _ in odd}:
        parts = [_ids(library, text) + [50_256] for other, text in odd if other == doc]
        cut = sorted((k, one[k:k + 128]) for one in parts for k in range(0, len(one), 128))
        assert sorted(found[doc]) == cut
    assert len({row.sequence_id for row in rows}) == len(rows)


def test_best_fit_decreasing_equals_a_walk():
    source = np.random.default_rng(5)
    sizes = source.integers(1, 64, 300)
    bins, want = binary_output.best_fit_decreasing(sizes, 64), []
    for size in sorted(sizes.tolist(), reverse=True):
        fits = [k for k, room in enumerate(want) if room >= size]
        if fits:
            want[min(fits, key=lambda k: want[k])] -= size
        else:
            want.append(64 - size)
    assert sorted(64 - sum(sizes[k] for k in one) for one in bins) == sorted(want)
    assert sorted(k for one in bins for k in one) == list(range(300))


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_measures(spark, odd, odd_docs):
    labels = _labels(spark, [(1, 1, 0), (1, 0, 0), (None, 1, 1), (4, None, 0), (999, 1, 0)])
    rows = quality.judged(odd_docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted(((row.doc_id, *[row[name] for name in names]) for row in rows), key=repr)
    assert got == sorted(((doc, *brute.measures(text)) for doc, text in odd), key=repr)
    assert all(row.kept == (not row.base_failed) for row in rows)  # so few labels certify nothing


def test_exact_bound():
    """The admitted number is the largest whose binomial tail is within the level."""
    for count, part, level in ((50, 0.1, 0.05), (1000, 0.01, 0.001), (10, 0.01, 0.05)):
        tail = lambda k: math.fsum(math.comb(count, j) * part ** j * (1 - part) ** (count - j) for j in range(k + 1))
        want = max((k for k in range(count) if tail(k) <= level), default=-1)
        assert quality.most_rejected(count, part, level) == want


def test_cutoffs_limit_false_rejection(spark):
    """Junk goes, good documents stay, strata without labels reject nothing."""
    rows, labels = [], []
    for k in range(4000):
        junk = k % 5 == 0
        words = [f"w{k}_{j}" for j in range(60)]
        text = " ".join(f"{word}!!" if junk else word for word in words)
        rows.append((k, text, "xx" if k % 40 < 2 else "en"))
        labels.append((k, 0 if junk else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    kept = {row.doc_id for row in quality.judged(docs, _labels(spark, labels), alpha=0.05).filter("kept").collect()}
    for doc, _, lang in rows:
        assert (doc in kept) == (lang == "xx" or doc % 5 > 0)
    again = {row.doc_id for row in quality.kept_rows(docs, _labels(spark, labels), alpha=0.05).collect()}
    assert again == kept


def test_false_rejections_hold_on_new_documents():
    """Over many draws, the part of good documents above the cutoff stays within the allowed part."""
    source, broken = np.random.default_rng(2), 0
    for _ in range(100):
        good, bad = source.geometric(0.02, 2000).clip(0, 1000), source.integers(0, 1000, 2000)
        frame = pd.DataFrame({"stratum": "s", "rule": "symbols", "score": np.r_[good, bad],
                              "good": np.r_[np.ones(2000, int), np.zeros(2000, int)],
                              "bad": np.r_[np.zeros(2000, int), np.ones(2000, int)]})
        cutoff = quality.cutoffs_of(frame, 0.05, 0.05, 0.0)["cutoff"][0]
        broken += 0.98 ** (cutoff - 1) > 0.05 / len(quality.RULES)
    assert broken <= 5


def test_personal_data(odd, odd_docs):
    got = sorted((tuple(row)[:6] for row in pii.digest(pii.find_personal_data(odd_docs)).collect()), key=repr)
    want = []
    for doc, text in odd:
        base = brute.personal(text)
        marks = ",".join(f"{pii.KINDS[kind]}:{a}:{b}" for a, kind, b in base)
        want.append((doc, *[sum(one[1] == kind for one in base) for kind in range(4)], brute.sha(marks)))
    assert got == sorted(want, key=repr)


def test_personal_data_on_random_texts():
    import random

    source = random.Random(5)
    parts = list("a@.1-+ %_()é") + ["@b.c", "1.2.3.4", "+1 (234) 555-0000", "4111 1111 1111 1111"]
    for _ in range(20_000):
        text = "".join(source.choice(parts) for _ in range(source.randrange(16)))
        found = sorted((a, pii.KINDS.index(kind), b) for kind, a, b in pii.base_spans(text))
        assert found == brute.personal(text), text


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+1 " * 130_000, "A1" * 200_000])
def test_personal_data_takes_linear_time(text):
    pii.spans_of(text)


def test_added_kinds_and_redaction():
    text = ("IBAN DE89 3704 0044 0532 0130 00, routing number 021000021, ssn 123-45-6789" + " and so on" * 9
            + " order 021000021, DE88 3704 0044 0532 0130 00")
    spans = pii.spans_of(text)
    assert [(kind, text[a:b]) for kind, a, b, _ in spans if kind not in pii.BASE_KINDS] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("aba", "021000021"), ("ssn", "123-45-6789")]
    assert pii.redacted("to a@b.cd now", pii.spans_of("to a@b.cd now")) == "to [email] now"


def test_redaction_keeps_rows(odd, odd_docs):
    rows = pii.redact_column(odd_docs).collect()
    assert sorted((row.doc_id is None, row.doc_id or 0, row.text is None) for row in rows) == sorted(
        (doc is None, doc or 0, text is None) for doc, text in odd)


def test_empty_tables(spark, no_docs):
    labels = _labels(spark, [])
    assert quality.judged(no_docs, labels).collect() == []
    assert quality.kept_rows(no_docs, labels).collect() == []
    assert pii.digest(pii.find_personal_data(no_docs)).collect() == []
    assert pii.redact_column(no_docs).collect() == []
    assert count_tokens(no_docs, tokenizer_file()).collect() == []
    assert binary_output.packed_ids(no_docs, tokenizer_file()).collect() == []


# Joint certification, names, collisions --------------------------------------------------------------------------------------


def thue_morse(length, one="a", two="b"):
    return "".join(one if k.bit_count() % 2 == 0 else two for k in range(length))


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_that_polynomials_modulo_a_power_of_two_confuse(spark, library, length):
    """Two Thue-Morse words agree under every odd base modulo 2**64; the operators tell them apart."""
    from weirgate.llm.near_dedup import near_duplicates, sets
    from weirgate.llm.substring_dedup import remove_repeated_passages

    one, two = thue_morse(length), thue_morse(length, "b", "a")
    tail = [f"w{k}" for k in range(19)]
    docs = spark.createDataFrame([(1, " ".join([one, *tail])), (2, " ".join([two, *tail]))], "doc_id long, text string")
    assert [row.n_removed for row in remove_repeated_passages(docs).collect()] == [0, 0]
    lines = quality.measures(pa.array([f"{one}\n{two}\n", f"{one} x y {two} x y"]))
    assert lines["n_dup_lines"].tolist() == [0, 0] and lines["n_repeat_words"].tolist() == [0, 0]
    assert quality.measures(pa.array([f"{one}\n{one}\n"]))["n_dup_lines"].tolist() == [1]
    left, right = sets(pa.array([one, two]))
    assert left.tolist() != right.tolist()
    alone = spark.createDataFrame([(1, one), (2, two), (3, one)], "doc_id long, text string")
    assert sorted((row.doc_id, row.component_id) for row in near_duplicates(alone).collect()) == [(1, 1), (2, 2), (3, 1)]
    encoder = Encoder(tokenizer_file())
    for text in (one, two, thue_morse(length, "1", "2"), thue_morse(length, "2", "1")):
        assert encoder.encode(pa.array([text]))[0].tolist() == _ids(library, text)
    numbers = spark.createDataFrame([(1, thue_morse(length, "1", "2")), (2, thue_morse(length, "2", "1"))], "doc_id long, text string")
    got = {row.doc_id: row.n_tokens for row in count_tokens(numbers, tokenizer_file()).collect()}
    assert got == {doc: len(_ids(library, text)) for doc, text in ((1, thue_morse(length, "1", "2")), (2, thue_morse(length, "2", "1")))}


def test_long_ranges_hash_alike_wherever_they_stand():
    from weirgate.llm.kernels import range_hashes, rolling_hashes

    source = np.random.default_rng(3)
    part = source.integers(0, 256, 3000).astype(np.uint8)
    data = np.concatenate((source.integers(0, 256, 777).astype(np.uint8), part, part, part[:50]))
    starts = np.array([777, 777, 1000, 3777, 3777])
    ends = np.array([3777, 3700, 1000 + 2000, 6777, 3777 + 2923])
    hashes = range_hashes(data, starts, ends)
    assert hashes[0] == hashes[3] and hashes[1] == hashes[4] and len(set(hashes.tolist())) == 3
    long = rolling_hashes(data, 1500)
    assert long[777] == long[3777] and len(np.unique(long[777:2277])) == 1500


def _random_labels(seed, count):
    source = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        bad = source.random() < 0.15
        stratum = ["en", "de", None][int(source.integers(0, 3))]
        scores = tuple(int(source.integers(0, 900)) if source.random() < (0.5 if bad else 0.02) else 0 for _ in quality.RULES)
        rows.append((k, stratum, scores, bool(source.random() < 0.1), int(not bad)))
    return rows


def test_verdicts_equal_brute_force(spark):
    rows = _random_labels(7, 3000)
    scored = spark.createDataFrame([(doc, stratum, 10 if failed else 60, 0, *scores) for doc, stratum, scores, failed, _ in rows],
                                   "d long, stratum string, n_words long, n_repeat_words long, " + ", ".join(f"{rule} int" for rule in quality.RULES))
    known = {doc: good for doc, *_, good in rows if doc % 2}
    labels = _labels(spark, [(doc, good, 0) for doc, good in known.items()])
    for alpha, price in ((0.02, 10.0), (0.1, 1.0)):
        limits = quality.cutoffs(scored, labels, alpha=alpha, price=price)
        with_limits = quality.with_cutoffs(scored.withColumn("key", quality._strata()), limits, "key")
        got = {row.d: row.kept for row in with_limits.select(
            "d", (~quality._base_failed() & (F.size(quality._rejected_by()) == 0)).alias("kept")).collect()}
        want = brute.verdicts([row[:4] for row in rows], known, alpha=alpha, price=price)
        assert [got[row[0]] for row in rows] == want
        assert sum(want) < sum(not row[3] for row in rows) - 20  # something is rejected


def test_joint_bound_holds_on_new_documents():
    """Over many draws, the part of all good documents that the chosen joint cutoff rejects stays within the allowed part."""
    source, broken = np.random.default_rng(5), 0
    true = 0.7 ** (np.arange(1001) / 100)  # share of good documents at a joint level or above
    for _ in range(200):
        frames = []
        for rules in range(1, 6):
            good = np.minimum(source.exponential(100 / -math.log(0.7), 400).astype(int), 1000)
            bad = source.integers(200, 1001, 60)
            frames.append(pd.DataFrame({"rules": rules, "score": np.r_[good, bad], "good": np.r_[np.ones(400, int), np.zeros(60, int)],
                                        "bad": np.r_[np.zeros(400, int), np.ones(60, int)]}))
        rules, cutoff = quality.joint_cutoff(pd.concat(frames), 0.05, 0.05 / 5, 0.0)
        broken += rules > 0 and true[cutoff] > 0.05
    assert broken <= 10


def test_strata_beyond_the_broadcast(spark, monkeypatch):
    rows = _random_labels(9, 1500)
    scored = spark.createDataFrame([(doc, stratum, 60, 0, *scores) for doc, stratum, scores, _, _ in rows],
                                   "d long, stratum string, n_words long, n_repeat_words long, " + ", ".join(f"{rule} int" for rule in quality.RULES))
    limits = quality.cutoffs(scored, _labels(spark, [(doc, good, 0) for doc, *_, good in rows]), alpha=0.1, price=1.0)
    keyed = scored.withColumn("key", quality._strata())
    want = sorted(map(tuple, quality.with_cutoffs(keyed, limits, "key").collect()), key=repr)
    monkeypatch.setattr(quality, "MAX_STRATA", 0)
    assert sorted(map(tuple, quality.with_cutoffs(keyed, limits, "key").collect()), key=repr) == want


def test_kept_rows_with_clashing_names(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(1, text, "en", 7, "k", 3), (2, "short", "en", 8, "m", 4)],
                                 "doc_id long, text string, lang string, _q_n_words int, _q_key string, `_Q_symbols` int")
    kept = quality.kept_rows(docs, _labels(spark, [(1, 1, 0)]))
    assert kept.columns == docs.columns and [tuple(row) for row in kept.collect()] == [(1, text, "en", 7, "k", 3)]


def test_redaction_works_on_slices(spark, monkeypatch):
    """Batches are looked at in slices of bounded size."""
    from weirgate.llm import common

    seen = []
    real = common.pieces
    monkeypatch.setattr(pii, "pieces", lambda batches, column: (seen.append(one.num_rows) or one for one in real(batches, column, 2000)))
    texts = [f"mail a{k}@b.cd " + "x" * 500 for k in range(20)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], names=["doc_id", "text"])

    class Docs:
        columns, schema = ["doc_id", "text"], None

        def mapInArrow(self, run, schema):
            return list(run(iter([rows])))

    out = pii.redact_column(Docs())
    assert max(seen) <= 4 and [t for one in out for t in one.column(1).to_pylist()] == [t.replace(f"a{k}@b.cd", "[email]") for k, t in enumerate(texts)]
