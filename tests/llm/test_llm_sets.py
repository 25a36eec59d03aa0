"""Near duplicates, top-k, mixing, packing and the pipeline against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from weirgate.llm import common, mixing, near_dedup, packing, pretokens, quality, topk
from weirgate.llm.common import SMALL_PIECE
from weirgate.llm.components import components
from weirgate.llm.token_counts import tokenizer_file
from weirgate.session import arrow_batches


def _groups(frame):
    return {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in frame.collect()}


def test_near_duplicates(odd, odd_docs):
    got = _groups(near_dedup.near_duplicates(odd_docs, groups=3))
    plain = [(doc, text) for doc, text in odd if doc is not None]
    want = brute.components(plain)
    assert {doc: one for doc, one in got.items() if doc is not None} == want


def test_a_group_of_near_copies(spark):
    """Copies of a text with few and with many edits, and copies of such copies: components as by all pairs."""
    source = random.Random(11)
    base = [f"b{k}" for k in range(120)]

    def edited(words, count):
        out = list(words)
        for _ in range(count):
            out[source.randrange(len(out))] = f"e{source.randrange(10 ** 9)}"
        return out

    rows = [(k, " ".join(edited(base, source.randrange(0, 9)))) for k in range(150)]
    far = edited(base, 6)
    rows += [(200 + k, " ".join(edited(far, source.randrange(0, 3)))) for k in range(40)]
    rows += [(300 + k, " ".join(base[:90] + [f"z{k}_{j}" for j in range(30)])) for k in range(40)]
    source.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, want = _groups(near_dedup.near_duplicates(docs, groups=5)), brute.components(sorted(rows))
    assert got == want
    assert 1 < len({one[1] for one in want.values()}) < len(rows)


def test_registers_merge_and_estimate():
    source = np.random.default_rng(1)
    left, right = source.integers(0, 1 << 63, 3000).astype(np.uint64), source.integers(0, 1 << 63, 1000).astype(np.uint64)
    both = np.concatenate((left[:2000], right))
    one = lambda values: near_dedup.registers(values, np.array([0, len(values)]))[0]
    assert (one(np.concatenate((left, right))) == np.maximum(one(left), one(right))).all()
    a, b = one(left).astype(int), one(both).astype(int)
    numbers = [np.array([float(x)]) for x in ((a > b).sum(), (a < b).sum(), (a == b).sum(), len(left), len(both))]
    assert abs(near_dedup.likely_similarity(*numbers)[0] - 0.5) < 0.2


def test_components(spark):
    source = random.Random(2)
    links = [(source.randrange(200), source.randrange(200)) for _ in range(150)] + [(k, k + 1) for k in range(500, 560)]
    found = {row.node: row.component for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert found == {x: root(x) for a, b in links if a != b for x in (a, b)}


def test_top_k(spark):
    source = np.random.default_rng(4)
    rows = [(k, (source.normal(size=40) * (5 if k % 7 == 0 else 1)).tolist()) for k in range(600)]
    rows += [(600, None), (650, [1.0, None]), (651, [float("nan")] * 40), (652, [float("inf")] * 40), (None, [1.0] * 40),
             (700, [0.5] * 10), (701, []), (702, [0.25] * 60), (750, rows[3][1]), (751, rows[3][1]), (50, rows[50][1])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    extra = docs.selectExpr("vec_id", "embedding", "1 as v", "2 as query_id", "'x' as score")
    got = defaultdict(list)
    for row in topk.top_k(extra).collect():
        got[row.query_id].append((row.rank, row.vec_id, row.score))
    valid = [(k, [math.floor(256 * x) for x in v]) for k, v in rows
             if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for query, own in valid:
        if query % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(own, other)), k) for k, other in valid if k != query)
            assert sorted(got[query]) == [(n + 1, k, -s) for n, (s, k) in enumerate(scores[:5])]
    assert set(got) == {k for k, _ in valid if k % 50 == 0}


def test_top_k_with_a_query_given_three_times(spark):
    """All own rows in one chunk stand at the top; five others are found all the same."""
    source = np.random.default_rng(12)
    rows = [(k, source.normal(size=8).tolist()) for k in range(60)]
    rows[50] = (50, [9.0] * 8)
    rows += [rows[50]] * 2
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = sorted((row.rank, row.vec_id, row.score) for row in topk.top_k(docs).filter("query_id = 50").collect())
    whole = {k: [math.floor(256 * x) for x in v] for k, v in rows}
    scores = sorted((-sum(x * y for x, y in zip(whole[50], v)), k) for k, v in whole.items() if k != 50)
    assert got == [(n + 1, k, -s) for n, (s, k) in enumerate(scores[:5])]


def test_top_k_in_several_waves(spark, monkeypatch):
    source = np.random.default_rng(5)
    docs = spark.createDataFrame([(k, source.normal(size=8).tolist()) for k in range(500)], "vec_id long, embedding array<double>")
    want = sorted(tuple(row) for row in topk.top_k(docs, every=5).collect())
    monkeypatch.setattr(topk, "WAVE", 30)
    assert sorted(tuple(row) for row in topk.top_k(docs, every=5).collect()) == want


def test_top_k_prunes_and_stays_exact():
    """Clustered vectors: most pairs fall away after a block, the result is that of the full product."""
    source = np.random.default_rng(6)
    centers = source.integers(-200, 200, (20, 64))
    vectors = centers[source.integers(0, 20, 9000)] + source.integers(-8, 8, (9000, 64))
    search = topk.Search(np.arange(-40, 0), vectors[:40], 5)
    for first in range(0, 9000, 3000):
        search.add(np.arange(first, first + 3000), vectors[first:first + 3000])
    product = vectors[:40] @ vectors.T
    for k in range(40):
        best = np.lexsort((np.arange(9000), -product[k]))[:5]
        assert search.found[k].tolist() == best.tolist() and search.scores[k].tolist() == product[k][best].tolist()


def test_weights():
    tokens = [1000, 100, 10, 10, 0]
    even = mixing.exponent_for(tokens, 1.3, None)
    assert abs(mixing.entropy(mixing.weights_at(tokens, even)) - 1.3) < 1e-6
    limit = mixing.exponent_for(tokens, None, 3.0)
    assert abs(max(mixing.repeats_at(tokens, limit, None)) - 3.0) < 1e-6
    assert mixing.exponent_for(tokens, 1.3, 2.0) > even
    assert mixing.exponent_for([5, 5], None, 1.5) == 0.0


def _mixture(docs, **options):
    names = {"tokens_as": "_t", "copies_as": "_c"}
    return mixing.mixed(docs, **options, **names), names


def test_mixing_meets_the_plan(spark):
    source = random.Random(8)
    sizes = {"big": 3000, "mid": 900, "small": 120, None: 60}
    rows = [(10_000 * number + k, " ".join(["w"] * source.randrange(0, 30)), name)
            for number, (name, count) in enumerate(sizes.items()) for k in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    frame, names = _mixture(docs, max_repeats=4.0)
    got = frame.toPandas()
    assert len(got) == len(rows) and (got["_c"] >= 1).all()
    tokens = {name: sum(len(brute.words(text)) for _, text, own in rows if own == name) for name in sizes}
    plan = mixing.plan_of(pd.DataFrame({"s": list(tokens), "tokens": list(tokens.values())}), None, 4.0, None)
    for row in plan.itertuples():
        own = got[got["source"].isna() if row.s is None or row.s != row.s else got["source"] == row.s]
        used = int((own["_t"] * own["_c"]).sum())
        want = row.passes * row.tokens + row.rest
        assert want - 30 < used <= want
    assert sorted(map(tuple, mixing.realised(frame, **names).toPandas()["doc_id"].value_counts().items())) == sorted(
        zip(got["doc_id"], got["_c"]))


def test_mixing_keeps_odd_rows(odd, odd_docs):
    frame, names = _mixture(odd_docs)
    assert frame.columns[:-2] == odd_docs.columns
    assert Counter(row.doc_id for row in frame.collect()) == Counter(doc for doc, _ in odd)
    assert set(mixing.realised(frame, **names).columns) == set(odd_docs.columns)


def test_packing_of_histograms():
    source = np.random.default_rng(9)
    for count, length in ((0, 16), (1, 16), (40, 16), (3000, 64), (60_000, 128)):
        sizes = np.minimum(source.geometric(3 / length, count), length) if count else np.zeros(0, int)
        histogram = np.bincount(sizes, minlength=length + 1)
        made = packing.solve(histogram, length, 100)
        held = Counter()
        for configuration, times in zip(made.configurations, made.counts):
            assert sum(configuration) <= length
            for size in configuration:
                held[size] += times
        assert held == Counter(sizes.tolist())
        assert sum(made.counts) <= 1.002 * -(-int(sizes.sum()) // length) + 2


def _check_packing(rows, texts, library, length, end):
    """``texts``: all (doc_id, text) packed. Pieces, checks and places hold; the number of sequences."""
    parts, places = defaultdict(Counter), defaultdict(list)
    for row in rows:
        parts[row.doc_id][(row.piece, row.start, row.length, row.ids_crc32)] += 1
        places[row.sequence_id].append((row.offset, row.length))
    want = defaultdict(Counter)
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        head = len(ids) % length or length
        cuts = [0, *range(head, len(ids) + 1, length)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            check = zlib.crc32(np.array(ids[a:b], "<u4").tobytes())
            want[doc][(piece, a, b - a, check)] += 1
    assert parts == want
    for own in places.values():
        place = 0
        for offset, size in sorted(own):
            assert offset == place
            place += size
        assert place <= length
    return len(places)


def test_packing_of_documents(odd, odd_docs):
    library = Tokenizer.from_file(tokenizer_file())
    rows = packing.pack_documents(odd_docs, tokenizer_file(), length=256).collect()
    count = _check_packing(rows, odd, library, 256, 2)
    assert count <= -(-sum(row.length for row in rows) // 256) + 1
    assert all(zlib.crc32(row.ids) == row.ids_crc32 for row in rows)


def test_empty_tables(spark, no_docs):
    assert near_dedup.near_duplicates(no_docs).collect() == []
    assert packing.pack_documents(no_docs, tokenizer_file()).collect() == []
    assert _mixture(no_docs)[0].collect() == []
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def _stages(spark, docs, folder, out):
    frames = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{out}/{number}")
        docs = spark.read.parquet(f"{out}/{number}")
        frames.append(docs)
    return frames


def test_pipeline_stage_by_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    quality, near, personal, mixture, packed = _stages(spark, docs, folder, tmp_path)
    given = {row.doc_id: row.text for row in docs.collect()}
    kept = {row.doc_id: row.text for row in quality.collect()}
    assert kept == {doc: text for doc, text in given.items() if doc in kept}
    assert not any(brute.measures(text)[-1] for text in kept.values())
    alone = brute.components(sorted(kept.items()))
    left = {row.doc_id: row.text for row in near.collect()}
    assert left == {doc: kept[doc] for doc, one in alone.items() if one[2]}
    clean = {row.doc_id: row for row in personal.collect()}
    assert set(clean) == set(left)
    for doc, row in clean.items():
        assert row.n_chars == len(row.text)
        if not brute.personal(left[doc]):
            assert row.text == left[doc] or "[" in row.text
        else:
            assert "[" in row.text
    times = Counter(row.doc_id for row in mixture.collect())
    assert set(times) == set(clean) and max(times.values()) <= 2
    for frame in (quality, near, personal, mixture):
        assert frame.columns == docs.columns
    texts = [(doc, clean[doc].text) for doc, count in times.items() for _ in range(count)]
    _check_packing(packed.collect(), texts, Tokenizer.from_file(tokenizer_file()), 1024, 2)


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, no_docs, folder, tmp_path):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        frames = _stages(spark, docs, folder, tmp_path / name)
        assert all(frame.columns == docs.columns for frame in frames[:-1])
        if name == "none":
            assert all(frame.count() == 0 for frame in frames)
    near = [row.doc_id for row in spark.read.parquet(f"{tmp_path}/odd/1").collect()]
    assert len(near) == len(set(near)) and 1 in near and 2 not in near


def test_long_lists_of_arrow_types():
    """Null lists and slices of list columns keep their places."""
    column = pa.array([[1, 2], [3], [], [4, 5, 6]])
    assert topk.matrix(column).tolist() == [[1, 2, 0], [3, 0, 0], [0, 0, 0], [4, 5, 6]]
    assert topk.matrix(column.slice(1, 2)).tolist() == [[3], [0]]


@pytest.mark.parametrize("texts", [[None, "", "a b"], ["a b c d e f", "A B C D E F", "a b c d e"]])
def test_shingles(texts):
    own = near_dedup.sets(pa.array(texts))
    assert [len(one) for one in own] == [len(brute.shingles(text)) for text in texts]
    assert all((own[a].tolist() == own[b].tolist()) == (brute.shingles(texts[a]) == brute.shingles(texts[b]))
               for a in range(len(texts)) for b in range(len(texts)))


def test_bands_follow_the_least_similarity():
    for percent in (1, 5, 20, 50, 70, 80, 85, 95, 100):
        rows, count = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** count <= 1e-5
    assert near_dedup.banding(85) == (4, 16) and near_dedup.banding(80) == (3, 21)


def _at(similar, base):
    """``base`` with new words at its end, so that the sets of five-word shingles are about so similar."""
    own = len(base) - 4
    changed = round(own * (1 - similar) / (1 + similar))
    return base[:len(base) - changed] + [f"{base[0]}n{k}" for k in range(changed)]


@pytest.mark.parametrize("percent", [25, 80])
def test_near_duplicates_at_lower_thresholds(spark, percent):
    rows = []
    for number in range(30):
        base = [f"p{number}w{k}" for k in range(150)]
        rows += [(2 * number, " ".join(base)), (2 * number + 1, " ".join(_at(percent / 100 - 0.05 + 0.005 * number, base)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = _groups(near_dedup.near_duplicates(docs, percent, groups=3))
    assert got == brute.components(rows, percent)
    assert 30 < len({one[1] for one in got.values()}) < 60


def test_stage_keeps_rows_that_share_an_id(spark):
    """Rows without an id or with one id are documents of their own; of each group of near copies one row stays."""
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(120))
    rows = [(None, text(k)) for k in range(6)] + [(7, text(7)), (7, text(8)), (7, text(8)), (5, text(9)),
                                                  (None, text(9) + " end"), (3, text(10)), (4, text(10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = Counter(tuple(row) for row in corpus_pipeline.near_dedup_stage(spark, docs, "").collect())
    assert left == Counter(rows[:8] + [(None, text(9) + " end"), (3, text(10))])


def test_prefix_pairs_of_rows_given_twice(spark):
    """Sets that meet late in their prefixes are found when every row is given twice, and with two texts of an id."""
    base = [f"b{k}" for k in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:98] + [f"y{k}" for k in range(6)])), (3, " ".join(f"z{k}" for k in range(104))),
            (3, " ".join([f"x{k}" for k in range(6)] + base[6:]))]
    docs = spark.createDataFrame(rows + rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k) for k in (1, 2, 3)], "d long, component long")
    texts = docs.selectExpr("doc_id as d", "text").withColumn("g", near_dedup.group_of("d", 2))
    found = {(row.a, row.b) for row in near_dedup._prefix_pairs(texts, labels, 2, 85).collect()}
    assert {(2, 1), (3, 1)} <= found


# Hot groups, likelihood, plans ---------------------------------------------------------------------------------------------


def test_rows_without_an_id_are_dealt_over_groups(spark):
    """Twenty thousand texts without an id, and a hundred near copies among documents with one."""
    docs = spark.range(20_000).selectExpr(
        "cast(null as long) as doc_id", "concat_ws(' ', transform(sequence(1, 30), k -> concat('w', id, 'x', k))) as text")
    base = [f"b{k}" for k in range(120)]
    rows = [(k, " ".join(base[:k % 5] + [f"n{k}"] + base[k % 5 + 1:])) for k in range(100)]
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    texts = both.selectExpr("coalesce(doc_id, -9223372036854775808L) as d", "xxhash64(text) as v").withColumn(
        "g", near_dedup.group_of(["d", "v"], 50))
    assert texts.groupBy("g").count().agg({"count": "max"}).first()[0] < 800
    got = near_dedup.near_duplicates(both, groups=50).filter("doc_id is not null").collect()
    assert {row.doc_id: (row.n_shingles, row.component_id, row.kept) for row in got} == brute.components(rows)


def test_a_star_of_many_members(spark):
    """Five thousand copies of one text, each with a word of its own: one component, sets sent once a group."""
    base = [f"b{k}" for k in range(150)]
    docs = spark.range(5000).selectExpr("id as doc_id", f"concat('{' '.join(base)} own', id) as text").repartition(6)
    got = near_dedup.near_duplicates(docs, groups=13).collect()
    assert len(got) == 5000 and {row.component_id for row in got} == {0} and sum(row.kept for row in got) == 1


def test_unlikely_pairs_are_joined_exactly(spark, monkeypatch):
    """Where every estimate counts as unlikely, the prefixes find the same components."""
    source = random.Random(21)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for k in range(40):
        words = list(base)
        for _ in range(source.randrange(0, 6)):
            words[source.randrange(100)] = f"e{source.randrange(10 ** 9)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute.components(rows)
    assert _groups(near_dedup.near_duplicates(docs, groups=3)) == want
    monkeypatch.setattr(near_dedup, "DEVIATIONS", -100.0)
    monkeypatch.setattr(near_dedup, "FEW_IDS", 0)
    assert _groups(near_dedup.near_duplicates(docs, groups=3)) == want


def test_stage_at_another_similarity(spark):
    rows = []
    for number in range(20):
        base = [f"p{number}w{k}" for k in range(150)]
        rows += [(2 * number, " ".join(base)), (2 * number + 1, " ".join(_at(0.76 + 0.005 * number, base)))]
    docs = spark.createDataFrame([(*row, "x", 3) for row in rows], "doc_id long, text string, _row string, _first int")
    for percent in (80, 85):
        left = corpus_pipeline.near_dedup_stage(spark, docs, "", percent)
        assert left.columns == docs.columns
        assert sorted(row.doc_id for row in left.collect()) == sorted(
            doc for doc, one in brute.components(rows, percent).items() if one[2])


def test_mixing_plan_equals_a_plain_one(spark):
    """Passes and rests of every source as by a search of the exponent in small steps."""
    sizes = {"a": 50_000, "b": 9_000, "c": 9_000, "d": 400, "e": 0}
    for evenness, most in ((0.5, 1.5), (0.5, 40.0), (0.9, 40.0), (0.1, 3.0)):
        plan = mixing.plan_of(pd.DataFrame({"s": list(sizes), "tokens": list(sizes.values())}), None, most, None, evenness)
        want, exponent = brute.mixture(sizes, evenness, most)
        assert 0 < exponent < 1
        for row in plan.itertuples():
            assert abs(row.passes + row.rest / max(row.tokens, 1) - want[row.s]) < 5e-3
    rows = [(k, " ".join(["w"] * 10), "big" if k < 900 else "mid" if k < 980 else "low") for k in range(1000)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, source string, _s string, _cut int")
    got = mixing.mixed(docs, evenness=0.5, max_repeats=20.0).toPandas()
    want, _ = brute.mixture({"big": 9000, "mid": 800, "low": 200}, 0.5, 20.0)
    for name, own in got.groupby("source"):
        assert abs((own["n_tokens"] * own["copies"]).sum() / own["n_tokens"].sum() - want[name]) < 0.06
    assert {"_s", "_cut"} <= set(got.columns)


def test_rows_without_an_id_are_cut_one_by_one(spark):
    rows = [(None, f"text {k} " + "w " * 8, "small") for k in range(300)] + [(k, "w " * 10, "large") for k in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mixed(docs, max_repeats=1.5).toPandas()
    small = got[got["source"] == "small"]
    assert abs((small["n_tokens"] * small["copies"]).sum() / small["n_tokens"].sum() - 1.5) < 0.02


def test_plans_of_many_sources_are_joined(spark, monkeypatch):
    rows = [(k, "w " * (k % 7 + 1), f"s{k % 23}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(tuple, mixing.mixed(docs, evenness=0.5).collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 5)
    assert sorted(map(tuple, mixing.mixed(docs, evenness=0.5).collect())) == want


def test_top_k_prunes_from_the_first_chunk():
    """Many vectors of slowly falling norms in one chunk: most blocks are worked on for few pairs only."""
    source = np.random.default_rng(3)
    centers = source.integers(-200, 200, (30, 64))
    vectors = centers[source.integers(0, 30, 40_000)] + source.integers(-10, 10, (40_000, 64))
    search = topk.Search(np.arange(-50, 0), vectors[:50], 5)
    for first in range(0, 40_000, topk.CHUNK):
        search.add(np.arange(first, min(first + topk.CHUNK, 40_000)), vectors[first:first + topk.CHUNK])
    product = vectors[:50] @ vectors.T
    for k in range(50):
        best = np.lexsort((np.arange(40_000), -product[k]))[:5]
        assert search.found[k].tolist() == best.tolist()
    assert search.products < 0.6 * search.blocks


def test_plain_vectors_are_pruned_within_a_chunk():
    """Independent vectors, as in the given tables: pairs fall away before the last blocks."""
    source = np.random.default_rng(4)
    vectors = np.floor(256 * source.standard_normal((8192, 64))).astype(np.int64)
    search = topk.Search(np.arange(-64, 0), np.floor(256 * source.standard_normal((64, 64))).astype(np.int64), 5)
    for first in (0, 4096):
        search.add(np.arange(first, first + 4096), vectors[first:first + 4096])
    product = search.queries @ vectors.T
    for k in range(64):
        assert search.scores[k].tolist() == np.sort(product[k])[::-1][:5].tolist()
    assert search.products < search.blocks


def test_lean_packing_leaves_no_encoder_in_its_workers(spark, tmp_path):
    """Idle workers are taken in turn, so what one keeps after a task, all come to keep."""
    import shutil
    import sys

    path = str(shutil.copy(tokenizer_file(), tmp_path / "own.json"))
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    assert packing.pack_documents(docs.repartition(8), path, lean=True).count() == 40

    def kept(batches):
        for one in batches:
            module = sys.modules.get("_weirgate_worker")
            yield pa.RecordBatch.from_pydict({"n": [sum(path in key for key in module.__dict__ if isinstance(key, tuple))
                                                    if module else 0]})

    assert sum(row.n for row in spark.range(64).repartition(32).mapInArrow(kept, "n long").collect()) == 0


def test_pretokens_are_encoded_in_parts(monkeypatch):
    from weirgate.llm.pretokens import Encoder

    text = " ".join(f"w{k} x{k % 7}é" for k in range(3000))
    monkeypatch.setattr(Encoder, "TOGETHER", 50, raising=False)
    encoder, held = Encoder(tokenizer_file()), []
    encode = encoder.tokenizer.encode
    encoder.tokenizer = type("Counted", (), {"encode": lambda self, some, **how: held.append(len(some)) or encode(some, **how),
                                             "pre_tokenizer": encoder.tokenizer.pre_tokenizer})()
    ids = encoder.encode(pa.array([text, None, "", text]))[0].tolist()
    plain = encode(text, add_special_tokens=False).ids
    assert ids == plain + plain and max(held) == 50


def test_pipeline_stages_send_small_batches(spark, monkeypatch, tmp_path):
    """A stage's own jobs take batches of about a megabyte, not whole partitions; the session's setting comes back."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    texts = [(k, f"{k} " + "some words of a text " * 500) for k in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}

    def watched(name):
        def sizes(batches):
            yield pa.RecordBatch.from_pydict({"size": [rows.nbytes for rows in batches]})

        def operator(rows, *_, **named):
            seen[name] = [row.size for row in rows.select("doc_id", "text").mapInArrow(sizes, "size long").collect()]
            return rows.select(F.col(named["id_column"]).alias("doc_id"), F.col(named["id_column"]).alias("component_id")) \
                if "id_column" in named else rows

        monkeypatch.setattr(corpus_pipeline, name, operator)

    for name in ("kept_rows", "near_duplicates", "pack_documents"):
        watched(name)
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.near_dedup_stage, corpus_pipeline.packing_stage):
        assert stage(spark, docs, str(tmp_path)).count() == len(texts)
    total = sum(len(text) for _, text in texts)
    assert set(seen) == {"kept_rows", "near_duplicates", "pack_documents"}
    for sizes in seen.values():
        assert sum(sizes) >= total > 5 * corpus_pipeline.BATCH and max(sizes) < 2 * corpus_pipeline.BATCH
    assert spark.conf.get(setting) == before


def test_batch_setting_comes_back(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    other = spark.newSession()
    other.conf.unset(setting)
    with pytest.raises(ZeroDivisionError), arrow_batches(other, 5000):
        assert other.conf.get(setting).rstrip("b") == "5000"
        raise ZeroDivisionError
    assert other.conf.get(setting, None) is None
    other.conf.set(setting, "70000")
    with arrow_batches(other, 5000):
        pass
    assert other.conf.get(setting) == "70000"


def _noted(monkeypatch, module, name, folder):
    """``module.name`` leaves a file in the folder for each call, named by the bytes of its texts."""
    plain, place = getattr(module, name), str(folder)

    def noted(texts, *given):
        import pathlib
        import uuid

        pathlib.Path(place, f"{texts.nbytes}-{uuid.uuid4().hex}").touch()
        return plain(texts, *given)

    monkeypatch.setattr(module, name, noted)
    return lambda: [int(one.name.split("-")[0]) for one in folder.iterdir()]


@pytest.mark.parametrize("module, name", [(quality, "measures"), (near_dedup, "shingles")])
def test_work_on_words_takes_small_slices(spark, monkeypatch, tmp_path, module, name):
    """The arrays of a slice weigh tens of times its text, and two workers of an executor hold them at a time."""
    docs = spark.createDataFrame([(k, f"{k} " + "some words of a text " * 200, "en") for k in range(400)],
                                 "doc_id long, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    sizes = _noted(monkeypatch, module, name, tmp_path)
    rows = quality.kept_rows(docs, labels) if module is quality else near_dedup.near_duplicates(docs, groups=40)
    rows.write.format("noop").mode("overwrite").save()
    assert sum(sizes()) > 4 * SMALL_PIECE and max(sizes()) < 1.2 * SMALL_PIECE


def test_memory_goes_back_after_bytes_of_groups(monkeypatch):
    """A task of few groups hands back what they took; many small groups do so from time to time."""
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    large, small = pa.table({"text": ["x" * SMALL_PIECE]}), pa.table({"text": ["x"]})
    one, two = common.by_groups(lambda table: table), common.by_groups(lambda left, right: right)
    assert one(large) is large and two(large, small) is small and len(calls) == 2
    for _ in range(128):
        one(small)
    assert len(calls) == 4


def test_reading_a_tokenizer_hands_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(pretokens, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(pretokens, "_kept", lambda kept={}: kept)
    assert pretokens.encoder(tokenizer_file()) is pretokens.encoder(tokenizer_file()) and calls == [1]


def test_prefix_sets_are_made_in_one_job(spark, monkeypatch, tmp_path):
    """The sets are made for their counts and for their order, not again for the shingles of several components."""
    base = [f"b{k}" for k in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:98] + [f"y{k}" for k in range(6)])), (3, " ".join(f"z{k}" for k in range(104)))]
    texts = spark.createDataFrame(rows, "d long, text string").withColumn("g", F.lit(0).cast("long"))
    labels = spark.createDataFrame([(k, k) for k in (1, 2, 3)], "d long, component long")
    sizes = _noted(monkeypatch, near_dedup, "sets", tmp_path)
    found = {(row.a, row.b) for row in near_dedup._prefix_pairs(texts, labels, 1, 85).collect()}
    assert found == {(2, 1)} and len(sizes()) <= 2
