"""How quality filters interact: what each removes at each place of every order they can be applied in.

One pass of a table-driven transducer over the UTF-8 bytes of a text counts words, capitals, code points and symbols. Its two
states (between words, in a word) and five byte classes index ``NEXT`` and ``EMIT``; an emission says whether a word opens or closes
and what else the byte counts for. ``NEXT`` does not depend on the state it leaves, so the states of a whole stretch are one table
look-up and the machine runs over arrays. The word spans go into an open hash table whose hits are verified byte for
byte: spans of one document with equal bytes share an entry, whatever their hashes.

The filters: A: under 100 words; B: under 80 distinct words in 100; C: over 10 capitals (A-Z) in 100 code points; D: any of the symbols;
E: the text of a smaller id. A document becomes a mask of the filters it fails, and only counts by (part, mask, labels) go on, at
most 128 a part. How many of these have no bit of a set S in common gives everything else: a filter that follows the
filters S removes what passes S less what passes S and the filter.

Scale: texts are read once and not shuffled; 16-byte digests with ids are. Rows with one digest are first reduced by (digest, part, mask,
labels, id) and then by all but the id, so a text that a third of all documents share is spread over its ids.

Null text is empty: it has no words and is the same text as other empty ones. A null id is the smallest id; rows with equal id and text
do not count as copies of each other. The part of a null is the empty string. A document is good (toxic) if any label row of its
id says 1; null ids have no labels. Extra columns are ignored. An empty table has no parts and so gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirgate.llm.common import NO_ID, batch, documents, mapped
from weirgate.llm.kernels import CHUNK, WHITE, flat, mix, range_hashes
from weirgate.operators.keys import one_per_key

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10

# Byte classes, states and emissions of the transducer.
BLANK, CAPITAL, SYMBOL, LEAD, REST = range(5)
OUTSIDE, INSIDE = range(2)
OPENS, CLOSES, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16

CLASS = np.full(256, LEAD, np.uint8)
CLASS[0x80:0xC0] = REST
CLASS[65:91] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[WHITE] = BLANK
NEXT = np.array([[OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
EMIT = np.array([
    [IS_POINT, OPENS | IS_POINT | IS_CAPITAL, OPENS | IS_POINT | IS_SYMBOL, OPENS | IS_POINT, OPENS],
    [CLOSES | IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, IS_POINT, 0],
], np.uint8)


def transduced(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Capitals, code points and symbols of each text, and the spans of its words with the text each belongs to."""
    count = len(offsets) - 1
    out = {name: np.zeros(count, np.int64) for name in ("capitals", "points", "symbols")}
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True  # every text begins outside of words
    opens, closes, state = [], [], OUTSIDE
    for first in range(0, len(data), CHUNK):
        last = min(first + CHUNK, len(data))
        kind = CLASS[data[first:last]]
        after = NEXT[OUTSIDE][kind]
        before = np.empty_like(after)
        before[0], before[1:] = state, after[:-1]
        inside_at_end = np.flatnonzero(begins[first:last] & (before == INSIDE)) + first
        before[begins[first:last]] = OUTSIDE
        state = after[-1]
        said = EMIT[before, kind]
        opens.append(np.flatnonzero(said & OPENS) + first)
        closes += [np.flatnonzero(said & CLOSES) + first, inside_at_end]
        # Only the texts that this stretch touches.
        low = int(np.searchsorted(offsets, first, "right")) - 1
        high = int(np.searchsorted(offsets, last, "left"))
        edges = np.clip(offsets[low:high + 1], first, last) - first
        for name, mark in (("capitals", IS_CAPITAL), ("points", IS_POINT), ("symbols", IS_SYMBOL)):
            sums = np.concatenate(([0], np.cumsum((said & mark) != 0)))
            out[name][low:high] += np.diff(sums[edges])
    if state == INSIDE:
        closes.append(np.array([len(data)]))
    none = np.zeros(0, np.int64)
    out["starts"] = np.concatenate(opens) if opens else none
    out["ends"] = np.sort(np.concatenate(closes)) if closes else none
    out["owner"] = np.searchsorted(offsets, out["starts"], "right") - 1
    return out


#: Words longer than this are compared one by one, shorter ones in stretches of CHUNK bytes.
LONG_WORD = 4096


def same_bytes(data: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``data[left:left + size]`` equals ``data[right:right + size]``, for arrays of places; sizes above zero."""
    out = np.zeros(len(left), bool)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = np.array_equal(data[left[k]:left[k] + size[k]], data[right[k]:right[k] + size[k]])
    short = np.flatnonzero(size <= LONG_WORD)
    sums = np.concatenate(([0], np.cumsum(size[short])))
    place = 0
    while place < len(short):
        stop = max(int(np.searchsorted(sums, sums[place] + CHUNK, "right")) - 1, place + 1)
        some = short[place:stop]
        heads = sums[place:stop] - sums[place]
        inner = np.arange(int(sums[stop] - sums[place])) - np.repeat(heads, size[some])
        equal = data[np.repeat(left[some], size[some]) + inner] == data[np.repeat(right[some], size[some]) + inner]
        out[some] = np.logical_and.reduceat(equal, heads)
        place = stop
    return out


def first_of_its_kind(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray,
                      hashes: np.ndarray | None = None) -> np.ndarray:
    """Which spans are the first of their bytes in their document: those that get an entry of the hash table."""
    count = len(starts)
    first = np.zeros(count, bool)
    if not count:
        return first
    if hashes is None:
        hashes = range_hashes(data, starts, ends)
    hashes = mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    bits = max(int(2 * count - 1).bit_length(), 4)
    table = np.full(1 << bits, -1, np.int64)
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    size = ends - starts
    left = np.arange(count)
    while len(left):
        free = left[table[slot[left]] < 0][::-1]
        table[slot[free]] = free  # of several for one entry, the first span stays
        held = table[slot[left]]
        own = held == left
        first[left[own]] = True
        left, held = left[~own], held[~own]
        maybe = (hashes[left] == hashes[held]) & (owner[left] == owner[held]) & (size[left] == size[held])
        some = np.flatnonzero(maybe)
        maybe[some] = same_bytes(data, starts[left[some]], starts[held[some]], size[left[some]])
        left = left[~maybe]
        slot[left] = (slot[left] + 1) & (len(table) - 1)
    return first


def _masks(rows: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = flat(rows.column("text"))
    found = transduced(data, offsets)
    count = rows.num_rows
    n_words = np.bincount(found["owner"], minlength=count)
    fresh = first_of_its_kind(data, found["starts"], found["ends"], found["owner"])
    distinct = np.bincount(found["owner"][fresh], minlength=count)
    fails = (n_words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n_words,
             100 * found["capitals"] > MOST_CAPITALS * found["points"], found["symbols"] > 0)
    mask = sum(one.astype(np.int32) << k for k, one in enumerate(fails))
    digests = [hashlib.blake2b(data[a:b].data, digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return batch(d=rows.column("d"), part=rows.column("part"), mask=mask.astype(np.int32), n_words=n_words, n_distinct=distinct,
                 n_capitals=found["capitals"], n_points=found["points"], n_symbols=found["symbols"],
                 digest=pa.array(digests, pa.binary()))


_MEASURED = ("d long, part string, mask int, n_words long, n_distinct long, n_capitals long, n_points long, "
             "n_symbols long, digest binary")


def measured(docs: DataFrame, part_column: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts of every document, the mask of the filters A to D that it fails, and its text's digest."""
    given = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("d"),
                        F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    return mapped(given, _masks, _MEASURED)


def mask_counts(docs: DataFrame, labels: DataFrame, part_column: str = "lang", id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters they fail, all five, and their labels."""
    known = one_per_key(labels.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("d"), "quality", "toxic"),
                        ["d"], F.max((F.col("quality") == 1).cast("int")).alias("good"),
                        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flags = [F.coalesce(name, F.lit(0)).alias(name) for name in ("good", "toxic")]
    rows = (measured(docs, part_column, id_column, text_column).select("d", "part", "mask", "digest").join(known, "d", "left")
            .select("d", "part", "mask", "digest", *flags))
    kind = ["digest", "part", "mask", "good", "toxic"]
    each = rows.groupBy(*kind, "d").agg(F.count(F.lit(1)).alias("n"))
    kinds = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.struct("d", "n")).alias("least"))
    # A digest has at most a row for each part and label here.
    texts = kinds.groupBy("digest").agg(
        F.min("least.d").alias("d"), F.collect_list(F.struct("part", "mask", "good", "toxic", "n", "least")).alias("kinds"))
    one = texts.select("d", F.explode("kinds").alias("kind")).select("d", "kind.*")
    originals = F.when(F.col("least.d") == F.col("d"), F.col("least.n")).otherwise(F.lit(0))
    copy = 1 << FILTERS.index("E")
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), originals.alias("n")),
                             F.struct(F.col("mask").bitwiseOR(F.lit(copy)).alias("mask"), (F.col("n") - originals).alias("n"))))
    return (one.select("part", "good", "toxic", both.alias("row")).filter("row.n > 0")
            .groupBy("part", "row.mask", "good", "toxic").agg(F.sum("row.n").alias("n")))


def _passing(condition: Column | None = None) -> Column:
    """For every set of filters the documents that fail none of them."""
    n = F.col("n") if condition is None else F.when(condition, F.col("n")).otherwise(F.lit(0))
    return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(some)) == 0, n).otherwise(F.lit(0)))
                     for some in range(1 << len(FILTERS))])


def _shapley(k: int) -> Column:
    """What filter ``k`` removes, summed over all orders."""
    bit, others = 1 << k, len(FILTERS) - 1
    terms = []
    for some in range(1 << len(FILTERS)):
        if not some & bit:
            before = some.bit_count()
            orders = math.factorial(before) * math.factorial(others - before)
            terms.append(F.lit(orders) * (F.col("passing")[some] - F.col("passing")[some | bit]))
    return sum(terms[1:], terms[0])


def audit(docs: DataFrame, labels: DataFrame, part_column: str = "lang", id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """One row for each part, order of the filters and step in it: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``."""
    counts = mask_counts(docs, labels, part_column, id_column, text_column)
    parts = counts.groupBy("part").agg(_passing().alias("passing"), _passing(F.col("good") == 1).alias("good"),
                                       _passing(F.col("toxic") == 1).alias("toxic"))
    every = (1 << len(FILTERS)) - 1
    fixed = parts.withColumn("shapleys", F.array(*[_shapley(k) for k in range(len(FILTERS))]))
    orders = ["".join(one) for one in permutations(FILTERS)]
    steps = (fixed.withColumn("filter_order", F.explode(F.lit(orders)))
             .withColumn("step", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))))
             .withColumn("k", F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1")))
    earlier = F.expr("substring(filter_order, 1, step - 1)")
    before = sum((F.when(F.contains(earlier, F.lit(one)), F.lit(1 << k)).otherwise(F.lit(0)) for k, one in enumerate(FILTERS)),
                 F.lit(0))
    steps = (steps.withColumn("before", before).withColumn("bit", F.expr("shiftleft(1, k)"))
             .withColumn("after", F.expr("before | bit")))
    lost = lambda name: F.expr(f"{name}[before] - {name}[after]")
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), F.expr("passing[after]").alias("kept"),
        lost("passing").alias("removed"),
        (F.expr("passing[0] - passing[bit]") - lost("passing")).alias("redundant"),
        F.expr(f"passing[{every} - bit] - passing[{every}]").alias("unique_fails"), lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"), F.expr("shapleys[k]").alias("shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
first_ids AS (SELECT t, min(coalesce(doc_id, -9223372036854775808)) AS least FROM texts GROUP BY t),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
          FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
fails AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           {'A': len(w) < 100,
            'B': 100 * len(list_distinct(w)) < 80 * len(w),
            'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
            'D': regexp_matches(t, '[#$%&*|]'),
            'E': coalesce(doc_id, -9223372036854775808) > least} AS f
    FROM texts JOIN first_ids USING (t) LEFT JOIN known USING (doc_id)),
masks AS (
    SELECT part, good, toxic, concat(CASE WHEN f['A'] THEN 'A' ELSE '' END, CASE WHEN f['B'] THEN 'B' ELSE '' END,
           CASE WHEN f['C'] THEN 'C' ELSE '' END, CASE WHEN f['D'] THEN 'D' ELSE '' END,
           CASE WHEN f['E'] THEN 'E' ELSE '' END) AS bad, count(*) AS n
    FROM fails GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
found AS (
    SELECT part, filter_order, step, own, good, toxic, n, contains(bad, own) AS is_bad, bad = own AS only_own,
           length(translate(bad, earlier, '')) < length(bad) AS gone
    FROM masks, steps),
counted AS (
    SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT is_bad THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN NOT gone AND is_bad THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN gone AND is_bad THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN only_own THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN NOT gone AND is_bad AND good = 1 THEN n ELSE 0 END) AS good_lost,
           sum(CASE WHEN NOT gone AND is_bad AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
    FROM found GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""
