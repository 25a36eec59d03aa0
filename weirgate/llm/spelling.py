"""Spelling variants grouped under their most frequent neighbour: Bloom-guided neighbourhoods.

Words of the corpus are counted on the JVM, with partial sums before the shuffle. For each word of the vocabulary the edits that
remove one code point, or replace one by a larger one, are generated as hashes only, from prefix sums of a position-wise polynomial. (The
other edits are the same pairs seen from the other word.) Each hash is looked up in a blocked Bloom filter of the vocabulary's words of that
length; only the few that hit are spelled out and shuffled to an exact join with the vocabulary, which removes the false
positives. So 460 edits of a ten-letter word cost array look-ups and about as many rows as it has neighbours.

The filters are sharded by length and, beyond ``SHARD_WORDS`` words of a length, by hash. They are built by tasks, and broadcast in waves of
at most ``WAVE_BYTES``: a larger vocabulary means more waves of the same size, not a larger broadcast. Bits per word grow with the length,
since longer words have more edits; a word's expected number of false positives stays below one.

A word's form is its near word of largest count, if that is ``RATIO`` times its own. Counts grow by that factor along a chain of
forms, so chains are short and pointer doubling finds the roots in a few joins.

Null texts have no words; a null id counts as the empty string where the id takes part. Words of any length and any code points
of the pattern are compared whole. Repeated rows count each time. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirgate.llm.common import batch, documents, mapped
from weirgate.llm.kernels import mix
from weirgate.session import cut_lineage

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
#: What a word can hold once A-Z are in lower case.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint32)
LEAST_LENGTH, LEAST_COUNT, RATIO, SLIP = 6, 5, 5, 199

#: Words in a filter, bytes of filters in a wave, lengths from which on all share their shards, words a probing task has.
SHARD_WORDS, WAVE_BYTES, LONG, TASK_WORDS = 1 << 20, 64 << 20, 64, 1 << 14
PROBES = 6
STEP, TURN, SALT = np.uint64(0x9E3779B97F4A7C15), 0xD1342543DE82EF95, np.uint64(0xBF58476D1CE4E5B9)
#: Edits looked up at a time.
TOGETHER = 1 << 20


def counted_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_length: int = LEAST_LENGTH,
                  least_count: int = LEAST_COUNT, slip: int | None = SLIP) -> DataFrame:
    """``word, n``: runs of letters with A-Z in lower case. Where ``slip`` divides a run's checksum, one code point falls out
    (a reproducible typing slip)."""
    given = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("d"),
                        F.explode(F.regexp_extract_all(F.col(f"`{text_column}`").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    capitals = "".join(chr(65 + k) for k in range(26))
    ascii_only = F.octet_length("run") == F.length("run")
    lower = F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", capitals, capitals.lower()))
    if slip is None:
        words = given.select(lower.alias("word"))
    else:
        runs = given.select("d", lower.alias("run")).filter(F.length("run") >= least_length)
        check = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
        at = (F.col("check") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        words = runs.withColumn("check", check).select(
            F.when(F.col("check") % slip == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= least_count))


class Words:
    """The code points of a batch of words, and the pieces that hashes of their edits are made of."""

    def __init__(self, words: list[str]):
        joined = "".join(words)
        self.points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.size = np.array([len(word) for word in words], np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(self.size)))
        self.owner = np.repeat(np.arange(len(words)), self.size)
        self.place = np.arange(len(self.points)) - self.bounds[:-1][self.owner]
        self.power = _powers(TURN, int(self.size.max(initial=0)) + 1)
        terms = values_of(self.points) * self.power[self.place]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        self.before = sums[:-1] - sums[self.bounds[:-1]][self.owner]
        self.through = self.before + terms
        self.whole = sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def hashes(self) -> np.ndarray:
        return finished(self.whole, self.size)

    def shorter(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the words without the code points ``at``."""
        back = np.uint64(pow(TURN, -1, 1 << 64))
        rest = (self.whole[self.owner[at]] - self.through[at]) * back
        return finished(self.before[at] + rest, self.size[self.owner[at]] - 1)

    def replaced(self, at: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Hashes of the words with the code points ``at`` replaced."""
        change = (values_of(points) - values_of(self.points[at])) * self.power[self.place[at]]
        return finished(self.whole[self.owner[at]] + change, self.size[self.owner[at]])


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def values_of(points: np.ndarray) -> np.ndarray:
    return mix((points.astype(np.uint64) + np.uint64(1)) * STEP)


def finished(sums: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(mix(sums) + size.astype(np.uint64) * SALT)


def shard_of(size: np.ndarray) -> np.ndarray:
    return np.minimum(size, LONG)


def _blocks(words: int, longest: int) -> int:
    """Blocks of 512 bits for so many words."""
    return max(words * min(16 + longest // 4, 64) // 512, 0) + 1


def _bits(hashes: np.ndarray, blocks: np.ndarray):
    """The block of each hash, and its bits there one after the other."""
    block = ((hashes >> np.uint64(32)) * blocks.astype(np.uint64)) >> np.uint64(32)
    inner = mix(hashes * SALT)
    return block.astype(np.int64), [((inner >> np.uint64(9 * k)) & np.uint64(511)) for k in range(PROBES)]


def bloom(hashes: np.ndarray, blocks: int) -> np.ndarray:
    """A filter of distinct words."""
    block, places = _bits(hashes, np.array([blocks], np.uint64))
    out = np.zeros(blocks * 8, np.uint64)
    for place in places:
        np.bitwise_or.at(out, block * 8 + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


class Filters:
    """Some of the shards' filters in one array."""

    def __init__(self, parts: np.ndarray, held: list[tuple[int, int, bytes]]):
        """``parts`` has the number of filters of each shard; ``held`` the filters as (shard, part, bits)."""
        self.parts = parts
        self.first = np.concatenate(([0], np.cumsum(parts)))[:-1]
        total = int(parts.sum())
        self.base, self.blocks = np.zeros(total + 1, np.int64), np.zeros(total + 1, np.int64)
        arrays, place = [], 0
        for shard, part, bits in held:
            number = self.first[shard] + part
            array = np.frombuffer(bits, np.uint64)
            self.base[number], self.blocks[number] = place, len(array) // 8
            arrays.append(array)
            place += len(array)
        self.bits = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)

    def plain(self) -> tuple[np.ndarray, ...]:
        """What is broadcast."""
        return self.parts, self.first, self.base, self.blocks, self.bits

    @classmethod
    def of(cls, plain: tuple[np.ndarray, ...]) -> Filters:
        made = cls.__new__(cls)
        made.parts, made.first, made.base, made.blocks, made.bits = plain
        return made

    def hits(self, hashes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Places of the hashes (of words of these lengths) that the filters may hold."""
        shard = shard_of(size)
        number = self.first[shard] + part_of(hashes, self.parts[shard])
        some = np.flatnonzero((self.parts[shard] > 0) & (self.blocks[number] > 0))
        hashes, number = hashes[some], number[some]
        block, places = _bits(hashes, self.blocks[number])
        at = self.base[number] + block * 8
        alive = np.arange(len(some))
        for place in places:
            place = place[alive]
            word = self.bits[at[alive] + (place >> np.uint64(6)).astype(np.int64)]
            alive = alive[(word >> (place & np.uint64(63))) & np.uint64(1) == 1]
        return some[alive]


def part_of(hashes: np.ndarray, parts: np.ndarray) -> np.ndarray:
    low = mix(hashes + STEP) & np.uint64((1 << 32) - 1)
    return ((low * parts.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def found_edits(words: list[str], filters: Filters, alphabet: np.ndarray = ALPHABET) -> tuple[list[int], list[str]]:
    """Edits that the filters may hold: the number of the word, and the edit spelled out."""
    if not words:
        return [], []
    made = Words(words)
    owner, spelled = [], []
    fresh = np.ones(len(made.points), bool)  # of equal neighbours, any one removed leaves the same word
    fresh[1:] = (made.points[1:] != made.points[:-1]) | (made.place[1:] == 0)
    at = np.flatnonzero(fresh)
    for first in range(0, len(at), TOGETHER):
        some = at[first:first + TOGETHER]
        some = some[filters.hits(made.shorter(some), made.size[made.owner[some]] - 1)]
        for k, place in zip(made.owner[some].tolist(), made.place[some].tolist()):
            owner.append(k)
            spelled.append(words[k][:place] + words[k][place + 1:])
    rows = max(TOGETHER // len(alphabet), 1)
    for first in range(0, len(made.points), rows):
        last = min(first + rows, len(made.points))
        row, letter = np.nonzero(alphabet[None, :] > made.points[first:last, None])
        row += first
        some = filters.hits(made.replaced(row, alphabet[letter]), made.size[made.owner[row]])
        row, letter = row[some], letter[some]
        for k, place, point in zip(made.owner[row].tolist(), made.place[row].tolist(), alphabet[letter].tolist()):
            owner.append(k)
            spelled.append(words[k][:place] + chr(point) + words[k][place + 1:])
    return owner, spelled


def _built(blocks: dict[int, int]):
    """One shard's filter from its words."""

    def work(table: pa.Table) -> pa.Table:
        hashes = Words(table.column("word").to_pylist()).hashes()
        shard, part = table.column("shard")[0].as_py(), table.column("part")[0].as_py()
        made = bloom(hashes, blocks[shard])
        return pa.table({"shard": pa.array([shard], pa.int32()), "part": pa.array([part], pa.int32()),
                         "bits": pa.array([made.tobytes()], pa.binary())})

    return work


def _placed(parts: np.ndarray):
    """The shard and part of each word."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        made = Words(rows.column("word").to_pylist())
        shard = shard_of(made.size)
        return batch(word=rows.column("word"), shard=shard.astype(np.int32),
                     part=part_of(made.hashes(), parts[shard]).astype(np.int32))

    return work


def near_pairs(vocabulary: DataFrame, alphabet: np.ndarray = ALPHABET, shard_words: int = SHARD_WORDS,
               wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """``word, n, other, m``: all pairs of words that differ by one inserted, deleted or replaced code point, once each.
    ``vocabulary`` holds distinct words as ``word, n``."""
    spark = vocabulary.sparkSession
    shard = F.least(F.length("word"), F.lit(LONG))
    sizes = vocabulary.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("word")).alias("longest"))
    parts, blocks = np.zeros(LONG + 1, np.int64), {}
    for row in sizes.collect():  # at most LONG + 1 rows
        parts[row.shard] = -(-row.n // shard_words)
        blocks[row.shard] = _blocks(-(-row.n // int(parts[row.shard])), row.longest)
    words = vocabulary.repartition(max(int(sum(parts) * shard_words // TASK_WORDS) if parts.max() > 1 else 1,
                                       -(-vocabulary.count() // TASK_WORDS)))
    waves, room = [], 0
    for one in np.flatnonzero(parts).tolist():
        for part in range(int(parts[one])):
            need = blocks[one] * 64
            if not waves or room + need > wave_bytes:
                waves.append([])
                room = 0
            waves[-1].append((one, part))
            room += need
    placed = mapped(words.select("word"), _placed(parts), "word string, shard int, part int", "word")
    found = []
    for wave in waves:
        low, high = wave[0], wave[-1]
        place = F.struct("shard", "part")
        some = placed.filter(place.between(F.struct(*map(F.lit, low)), F.struct(*map(F.lit, high))))
        made = some.groupBy("shard", "part").applyInArrow(_built(blocks), "shard int, part int, bits binary")
        sent = spark.sparkContext.broadcast(Filters(parts, [(r.shard, r.part, bytes(r.bits)) for r in made.collect()]).plain())

        def probe(rows: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            owner, spelled = found_edits(rows.column("word").to_pylist(), Filters.of(sent.value), alphabet)
            taken = pa.array(owner, pa.int64())
            return batch(word=rows.column("word").take(taken), n=rows.column("n").take(taken), other=pa.array(spelled, pa.string()))

        # A wave's filters hold words of these lengths; words of these and of one more have edits among them.
        near = words.filter(F.length("word").between(low[0], high[0] + 1) if high[0] < LONG else F.length("word") >= low[0])
        hits = mapped(near.select("word", "n"), probe, "word string, n long, other string", "word")
        pairs = hits.join(vocabulary.select(F.col("word").alias("other"), F.col("n").alias("m")), "other").select(
            "word", "n", "other", "m")
        found.append(pairs if len(waves) == 1 else cut_lineage(pairs))
        if len(waves) > 1:
            sent.unpersist()
    if not found:
        return vocabulary.select("word", "n", F.col("word").alias("other"), F.col("n").alias("m")).limit(0)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where the chain of forms ends. Chains must not return to themselves."""
    held = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        step = cut_lineage(held.join(further, "root", "left").select(
            "word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("moved")))
        held = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return held


def spelling_variants(vocabulary: DataFrame, ratio: int = RATIO, alphabet: np.ndarray = ALPHABET,
                      shard_words: int = SHARD_WORDS, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``vocabulary`` (``word, n``; words distinct)."""
    vocabulary = cut_lineage(vocabulary.select("word", "n"))
    pairs = cut_lineage(near_pairs(vocabulary, alphabet, shard_words, wave_bytes))
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"),
                                          F.col("n").alias("m")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best"))
    named = (vocabulary.join(best, "word", "left")
             .withColumn("form_n", F.expr(f"case when -best.less >= {ratio} * n then -best.less end"))
             .withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.form")))
             .select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
    named = cut_lineage(named)
    ends = roots(named.filter("form is not null").select("word", "form"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                   "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(counted_words(documents(spark, sf_dir)))
