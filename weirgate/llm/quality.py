"""Quality rules with risk-controlled thresholds.

Five rule scores, in thousandths, are computed for every document: symbols per word, exclamation marks per word, capital
letters per character, repeated lines per line, and words in repeated 3-word windows. How unusual a score is follows from all
documents that pass the base rules, without their labels: its level is -100 log10 of the share of the stratum's documents that score at
least as high. A document's joint level under the first k rules is its highest level among them, so each k gives a sequence of
nested joint cutoffs that no label has a say in.

Labelled documents that pass the base rules serve as a holdout (nothing is fitted on them): for every stratum and k the joint cutoffs are
tested from the strictest on, and a cutoff is admitted while the exact binomial bound says that it rejects at most the part
``alpha`` of the good documents, all rules together. The walk stops at the first failure (fixed-sequence testing, so cutoffs need no correction);
the error level ``delta`` is divided by the number of strata and of sequences (Bonferroni). With probability ``1 - delta`` no stratum loses
more than ``alpha`` of its good documents. Among the admitted cutoffs of all sequences the one with the best balance of rejected
bad documents against ``price`` times the rejected good ones is taken, of equals that of the fewest rules, the strictest. Where the
labels do not suffice for a bound, nothing is rejected in that stratum.

Scale: one pass over texts for the scores, which are written without their texts and joined with the labels; ``kept_rows`` reads the
texts once more for its verdict.
Scores and labels are reduced to counts before anything meets: at most 1,001 a rule and stratum for the levels, and at most as many a sequence and
stratum for the choice, which is made stratum by stratum.

Null text is empty: no words, so the base rules reject it. Null strata form one stratum of their own. A document whose labels
contradict each other, or are null, is no holdout; rows that share an id share its label. One row for each row given; extra columns
are ignored, and kept as they are by ``kept_rows``, whatever their names. An empty table gives no rows, an empty one of labels certifies nothing.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weirgate.llm.common import NO_ID, SMALL_PIECE, batch, documents, free_name, mapped, pieces, real_id
from weirgate.llm.kernels import WHITE, flat, mix, range_hashes, rolling_hashes, windows, words
from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage

RULES = ("symbols", "exclamations", "capitals", "repeated_lines", "repeated_words")
ALPHA, DELTA, PRICE = 0.02, 0.05, 10.0
#: Cutoffs of up to so many strata are broadcast (below 2 MB); those of more are joined by a shuffle.
MAX_STRATA = 10_000
NEVER = 1001

_SCORES = ("d long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           + ", ".join(f"{rule} int" for rule in RULES))


def _marked(data: np.ndarray, characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table[data]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _again(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    every = np.sort(keys)
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    place = np.searchsorted(twice, keys)
    place[place == len(twice)] = 0
    return twice[place] == keys


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """Base measures and rule scores of a batch of texts."""
    data, offsets = flat(texts)
    starts, ends, bounds = words(data, offsets)
    count = np.diff(bounds)
    inside = ~WHITE[data] if len(data) else np.zeros(0, bool)
    lead = (data & 0xC0) != 0x80
    doc_of = np.repeat(np.arange(len(count)), count)
    # Lines with a word: the first word of each, and the line around it.
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, starts)
    heads = np.ones(len(starts), bool)
    heads[1:] = (line[1:] != line[:-1]) | (doc_of[1:] != doc_of[:-1])
    heads = np.flatnonzero(heads)
    begin, end = offsets[doc_of[heads]], offsets[doc_of[heads] + 1]
    if len(breaks):
        before, after = line[heads] - 1, np.minimum(line[heads], len(breaks) - 1)
        begin = np.where(before >= 0, np.maximum(begin, breaks[before] + 1), begin)
        end = np.where(line[heads] < len(breaks), np.minimum(end, breaks[after]), end)
    owner = doc_of[heads].astype(np.uint64)
    line_keys = mix(range_hashes(data, begin, end) + owner * np.uint64(0x9E3779B97F4A7C15))
    lines = np.bincount(doc_of[heads], minlength=len(count))
    distinct, first = np.unique(line_keys, return_index=True)
    del distinct
    dup_lines = lines - np.bincount(doc_of[heads][first], minlength=len(count))
    # Words in 3-word windows that occur again in the text.
    place, text = windows(bounds, 3)
    grams = rolling_hashes(range_hashes(data, starts, ends), 3)[place] if len(place) else np.zeros(0, np.uint64)
    again = place[_again(mix(grams + text.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))]
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[again + k] = True
    chars = _per_text(inside & lead, offsets)
    symbols = _per_text(_marked(data, b"#*$%&|<>"), offsets)
    repeat_words = np.diff(np.concatenate(([0], np.cumsum(covered)))[bounds])
    out = {"n_words": count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
           "n_repeat_words": repeat_words}
    parts = {"symbols": (symbols, count), "exclamations": (_per_text(data == 33, offsets), count),
             "capitals": (_per_text(_marked(data, bytes(range(65, 91))), offsets), chars),
             "repeated_lines": (dup_lines, lines), "repeated_words": (repeat_words, count)}
    for rule, (some, whole) in parts.items():
        out[rule] = np.minimum(1000 * some // np.maximum(whole, 1), 1000).astype(np.int32)
    return out


def scores(docs: DataFrame, stratum_column: str = "lang", id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Measures and rule scores of every document, whose stratum may be null."""
    given = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("d"),
                        F.col(f"`{stratum_column}`").cast("string").alias("stratum"),
                        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        return batch(d=rows.column("d"), stratum=rows.column("stratum"), **measures(rows.column("text")))

    return mapped(given, work, _SCORES, limit=SMALL_PIECE)


def most_rejected(count: int, part: float, level: float) -> int:
    """The largest number of rejected among ``count`` good documents for which the exact (Clopper-Pearson) upper bound at
    ``level`` is at most ``part``; -1 where even none rejected does not suffice."""
    most = min(int(count * part) + 1, count)
    k = np.arange(1, most + 1, dtype=float)
    steps = np.log((count - k + 1) / k) + math.log(part) - math.log1p(-part)
    terms = np.concatenate(([0.0], np.cumsum(steps))) + count * math.log1p(-part)
    tails = np.logaddexp.accumulate(terms)
    return int(np.searchsorted(tails, math.log(level), "right")) - 1


def best_cutoff(good: np.ndarray, bad: np.ndarray, most: int, price: float) -> tuple[float, int]:
    """Balance and score of the best cutoff that rejects at most so many good documents; ``good`` and ``bad`` are counts by score."""
    false, true = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    best, cutoff = 0.0, NEVER
    for score in range(NEVER - 1, 0, -1):
        if false[score] > most:
            break
        if true[score] - price * false[score] > best:
            best, cutoff = float(true[score] - price * false[score]), score
    return best, cutoff


def _by_score(own: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    good, bad = np.zeros(NEVER + 1, np.int64), np.zeros(NEVER + 1, np.int64)
    np.add.at(good, own["score"].to_numpy(), own["good"].to_numpy())
    np.add.at(bad, own["score"].to_numpy(), own["bad"].to_numpy())
    return good, bad


def cutoffs_of(counts: pd.DataFrame, alpha: float, delta: float, price: float) -> pd.DataFrame:
    """Cutoffs of one rule by itself, certified for a fifth of ``alpha``, from ``stratum, rule, score, good, bad``: a score
    from the cutoff on is rejected."""
    counts = counts.assign(key=counts["stratum"].map(lambda s: (s is not None, s)))
    strata, rows = counts["key"].nunique(), []
    for _, own in counts.groupby("key", sort=True):
        good, bad = _by_score(own)
        most = most_rejected(int(good.sum()), alpha / len(RULES), delta / (len(RULES) * strata))
        rows.append((own["stratum"].iloc[0], own["rule"].iloc[0], best_cutoff(good, bad, most, price)[1]))
    return pd.DataFrame(rows, columns=["stratum", "rule", "cutoff"])


def joint_cutoff(counts: pd.DataFrame, alpha: float, level: float, price: float) -> tuple[int, int]:
    """How many rules take part and the joint level from which a document is rejected, from one stratum's ``rules, score, good, bad``
    (the score is the joint level under the first ``rules`` rules; good documents at level 0 are counted, too)."""
    best, chosen = 0.0, (0, NEVER)
    for rules, own in counts.groupby("rules", sort=True):
        good, bad = _by_score(own)
        balance, cutoff = best_cutoff(good, bad, most_rejected(int(good.sum()), alpha, level), price)
        if balance > best:
            best, chosen = balance, (int(rules), cutoff)
    return chosen


def _strata(column: str = "stratum") -> Column:
    """A stratum as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def _levels(passed: DataFrame) -> DataFrame:
    """``key, rule, score, level`` for every score above zero."""
    pairs = F.explode(F.array(*[F.struct(F.lit(number).alias("rule"), F.col(rule).alias("score")) for number, rule in enumerate(RULES)]))
    counts = passed.select("key", pairs.alias("pair")).groupBy("key", "pair.rule", "pair.score").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("key", "rule")  # at most 1,001 rows
    share = F.sum("n").over(own.orderBy(F.desc("score"))) / F.sum("n").over(own)
    level = F.least(F.floor(-100 * F.log10(share)), F.lit(NEVER - 1)).cast("int")
    return counts.withColumn("level", level).filter("score > 0").select("key", "rule", "score", "level")


def cutoffs(scored: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
            price: float = PRICE) -> DataFrame:
    """``key`` (see ``_strata``) with one cutoff column a rule, for strata where something is rejected."""
    known = one_per_key(labels.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("d"), "quality"), ["d"],
                        F.min("quality").alias("quality"), F.max("quality").alias("high"), F.count("quality").alias("given"),
                        F.count(F.lit(1)).alias("rows")).filter(
        "quality = high and given = rows and quality in (0, 1)").select("d", "quality")
    passed = scored.filter(~_base_failed()).select("d", _strata().alias("key"), *RULES)
    levels = cut_lineage(_levels(passed))
    # Labelled documents by all their scores; then their levels, and the highest under the first rules.
    kinds = passed.join(known, "d").groupBy("key", *RULES).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
    pairs = F.explode(F.array(*[F.struct(F.lit(number).alias("rule"), F.col(rule).alias("score")) for number, rule in enumerate(RULES)]))
    each = kinds.withColumn("pair", pairs).select("key", *RULES, "good", "bad", "pair.rule", "pair.score")
    joined = each.join(levels, ["key", "rule", "score"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    highest = [F.max(F.when(F.col("rule") < k, F.col("level"))).alias(f"level_{k}") for k in range(1, len(RULES) + 1)]
    joint = joined.groupBy("key", *RULES, "good", "bad").agg(*highest)
    sequences = F.explode(F.array(*[F.struct(F.lit(k).alias("rules"), F.col(f"level_{k}").alias("score"))
                                    for k in range(1, len(RULES) + 1)]))
    counts = cut_lineage(joint.select("key", "good", "bad", sequences.alias("one")).groupBy("key", "one.rules", "one.score").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    level = delta / (len(RULES) * max(counts.select("key").distinct().count(), 1))

    def choose(table: pd.DataFrame) -> pd.DataFrame:
        rules, cutoff = joint_cutoff(table, alpha, level, price)
        return pd.DataFrame({"key": table["key"].iloc[:1], "rules": [rules], "cutoff": [cutoff]})

    chosen = counts.groupBy("key").applyInPandas(choose, "key string, rules int, cutoff int").filter(F.col("cutoff") < NEVER)
    rejected = levels.join(chosen, "key").filter("rule < rules and level >= cutoff")
    return cut_lineage(rejected.groupBy("key").agg(*[
        F.coalesce(F.min(F.when(F.col("rule") == number, F.col("score"))), F.lit(NEVER)).alias(f"cut_{rule}")
        for number, rule in enumerate(RULES)]))


def with_cutoffs(rows: DataFrame, limits: DataFrame, key: str) -> DataFrame:
    """``rows`` with the cutoffs of their stratum, null where nothing is rejected."""
    if limits.count() <= MAX_STRATA:
        return rows.join(F.broadcast(limits), key, "left")
    return rows.join(one_per_key(limits, [key], *[F.min(name).alias(name) for name in limits.columns if name != key]), key, "left")


def _base_failed(names: dict[str, str] | None = None) -> Column:
    words, repeats = ((names or {}).get(name, name) for name in ("n_words", "n_repeat_words"))
    return F.expr(f"`{words}` < 50 or 100 * `{repeats}` > 50 * `{words}`")


def _rejected_by(names: dict[str, str] | None = None) -> Column:
    held = names or {}
    return F.filter(F.array(*[
        F.when(F.col(held.get(rule, rule)) >= F.coalesce(F.col(held.get(f"cut_{rule}", f"cut_{rule}")), F.lit(NEVER)), F.lit(rule))
        for rule in RULES]), lambda name: name.isNotNull())


def judged(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, price: float = PRICE,
           stratum_column: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Measures, scores, ``base_failed``, the rules that reject (``rejected_by``) and ``kept`` of every document."""
    scored = cut_lineage(scores(docs, stratum_column, id_column, text_column))  # texts are read once
    limits = cutoffs(scored, labels, alpha, delta, price)
    with_limits = with_cutoffs(scored.withColumn("key", _strata()), limits, "key")
    return (with_limits.withColumn("base_failed", _base_failed()).withColumn("rejected_by", _rejected_by())
            .withColumn("kept", F.expr("not base_failed and size(rejected_by) = 0"))
            .select(real_id().alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "rejected_by", *RULES))


def kept_rows(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, price: float = PRICE,
              stratum_column: str = "lang", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, as they are."""
    needed = ("n_words", "n_repeat_words", *RULES)
    names, taken = {}, list(docs.columns)
    for name in (*needed, "key", *[f"cut_{rule}" for rule in RULES]):
        names[name] = free_name(taken, f"_q_{name}")
        taken.append(names[name])
    limits = cutoffs(cut_lineage(scores(docs, stratum_column, id_column, text_column)), labels, alpha, delta, price)
    limits = limits.withColumnsRenamed({name: names[name] for name in limits.columns})
    kinds = dict(one.split() for one in _SCORES.split(", "))
    place = docs.columns.index(text_column)

    def run(batches):
        for rows in pieces(batches, place, SMALL_PIECE):
            made = measures(rows.column(place))
            yield pa.RecordBatch.from_arrays([*rows.columns, *[pa.array(made[name]) for name in needed]],
                                             names=[*rows.schema.names, *[names[name] for name in needed]])

    schema = T.StructType([*docs.schema.fields, *[
        T.StructField(names[name], T.LongType() if kinds[name] == "long" else T.IntegerType()) for name in needed]])
    scored = docs.mapInArrow(run, schema)
    own = F.coalesce(F.concat(F.lit("="), F.col(f"`{stratum_column}`").cast("string")), F.lit(""))
    joined = with_cutoffs(scored.withColumn(names["key"], own), limits, names["key"])
    kept = joined.filter(~_base_failed(names) & (F.size(_rejected_by(names)) == 0))
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept")
