"""Mixing sources by temperature: weights, and the passes over each source that realise them.

A source's weight is its share of tokens to the power ``exponent``, normalised. Weights get more even as the exponent
falls from 1 to 0, so both limits are met by bisection: ``target_entropy`` (in nats) asks for the largest exponent whose weights
have at least that entropy, ``max_repeats`` for the smallest exponent at which no source is passed over more often. The
repetition limit wins where they disagree. ``evenness`` states an entropy target by its place between that of the natural shares (0)
and that of an even mix (1).

The budget is by default what passes over the most used source of all exactly once, so no document is lost. A source with a
budget of r times its tokens is passed over floor(r) times as a whole, and once more over part of it: documents stand in a
random permutation given by a seeded hash, in blocks of its leading bits, and blocks are taken in turn until the
budget is spent; the last block is cut by its own sub-blocks, and those once more. Three steps of 4,096 blocks place the
cut within 2**-36 of a source; each step is a count by (source, block), so no task ever sees the documents of a source.

Null sources are one source of their own. Null and empty texts have no tokens and come with the whole passes of their source.
Repeated rows of a document are cut together; rows without an id stand where their texts put them. Extra columns are kept, whatever
their names. An empty table gives no rows.

The exponent needs the sources' token totals only, and of these only how many sources have each; one task finds it from that histogram.
The passes over each source follow from the exponent row by row.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirgate.llm.common import free_name
from weirgate.session import cut_lineage

MAX_REPEATS = 1.5
#: What the query and the pipeline ask for: half way from the natural to an even mix, as far as the repetition limit allows.
EVENNESS = 0.5
SEED = 17
#: The plan of up to so many sources is broadcast (below 8 MB); that of more is joined by a shuffle.
MAX_SOURCES = 100_000
BITS, STEPS = 12, 3

WORD = "[^\\x20\\x09-\\x0D]+"


def word_tokens(text_column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text_column}`"), F.lit(WORD)), F.lit(0)).cast("long")


def weights_at(tokens: list[int], exponent: float, counts: list[int] | None = None) -> list[float]:
    """Weight of each source; with ``counts``, of each of so many sources with equal tokens."""
    most = max(tokens)
    raised = [(one / most) ** exponent if one else 0.0 for one in tokens]
    whole = math.fsum(one * n for one, n in zip(raised, counts or [1] * len(tokens)))
    return [one / whole for one in raised]


def entropy(weights: list[float], counts: list[int] | None = None) -> float:
    return -math.fsum(n * one * math.log(one) for one, n in zip(weights, counts or [1] * len(weights)) if one > 0)


def _bisect(holds, low: float = 0.0, high: float = 1.0) -> float:
    """The largest exponent at which ``holds``, which holds at ``low`` if anywhere."""
    if holds(high):
        return high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def repeats_at(tokens: list[int], exponent: float, budget: float | None, counts: list[int] | None = None) -> list[float]:
    """Passes over each source; without a budget, the one with the fewest is passed over once."""
    weights = weights_at(tokens, exponent, counts)
    per_token = [weight / one if one else 0.0 for weight, one in zip(weights, tokens)]
    whole = budget if budget is not None else 1.0 / min(one for one in per_token if one)
    return [whole * one for one in per_token]


def exponent_for(tokens: list[int], target_entropy: float | None, max_repeats: float | None,
                 budget: float | None = None, counts: list[int] | None = None, evenness: float | None = None) -> float:
    exponent = 1.0 if max_repeats is None else 0.0
    if evenness is not None:
        natural, even = (entropy(weights_at(tokens, x, counts), counts) for x in (1.0, 0.0))
        target_entropy = natural + evenness * (even - natural)
    if target_entropy is not None:
        exponent = _bisect(lambda x: entropy(weights_at(tokens, x, counts), counts) >= target_entropy)
    if max_repeats is not None:
        least = 1.0 - _bisect(lambda x: max(repeats_at(tokens, 1.0 - x, budget, counts)) <= max_repeats)
        exponent = max(exponent, least)
    return exponent


def plan_of(shares: pd.DataFrame, target_entropy: float | None, max_repeats: float | None,
            budget: float | None, evenness: float | None = None) -> pd.DataFrame:
    """Whole passes and the tokens of the last, partial one for each source of ``shares`` (``s, tokens``)."""
    shares = shares.sort_values("s", na_position="first", ignore_index=True)
    histogram = shares.groupby("tokens", as_index=False).size().rename(columns={"size": "n"})
    return _passes(shares, _repeats_of(histogram, target_entropy, max_repeats, budget, evenness))


def _repeats_of(histogram: pd.DataFrame, target_entropy, max_repeats, budget, evenness) -> pd.DataFrame:
    """``tokens, weight, repeats`` from how many sources (``n``) have each number of tokens."""
    histogram = histogram.sort_values("tokens", ignore_index=True)
    tokens, counts = [int(one) for one in histogram["tokens"]], [int(one) for one in histogram["n"]]
    if not any(tokens):
        return histogram[["tokens"]].assign(weight=0.0, repeats=1.0)
    exponent = exponent_for(tokens, target_entropy, max_repeats, budget, counts, evenness)
    return histogram[["tokens"]].assign(weight=weights_at(tokens, exponent, counts), repeats=repeats_at(tokens, exponent, budget, counts))


def _passes(shares: pd.DataFrame, repeats: pd.DataFrame) -> pd.DataFrame:
    shares = shares.merge(repeats, on="tokens", how="left") if "repeats" not in shares else shares
    held, wanted = [int(one) for one in shares["tokens"]], list(shares["repeats"])
    passes = [int(math.floor(one + 1e-12)) if tokens else 1 for one, tokens in zip(wanted, held)]
    rest = [min(max(int((one - whole) * tokens), 0), max(tokens - 1, 0)) for one, whole, tokens in zip(wanted, passes, held)]
    return shares.assign(passes=passes, rest=rest)


def mixed(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
          budget: float | None = None, seed: int = SEED, source_column: str = "source", id_column: str = "doc_id",
          text_column: str = "text", tokens_as: str = "n_tokens", copies_as: str = "copies",
          evenness: float | None = None) -> DataFrame:
    """``docs`` with the document's tokens and with how often the mixture holds it. The names of these two columns must
    not be in ``docs``."""
    told = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.concat(F.lit("text "), F.xxhash64(F.col(f"`{text_column}`"))))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), told,
                                            F.col(f"`{source_column}`").cast("string")), 64 - BITS * STEPS)
    source = F.col(f"`{source_column}`").cast("string")
    known = cut_lineage(docs.select(source.alias("s"), place.alias("place"), word_tokens(text_column).alias("tokens")))

    def fit(histogram: pd.DataFrame) -> pd.DataFrame:
        return _repeats_of(histogram, target_entropy, max_repeats, budget, evenness)[["tokens", "repeats"]]

    def spread(batches):
        for some in batches:
            if len(some):
                yield _passes(some, some)[["s", "passes", "rest"]]

    shares = cut_lineage(known.groupBy("s").agg(F.sum("tokens").alias("tokens")))
    repeats = shares.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).groupBy(F.lit("all").alias("all")).applyInPandas(
        fit, "tokens long, repeats double")
    cut = (shares.join(repeats, "tokens").select("s", "tokens", "repeats").mapInPandas(spread, "s string, passes long, rest long")
           .withColumn("cut", F.lit(0).cast("long")))
    few = shares.count() <= MAX_SOURCES
    sent = F.broadcast if few else lambda frame: frame
    for step in range(STEPS):
        low = BITS * (STEPS - 1 - step)
        inside = known.join(sent(cut), known["s"].eqNullSafe(cut["s"])).drop(known["s"])
        # Only the block that the cut falls into is looked at again.
        inside = inside.filter(F.shiftright("place", low + BITS) == F.shiftright("cut", low + BITS))
        blocks = (inside.withColumn("block", F.shiftright("place", low))
                  .groupBy("s", "passes", "rest", "block").agg(F.sum("tokens").alias("tokens")))
        upto = F.sum("tokens").over(Window.partitionBy("s").orderBy("block"))
        blocks = blocks.withColumn("upto", upto)
        # Blocks that fit as a whole are taken; the first that does not fit is cut in the next step.
        taken = F.coalesce(F.sum(F.when(F.col("upto") <= F.col("rest"), F.col("tokens"))), F.lit(0))
        first = F.coalesce(F.min(F.when(F.col("upto") > F.col("rest"), F.col("block"))), F.max("block") + 1)
        cut = (blocks.groupBy("s", "passes", "rest").agg(taken.alias("taken"), first.alias("first"))
               .select("s", "passes", (F.col("rest") - F.col("taken")).alias("rest"),
                       F.shiftleft("first", low).alias("cut")))
    s_, passes, at = free_name([*docs.columns, tokens_as, copies_as], "_s"), *(
        free_name([*docs.columns, tokens_as, copies_as], name) for name in ("_passes", "_cut"))
    ends = cut.select(F.col("s").alias(s_), F.col("passes").alias(passes), F.col("cut").alias(at))
    joined = docs.join(sent(ends), source.eqNullSafe(F.col(s_)), "left")
    copies = F.coalesce(passes, F.lit(1)) + (place < F.coalesce(at, F.lit(0))).cast("long")
    return (joined.withColumn(tokens_as, word_tokens(text_column)).withColumn(copies_as, copies.cast("int"))
            .drop(s_, passes, at))


def realised(mixture: DataFrame, tokens_as: str = "n_tokens", copies_as: str = "copies") -> DataFrame:
    """Each document as often as the mixture holds it, without the columns added by ``mixed``."""
    columns = [name for name in mixture.columns if name not in (tokens_as, copies_as)]
    copies = F.explode(F.array_repeat(F.lit(0), F.col(f"`{copies_as}`")))
    return mixture.withColumn(free_name(mixture.columns, "_copy"), copies).select(*[F.col(f"`{name}`") for name in columns])


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    found = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), evenness=EVENNESS)
    return found.select("doc_id", "source", "n_tokens", "copies")
