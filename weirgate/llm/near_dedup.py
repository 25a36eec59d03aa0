"""Near-duplicate documents by SetSketch registers.

A document is the set of its ``words``-word shingles (lower-cased A-Z; shorter texts count as one shingle). Each of the
``REGISTERS`` registers is the truncated logarithm, in base ``BASE``, of the smallest exponential value that its hash gives to
the shingles: registers of a union are maxima of registers, and two documents agree in a register about as often as their
similarity says. Documents with equal sets are one class and go on as one. Some registers make a band; classes that agree in a
band share a bucket. How many make a band, and if need be how many registers there are, follows from the least similarity asked
for: there a pair shares no bucket with a probability of at most ``MISSED``.

Within a bucket not all pairs are looked at. Small buckets (up to ``SMALL``) give all their pairs, larger ones give pairs with
their most central member, the one with the fullest buckets. For each pair the similarity is estimated by maximum likelihood from the
numbers of larger, smaller and equal registers and both set sizes, and says in which order pairs are compared on full sets: first those
whose estimate is not ``DEVIATIONS`` standard deviations below the threshold, then, of the others, those that are not in one
component by then. Each set is sent once to every group of documents that it is compared in. What remains are
members of large buckets that are not connected yet. These are joined exactly by
prefixes: with shingles ordered from the rarest, two sets can only be similar enough if they share a shingle so early in
both orders that the required overlap is still within reach. Members whose rare shingles are their own meet nobody, so a group of thousands of copies
costs few pairs. No pair is dropped for the size of its group or for its estimate.

Null and empty texts have no shingles and are linked with nothing. A null id counts as the smallest id. Rows that share an id
are one document: linked if any version is; its versions (by their texts) are dealt out like other documents. One row for
each row given; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from weirgate.llm.common import SMALL_PIECE, batch, by_groups, documents, id_and_text, mapped, real_id
from weirgate.llm.components import components, extended
from weirgate.llm.kernels import flat, lower_ascii, mix, range_hashes, rolling_hashes, signed, words
from weirgate.llm.passages import as_table, group_count, ids_of, rows_at, text_of, versions_of
from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage

WORDS, PERCENT = 5, 85
REGISTERS, SMALL = 64, 8
#: Most that a pair at the least similarity may be missed with.
MISSED = 1e-5
BASE, RATE, MOST = 1.001, 20.0, 65_535

#: Standard deviations that an estimate may lie below the threshold.
DEVIATIONS = 5.0

_SKETCH = "d long, v long, n long, low long, high long, registers binary"


def _hashes(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of the registers' hashes."""
    number = np.arange(1, count + 1, dtype=np.uint64)
    return (mix(number * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1),
            mix((number + np.uint64(100)) * np.uint64(0xD1342543DE82EF95)))


def banding(percent: float) -> tuple[int, int]:
    """Registers in a band and bands: the widest bands that miss few enough pairs at the least similarity."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    least = percent / 100
    for rows in (4, 3, 2):
        if (1 - least ** rows) ** (REGISTERS // rows) <= MISSED:
            return rows, REGISTERS // rows
    return 1, max(REGISTERS, math.ceil(math.log(MISSED) / math.log1p(-least)))


def shingles(texts: pa.Array, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, repeats included, and the bounds of each text's."""
    data, offsets = flat(texts)
    starts, ends, bounds = words(data, offsets)
    hashes = range_hashes(lower_ascii(data), starts, ends)
    count = np.diff(bounds)
    own = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    limits = np.concatenate(([0], np.cumsum(own)))
    out = np.empty(limits[-1], np.uint64)
    long = np.repeat(count >= width, own)
    if long.any():
        owner = np.repeat(np.arange(len(own)), own)[long]
        place = np.flatnonzero(long) - limits[owner] + bounds[owner]
        out[long] = rolling_hashes(hashes, width)[place]
    short = np.flatnonzero((count > 0) & (count < width))
    out[limits[short]] = range_hashes(hashes, bounds[short], bounds[short + 1])
    return out, limits


def sets(texts: pa.Array, width: int = WORDS) -> list[np.ndarray]:
    every, limits = shingles(texts, width)
    return [np.unique(every[a:b]) for a, b in zip(limits[:-1].tolist(), limits[1:].tolist())]


def registers(every: np.ndarray, limits: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """Registers of the texts that have shingles, a row each."""
    starts = limits[:-1][np.diff(limits) > 0]
    least = np.empty((len(starts), count), np.uint64)
    multipliers, addends = _hashes(count)
    for k in range(count if len(starts) else 0):
        least[:, k] = np.minimum.reduceat(every * multipliers[k] + addends[k], starts)
    value = -np.log1p(-np.minimum((least.astype(float) + 0.5) / 2.0 ** 64, 1.0 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1.0 - np.log(value) / np.log(BASE)), 0, MOST).astype(np.uint16)


def _sketches(size: int):
    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        every, limits = shingles(rows.column("text"))
        count, low, high = (np.zeros(rows.num_rows, kind) for kind in (np.int64, np.uint64, np.uint64))
        for k, (a, b) in enumerate(zip(limits[:-1].tolist(), limits[1:].tolist())):
            own = np.unique(every[a:b])
            count[k] = len(own)
            low[k] = mix(own).sum(dtype=np.uint64)
            high[k] = np.bitwise_xor.reduce(mix(own * np.uint64(3))) if b > a else 0
        made = iter(registers(every, limits, size))
        values = [next(made).tobytes() if held else None for held in np.diff(limits).tolist()]
        return batch(d=rows.column("d"), v=rows.column("v"), n=count, low=signed(low), high=signed(high),
                     registers=pa.array(values, pa.binary()))

    return work


def likely_similarity(larger, smaller, equal, left, right) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from the numbers of larger, smaller and equal registers and the set sizes."""
    u = (left / (left + right))[:, None]
    v = 1.0 - u
    grid = np.linspace(0.0, 1.0, 201)[None, :] * np.minimum(u / v, v / u)
    share = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    above, below = share(u - v * grid), share(v - u * grid)
    tiny = 1e-300
    value = (larger[:, None] * np.log(np.maximum(above, tiny)) + smaller[:, None] * np.log(np.maximum(below, tiny))
             + equal[:, None] * np.log(np.maximum(1.0 - above - below, tiny)))
    return grid[np.arange(len(grid)), np.argmax(value, axis=1)]


def _estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``pairs`` with their most likely similarity, from the registers of both ends."""

    def end(name: str) -> DataFrame:
        return reps.select(F.col("d").alias(f"{name}d"), F.col("v").alias(f"{name}v"), F.col("n").alias(f"{name}n"),
                           F.col("registers").alias(f"{name}r"))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        likely = np.empty(rows.num_rows)
        for first in range(0, rows.num_rows, 512):
            some = rows.slice(first, 512)
            left, right = (np.frombuffer(b"".join(some.column(f"{name}r").to_pylist()), np.uint16).reshape(some.num_rows, -1)
                           for name in "ab")
            sizes = [some.column(f"{name}n").to_numpy().astype(float) for name in "ab"]
            numbers = [(relation(left, right)).sum(axis=1).astype(float) for relation in (np.greater, np.less, np.equal)]
            likely[first:first + some.num_rows] = likely_similarity(*numbers, *sizes)
        return batch(**{name: rows.column(name) for name in ENDS}, likely=likely)

    met = pairs.join(end("a"), ["ad", "av"]).join(end("b"), ["bd", "bv"])
    return mapped(met.select(*ENDS, "an", "bn", "ar", "br"), work, f"{_ENDS}, likely double", "ar")


#: The ends of a pair: id and version of both.
ENDS = ["ad", "av", "bd", "bv"]
_ENDS = "ad long, av long, bd long, bv long"

#: Texts up to this number (below 20 MB as a hash table) are named to the scan by a broadcast, to keep others out of a shuffle.
FEW_IDS = 200_000


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` without some that ``ids`` (``d, v``, distinct) do not ask for: all of these where the ids are few, else
    none. What is done with the texts is the same either way."""
    return texts.join(F.broadcast(ids), ["d", "v"], "left_semi") if ids.count() <= FEW_IDS else texts


def _ends_of(pairs: DataFrame) -> DataFrame:
    return (pairs.select(F.col("ad").alias("d"), F.col("av").alias("v"))
            .union(pairs.select("bd", "bv")).distinct())


def _wanted_texts(left: pa.Table, right: pa.Table, names: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts of the group that rows of ``right`` name, as (number of the text, number of the row)."""
    return rows_at(right.rename_columns(["d" if one == names[0] else "v" if one == names[1] else one for one in right.column_names]),
                   ids_of(left), versions_of(left))


_SENT = f"g long, {_ENDS}, shingles binary"


def _set_rows(g, ad, av, shingles) -> pa.Table:
    none = pa.nulls(len(ad), pa.int64())
    return pa.table({"g": pa.array(g, pa.int64()), "ad": pa.array(ad, pa.int64()), "av": pa.array(av, pa.int64()), "bd": none, "bv": none,
                     "shingles": pa.array(shingles, pa.binary())})


def confirmed(pairs: DataFrame, texts: DataFrame, groups: int, percent: float = PERCENT) -> DataFrame:
    """Those of ``pairs`` (``ad, av, bd, bv``) whose full sets are similar enough. ``texts`` (``d, v, text, g``) are in so many
    groups by id and version."""
    pairs = cut_lineage(pairs)
    if pairs.isEmpty():  # nothing to compare: no text is read
        return pairs
    texts = _only(texts, _ends_of(pairs))
    to = group_of(["bd", "bv"], groups).alias("g")

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        """Sets of the first ends, once for each group that has a second end."""
        if not left.num_rows or not right.num_rows:
            return _set_rows([], [], [], [])
        owner, row = _wanted_texts(left, right, ("ad", "av"))
        _, first = np.unique(row, return_index=True)  # equal texts are one
        owner, row = owner[first], row[first]
        used, place = np.unique(owner, return_inverse=True)
        made = [one.tobytes() for one in sets(text_of(left).take(pa.array(used)))]
        return _set_rows(right.column("to").to_numpy()[row], right.column("ad").to_numpy()[row], right.column("av").to_numpy()[row],
                         [made[k] for k in place.tolist()])

    def compared(left: pa.Table, right: pa.Table) -> pa.Table:
        """Pairs whose second end is here, with the sets that arrived."""
        arrived = right.filter(pc.is_valid(right.column("shingles"))) if right.num_rows else right
        asked = right.filter(pc.is_null(right.column("shingles"))) if right.num_rows else right
        if not left.num_rows or not asked.num_rows:
            return asked.slice(0, 0).select(ENDS)
        firsts = {(d, v): np.frombuffer(one, np.uint64) for d, v, one in
                  zip(*(arrived.column(name).to_pylist() for name in ("ad", "av", "shingles")))}
        owner, row = _wanted_texts(left, asked, ("bd", "bv"))
        used, place = np.unique(owner, return_inverse=True)
        own = sets(text_of(left).take(pa.array(used)))
        good = np.zeros(asked.num_rows, bool)
        ends = list(zip(asked.column("ad").to_pylist(), asked.column("av").to_pylist()))
        for k, number in zip(place.tolist(), row.tolist()):
            one, two = firsts.get(ends[number]), own[k]
            if one is None:
                continue
            common = len(np.intersect1d(one, two, assume_unique=True))
            good[number] = common > 0 and 100 * common >= percent * (len(one) + len(two) - common)
        return asked.filter(pa.array(good)).select(ENDS)

    wanted = pairs.select(group_of(["ad", "av"], groups).alias("g"), "ad", "av", to.alias("to")).distinct()
    arriving = texts.groupBy("g").cogroup(wanted.groupBy("g")).applyInArrow(by_groups(sent), _SENT)
    asked = pairs.select(to, *ENDS, F.lit(None).cast("binary").alias("shingles"))
    return texts.groupBy("g").cogroup(arriving.unionByName(asked).groupBy("g")).applyInArrow(by_groups(compared), _ENDS)


def group_of(columns: str | list[str], groups: int) -> Column:
    return F.pmod(F.xxhash64(*([columns] if isinstance(columns, str) else columns)), F.lit(groups))


def _prefix_pairs(texts: DataFrame, labels: DataFrame, groups: int, percent: float) -> DataFrame:
    """Pairs of ``labels`` (``d, component``, and ``v`` where texts have versions) in different components that can be similar
    enough, by their rarest shingles: ``a, av, b, bv``. Each distinct set of an id counts once, as a version of its own."""
    key = ["d", "v"] if "v" in labels.columns else ["d"]

    def sent(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = pa.array([], pa.int64())
            return as_table(batch(d=none, v=none, component=none, size=pa.array([], pa.int32()), shingle=none))
        owner, row = rows_at(right, ids_of(left), versions_of(left) if "v" in key else None)
        made = sets(text_of(left).take(pa.array(owner)))
        d = right.column("d").to_numpy()
        first = {}
        for k, one in enumerate(made):
            first.setdefault((int(d[row[k]]), one.tobytes()), k)
        kept = np.array(list(first.values()), np.int64)
        made, row = [made[k] for k in kept.tolist()], row[kept]
        version = right.column("v").to_numpy()[row] if "v" in key else np.arange(len(made), dtype=np.int64)
        count = np.array([len(one) for one in made])
        values = np.concatenate(made) if len(made) else np.zeros(0, np.uint64)
        return as_table(batch(d=np.repeat(d[row], count), v=np.repeat(version, count),
                              component=np.repeat(right.column("component").to_numpy()[row], count),
                              size=np.repeat(count, count).astype(np.int32), shingle=signed(values)))

    tokens = texts.groupBy("g").cogroup(labels.withColumn("g", group_of(key, groups)).groupBy("g")).applyInArrow(
        by_groups(sent), "d long, v long, component long, size int, shingle long")
    counts = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    # The place of a shingle in the order of its set, from the rarest on; only places that can matter go on.
    ordered = tokens.join(counts, "shingle").groupBy("d", "v", "component", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("order"))
    reach = F.expr(f"size - cast(ceil({percent} * size / 100D) as int) + 1")
    held = ["d", "v", "component", "size", "place"]
    placed = ordered.select(*held[:-1], F.posexplode(F.slice("order", F.lit(1), reach)).alias("place", "own"))
    one = cut_lineage(placed.filter("own.n > 1").select(*held, F.col("own.shingle").alias("shingle")))  # sets are made and ordered once
    # For each shingle the component with most rows, its main one, does not meet itself: of a pair, x is outside it.
    rows = one.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("rows"))
    several = cut_lineage(rows.groupBy("shingle").agg(
        F.max_by("component", F.struct("rows", "component")).alias("main"), F.count(F.lit(1)).alias("kinds"))
        .filter("kinds > 1").select("shingle", "main"))
    one = cut_lineage(one.join(several, "shingle"))
    x = one.filter("component != main").select("shingle", "main", *[F.col(name).alias(f"x_{name}") for name in held])
    y = one.select("shingle", *[F.col(name).alias(f"y_{name}") for name in held])
    overlap = f"cast(ceil({percent} * (x_size + y_size) / {100 + percent}D) as int)"
    met = x.join(y, "shingle").filter(
        f"x_component != y_component and (y_component = main or x_d < y_d or (x_d = y_d and x_v < y_v)) "
        f"and x_place <= x_size - {overlap} and y_place <= y_size - {overlap}")
    one, two = (F.struct(F.col(f"{end}_d").alias("d"), F.col(f"{end}_v").alias("v")) for end in "xy")
    ends = met.select(F.least(one, two).alias("low"), F.greatest(one, two).alias("high")).distinct()
    return ends.select(F.col("high.d").alias("a"), F.col("high.v").alias("av"), F.col("low.d").alias("b"), F.col("low.v").alias("bv"))


def _candidates(members: DataFrame, small: int) -> DataFrame:
    """Pairs of members of one bucket: all of a small one's, those with the most central member of a larger one."""
    few = members.filter(F.col("members") <= small).select("bucket", "d", "v")
    named = lambda frame, end: frame.select("bucket", F.col("d").alias(f"{end}d"), F.col("v").alias(f"{end}v"))
    met = named(few, "a").join(named(few, "b"), "bucket").filter("ad > bd").select(*ENDS)
    # The most central member of a bucket: the one whose buckets hold most in all. Its set goes to the others' groups.
    weight = members.groupBy("d", "v").agg(F.sum("members").alias("weight"))
    central = (members.join(weight, ["d", "v"]).groupBy("bucket")
               .agg(F.max_by(F.struct("d", "v"), F.struct("weight", -F.col("d"), "v")).alias("center")))
    star = (members.filter(F.col("members") > small).join(central, "bucket").filter("d != center.d")
            .select(F.col("center.d").alias("ad"), F.col("center.v").alias("av"), F.col("d").alias("bd"), F.col("v").alias("bv")))
    return met.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, percent: float = PERCENT, id_column: str = "doc_id", text_column: str = "text",
                    groups: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row."""
    groups = groups or group_count(docs)
    rows, count = banding(percent)
    texts = id_and_text(docs, id_column, text_column).withColumn("v", F.xxhash64("text"))
    sketched = cut_lineage(mapped(texts.select("d", "v", "text"), _sketches(rows * count), _SKETCH, limit=SMALL_PIECE))
    texts = texts.withColumn("g", group_of(["d", "v"], groups))
    key = ["n", "low", "high"]
    # A class of copies may be large: reduced apart, so that the joins with its members can be split.
    classes = one_per_key(sketched.filter("n > 0"), key, F.min(F.struct("d", "v")).alias("rep"), F.any_value("registers").alias("registers"))
    reps = cut_lineage(classes.select("rep.d", "rep.v", "n", "registers"))
    bands = [F.xxhash64(F.lit(k), F.substring("registers", 2 * rows * k + 1, 2 * rows)) for k in range(count)]
    spread = reps.select("d", "v", F.explode(F.array(*bands)).alias("bucket"))
    full = one_per_key(spread, ["bucket"], F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = cut_lineage(spread.join(full, "bucket"))
    least = percent / 100
    margin = least - DEVIATIONS * math.sqrt(least * (1 - least) / (rows * count))
    pairs = cut_lineage(_estimated(_candidates(members, SMALL), reps))
    linked = lambda some: confirmed(some.select(*ENDS), texts, groups, percent).select(
        F.col("ad").alias("a"), F.col("bd").alias("b"))
    links = cut_lineage(linked(pairs.filter(F.col("likely") >= margin)))
    nodes = cut_lineage(components(links))
    # Unlikely pairs come second, and only those that are not in one component by now.
    known = [nodes.select(F.col("node").alias(f"{end}d"), F.col("component").alias(f"{end}c")) for end in "ab"]
    apart = (pairs.filter(F.col("likely") < margin).join(known[0], "ad", "left").join(known[1], "bd", "left")
             .filter(F.coalesce("ac", "ad") != F.coalesce("bc", "bd")))
    nodes = cut_lineage(extended(nodes, cut_lineage(linked(apart))))
    part = F.coalesce("component", "d").alias("component")
    labelled = (members.filter(F.col("members") > SMALL).join(nodes, F.col("d") == F.col("node"), "left")
                .select("bucket", "d", "v", part))
    mixed = (one_per_key(labelled, ["bucket"], F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low != high").select("bucket"))
    rest = cut_lineage(labelled.join(mixed, "bucket", "left_semi").select("d", "v", "component").distinct())
    some = _only(texts, rest.select("d", "v").distinct())
    found = _prefix_pairs(some, rest, groups, percent).withColumnsRenamed({"a": "ad", "b": "bd"})
    more = cut_lineage(confirmed(found, some, groups, percent).select(F.col("ad").alias("a"), F.col("bd").alias("b")))
    final = extended(nodes, more)
    done = (sketched.select("d", *key).join(classes.select(*key, F.col("rep.d").alias("rep")), key, "left")
            .join(final, F.col("rep") == F.col("node"), "left")
            .withColumn("c", F.coalesce("component", "rep", "d")))
    return done.select(real_id().alias("doc_id"), F.col("n").alias("n_shingles"), real_id("c").alias("component_id"),
                       (F.col("d") == F.col("c")).alias("kept"))


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
