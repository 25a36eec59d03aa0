"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are normalised, so a cosine is a distance. A hash is a Gaussian projection, shifted and quantised into cells of ``WIDTH``; some
hashes make a table's bucket, and there are as many tables as it takes for a pair at the least cosine to share no bucket with a
probability of at most ``MISSED`` (closer pairs: far less). How many hashes make a bucket follows from the number of vectors: about
``ROOM`` unrelated (orthogonal) vectors share one. Projections are sums of integers below 2**53, so equal vectors have equal buckets
wherever they are computed.

Equal vectors are one class. Classes in small buckets (up to ``SMALL``) are compared with each other, those in larger ones with the bucket's most
central member. Signs of further projections, carried with the bucket rows, keep pairs whose angle is far too wide from
fetching vectors. Large buckets whose members are not all connected by then are compared in blocks, and
give a spanning forest of their links. That makes components. A link between two components would have met in a bucket,
so the numbers of links are counted inside components: small ones by their pairs, large ones in pairs of blocks of ``BLOCK`` classes,
whose products stay in the task and give one row per class. So no group of copies or near copies becomes a list of its pairs.
The comparisons of a component still grow with its square; that is what counting all links asks for.

Cosines are computed in double precision from the given components. Null vectors, those with null or non-finite components, and
zero or empty vectors link with nothing. Shorter vectors count as padded with zeros. A null id is the smallest id and given back as null;
rows that share an id are vectors of their own. One row for each row given; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirgate.llm.common import NO_ID, batch, real_id
from weirgate.llm.components import components
from weirgate.llm.kernels import mix, signed
from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage

COSINE, MISSED = 0.9, 0.005
WIDTH, ROOM, SEED = 2.5, 1.0, 29
SMALL, BLOCK, BATCH = 8, 512, 1024
#: Sign bits of a vector, and the share of pairs at the least cosine that they may keep from being compared.
SIGNS, MISSED_BY_SIGNS = 128, 1e-7
#: Grids of the normalised components and of the projections' coefficients: sums of products are exact.
FINE, COARSE = 1 << 20, 1 << 12


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that two vectors at this distance have equal hashes."""
    ratio = width / distance
    below = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def tables_for(count: int, cosine: float = COSINE, missed: float = MISSED) -> tuple[int, int]:
    """Hashes in a bucket, and tables."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    near = same_cell(max(math.sqrt(2 - 2 * cosine), 1e-6))
    hashes = max(math.ceil(math.log(max(count / ROOM, 1.0)) / -math.log(same_cell(math.sqrt(2)))), 1)
    return hashes, max(math.ceil(math.log(missed) / math.log1p(-near ** hashes)), 1)


def most_signs(cosine: float = COSINE, missed: float = MISSED_BY_SIGNS) -> int:
    """Differing sign bits up to which a pair may have the least cosine."""
    part = math.acos(min(cosine, 1.0)) / math.pi
    left = 0.0
    for k in range(SIGNS + 1):
        left += math.comb(SIGNS, k) * part ** k * (1 - part) ** (SIGNS - k)
        if 1 - left <= missed:
            return k
    return SIGNS


def _gauss(number: int, count: int, dims: int) -> np.ndarray:
    """Integer coefficients of the projections of table ``number``; the first ones do not depend on ``dims``."""
    rows = [np.random.default_rng([SEED, number, k]).standard_normal(dims) for k in range(count)]
    return np.rint(np.array(rows).T * COARSE)


def _shifts(number: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    source = np.random.default_rng([SEED, number, 1 << 20])
    return (np.floor(source.random(count) * WIDTH * FINE * COARSE),
            source.integers(1, 1 << 63, count).astype(np.uint64) * np.uint64(2) + np.uint64(1))


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors on the grid, as whole numbers."""
    return np.rint(vectors / np.linalg.norm(vectors, axis=1, keepdims=True) * FINE)


class Hashing:
    """The tables' buckets and the sign bits of vectors."""

    def __init__(self, hashes: int, tables: int):
        self.hashes, self.tables, self.dims, self.made = hashes, tables, 0, []

    def _prepare(self, dims: int) -> None:
        if dims > self.dims:
            self.dims = dims
            self.made = [_gauss(t, self.hashes, dims) for t in range(self.tables)]
            self.signs = _gauss(1 << 24, SIGNS, dims)
            self.cells = [_shifts(t, self.hashes) for t in range(self.tables)]

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """The bucket of every vector in every table."""
        dims = units.shape[1]
        self._prepare(dims)
        out = np.empty((len(units), self.tables), np.uint64)
        for t in range(self.tables):
            shift, factor = self.cells[t]
            cell = np.floor((units @ self.made[t][:dims] + shift) / (WIDTH * FINE * COARSE)).astype(np.int64)
            key = (cell.view(np.uint64) * factor).sum(axis=1, dtype=np.uint64)
            out[:, t] = mix(key ^ mix(np.full(1, t + 1, np.uint64)))
        return out

    def sign_bits(self, units: np.ndarray) -> np.ndarray:
        self._prepare(units.shape[1])
        bits = units @ self.signs[:units.shape[1]] > 0
        return np.packbits(bits, axis=1).view(np.uint64)


def matrix(raw: list[bytes]) -> np.ndarray:
    """Vectors of doubles as rows, padded with zeros."""
    if len({len(one) for one in raw}) <= 1:
        return np.frombuffer(b"".join(raw)).reshape(len(raw), -1)
    out = np.zeros((len(raw), max(len(one) for one in raw) // 8))
    for k, one in enumerate(raw):
        out[k, :len(one) // 8] = np.frombuffer(one)
    return out


def _read(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Valid vectors as bytes of doubles, scaled by a power of two so that no square leaves the range, and a digest."""
    column = rows.column("v")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    sizes = np.nan_to_num(sizes.astype(float)).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # a null component becomes nan
    ends = np.cumsum(sizes)
    vectors, keys = [], []
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        own = values[a:b]
        most = np.abs(own).max(initial=0.0)
        if not 0 < most < np.inf:  # not for nan either
            vectors.append(None)
            keys.append(None)
            continue
        own = np.trim_zeros(np.ldexp(own, -int(np.frexp(most)[1])) + 0.0, "b")
        vectors.append(own.tobytes())
        keys.append(hashlib.blake2b(vectors[-1], digest_size=16).digest())
    return batch(d=rows.column("d"), key=pa.array(keys, pa.binary()), v=pa.array(vectors, pa.binary()))


def _over(frame: DataFrame, work, schema: str) -> DataFrame:
    """``frame`` through ``work`` in slices of a bounded number of rows."""

    def run(batches):
        for rows in batches:
            for first in range(0, rows.num_rows, BATCH):
                yield work(rows.slice(first, BATCH))

    return frame.mapInArrow(run, schema)


def _hashed(hashes: int, tables: int):
    hashing = Hashing(hashes, tables)

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        units = normalised(matrix(rows.column("v").to_pylist()))
        signs = hashing.sign_bits(units)
        each = lambda values: np.repeat(values, tables)
        return batch(bucket=signed(hashing.buckets(units).ravel()), node=each(rows.column("node").to_numpy()),
                     low=signed(each(signs[:, 0])), high=signed(each(signs[:, 1])))

    return work


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of the rows of two matrices, pair by pair."""
    dims = max(left.shape[1], right.shape[1])
    left, right = (np.pad(one, ((0, 0), (0, dims - one.shape[1]))) for one in (left, right))
    return np.einsum("ij,ij->i", left, right) / (np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1))


def _linked(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Those of ``pairs`` (``a, b``) that are links, with the sizes of both classes."""
    one = classes.select(F.col("node").alias("a"), F.col("v").alias("v_a"), F.col("m").alias("m_a"))
    two = classes.select(F.col("node").alias("b"), F.col("v").alias("v_b"), F.col("m").alias("m_b"))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        if not rows.num_rows:
            return rows.select(["a", "b", "m_a", "m_b"])
        good = cosines(matrix(rows.column("v_a").to_pylist()), matrix(rows.column("v_b").to_pylist())) >= cosine
        return rows.select(["a", "b", "m_a", "m_b"]).filter(pa.array(good))

    return _over(pairs.join(one, "a").join(two, "b").select("a", "b", "m_a", "m_b", "v_a", "v_b"), work,
                 "a long, b long, m_a long, m_b long")


def _in_blocks(members: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """``members`` dealt into blocks of their group and from there to all pairs of blocks (``i`` at most ``j``); ``own``
    is the block of a row."""
    blocks = F.ceil(F.col(size) / F.lit(block)).cast("int")
    dealt = (members.withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return dealt.select(group, "node", "own", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places of the rows of both blocks, the vectors, and whether it is one block with itself."""
    own = table.column("own").to_numpy()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    vectors = matrix(table.column("v").to_pylist())
    return np.flatnonzero(own == i), np.flatnonzero(own == j), vectors, i == j


def _block_links(left: np.ndarray, right: np.ndarray, vectors: np.ndarray, same: bool, cosine: float):
    """Links between two blocks: stretch by stretch, as (places of a stretch of ``left``, their links with ``right``)."""
    norms = np.linalg.norm(vectors, axis=1)
    for first in range(0, len(left), BATCH):
        some = left[first:first + BATCH]
        mask = vectors[some] @ vectors[right].T >= cosine * norms[some][:, None] * norms[right][None, :]
        if same:
            mask &= some[:, None] != right[None, :]
        yield some, mask


def _forest(cosine: float):
    """Links of a pair of blocks, as few as connect what they connect."""

    def work(table: pa.Table) -> pa.Table:
        left, right, vectors, same = _sides(table)
        label = np.arange(table.num_rows)
        held = [(some, *np.nonzero(mask)) for some, mask in _block_links(left, right, vectors, same, cosine)]
        a = np.concatenate([some[row] for some, row, _ in held]) if held else label[:0]
        b = np.concatenate([right[col] for _, _, col in held]) if held else label[:0]
        while True:  # labels sink to the smallest of each component
            least = label.copy()
            np.minimum.at(least, a, label[b])
            np.minimum.at(least, b, label[a])
            least = least[least]
            if (least == label).all():
                break
            label = least
        some = np.flatnonzero(label != np.arange(len(label)))
        node = table.column("node").to_numpy()
        return pa.table({"a": pa.array(node[some]), "b": pa.array(node[label[some]])})

    return work


def _counted(cosine: float):
    """Vectors linked with each class of a pair of blocks."""

    def work(table: pa.Table) -> pa.Table:
        left, right, vectors, same = _sides(table)
        m, n = table.column("m").to_numpy(), np.zeros(table.num_rows, np.int64)
        for some, mask in _block_links(left, right, vectors, same, cosine):
            n[some] += mask @ m[right]
            if not same:
                n[right] += m[some] @ mask
        return pa.table({"node": table.column("node"), "n": pa.array(n)})

    return work


def _connected(classes: DataFrame, spread: DataFrame, cosine: float, small: int, block: int) -> DataFrame:
    """Components of the classes (``node, component``) by links in the buckets."""
    full = one_per_key(spread, ["bucket"], F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = cut_lineage(spread.join(full, "bucket"))
    weight = one_per_key(members, ["node"], F.sum("members").alias("weight"))
    central = (members.join(weight, "node").groupBy("bucket")
               .agg(F.max_by(F.struct("node", "low", "high"), F.struct("weight", -F.col("node"))).alias("center")))
    few = members.filter(F.col("members") <= small).select("bucket", "node", "low", "high")
    named = lambda frame, end: frame.select("bucket", *[F.col(c).alias(f"{c}_{end}") for c in ("node", "low", "high")])
    met = named(few, "a").join(named(few, "b"), "bucket").filter("node_a > node_b").drop("bucket")
    star = (members.filter(F.col("members") > small).join(central, "bucket").filter("node != center.node")
            .select(*[F.col(c).alias(f"{c}_a") for c in ("node", "low", "high")],
                    *[F.col(f"center.{c}").alias(f"{c}_b") for c in ("node", "low", "high")]))
    differ = F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b")))
    pairs = (met.unionByName(star).filter(differ <= most_signs(cosine))
             .select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct())
    links = cut_lineage(_linked(pairs, classes, cosine).select("a", "b"))
    nodes = cut_lineage(components(links))
    labelled = (members.filter(F.col("members") > small).join(nodes, "node", "left")
                .select("bucket", "node", "members", F.coalesce("component", "node").alias("component")))
    mixed = one_per_key(labelled, ["bucket"], F.min("component").alias("least"), F.max("component").alias("most")).filter(
        "least != most").select("bucket")
    open_ = _in_blocks(labelled.join(mixed, "bucket", "left_semi"), "bucket", "members", block)
    more = cut_lineage(open_.join(classes.select("node", "v"), "node").groupBy("bucket", "i", "j")
                       .applyInArrow(_forest(cosine), "a long, b long"))
    return cut_lineage(components(links.unionByName(more)))


def _link_counts(classes: DataFrame, nodes: DataFrame, cosine: float, small: int, block: int) -> DataFrame:
    """``node, n``: vectors of other classes that each class of a component is linked with."""
    sizes = one_per_key(nodes, ["component"], F.count(F.lit(1)).alias("members"))
    sized = cut_lineage(nodes.join(sizes, "component"))
    few = sized.filter(F.col("members") <= small).select("component", "node")
    pairs = (few.select("component", F.col("node").alias("a")).join(few.select("component", F.col("node").alias("b")), "component")
             .filter("a > b").select("a", "b"))
    links = _linked(pairs, classes, cosine)
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("m_b").alias("n")),
                             F.struct(F.col("b").alias("node"), F.col("m_a").alias("n"))))
    dealt = _in_blocks(sized.filter(F.col("members") > small), "component", "members", block)
    many = (dealt.join(classes.select("node", "m", "v"), "node").groupBy("component", "i", "j")
            .applyInArrow(_counted(cosine), "node long, n long"))
    return links.select(ends.alias("end")).select("end.node", "end.n").unionByName(many).groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, missed: float = MISSED, id_column: str = "vec_id",
                           vector_column: str = "embedding", small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    given = vectors.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("d"),
                           F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    read = cut_lineage(_over(given, _read, "d long, key binary, v binary"))
    held = read.filter("key is not null").groupBy("key").agg(F.min("d").alias("d"), F.count(F.lit(1)).alias("m"),
                                                             F.any_value("v").alias("v"))
    classes = cut_lineage(held.withColumn("node", F.monotonically_increasing_id()))
    hashes, tables = tables_for(classes.count(), cosine, missed)
    spread = _over(classes.select("node", "v"), _hashed(hashes, tables), "bucket long, node long, low long, high long")
    nodes = _connected(classes, spread, cosine, small, block)
    counts = _link_counts(classes, nodes, cosine, small, block)
    labels = classes.select("node", "key", "d", "m").join(nodes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = one_per_key(labels, ["component"], F.min("d").alias("c"))
    known = (labels.join(least, "component").join(counts, "node", "left")
             .select("key", "c", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n")))
    done = read.select("d", "key").join(one_per_key(known, ["key"], F.min("c").alias("c"), F.min("n").alias("n")), "key", "left")
    done = done.withColumn("c", F.coalesce("c", "d"))
    return done.select(real_id().alias("vec_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                       real_id("c").alias("component_id"), (F.col("d") == F.col("c")).alias("kept"))


def op12_vector_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
WITH RECURSIVE valid AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_aggregate(CAST(embedding AS DOUBLE[]), 'max') < 'infinity'
      AND list_aggregate(CAST(embedding AS DOUBLE[]), 'min') > '-infinity'
      AND (list_aggregate(CAST(embedding AS DOUBLE[]), 'max') > 0 OR list_aggregate(CAST(embedding AS DOUBLE[]), 'min') < 0)),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM valid a JOIN valid b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
    SELECT vec_id AS x, vec_id AS y FROM embeddings
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links,
       (SELECT min(y) FROM reach WHERE x = vec_id) AS component_id,
       vec_id = (SELECT min(y) FROM reach WHERE x = vec_id) AS kept
FROM embeddings
"""
