"""Which parts of two versions of a table differ, without joining what is equal.

Rows are dealt into buckets by their key. Each version gives two sums of row hashes and a count for each bucket, partial sums first, so only buckets
are shuffled; the sums of both versions are subtracted in one aggregate. Buckets form a tree: the sums of ``BRANCH`` neighbouring
buckets add up to those of their parent, and the tree is walked from the top, so a version that differs in few places opens few
nodes. Rows of buckets that differ are picked by a broadcast list of bucket numbers before any row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirgate.session import cut_lineage

BRANCH, LEVELS = 64, 3
#: Buckets that differ, at most, for a broadcast list; with more, most of the table differs and is joined whole.
MOST_OPEN = 65_536


def bucket_of(key: str, levels: int = LEVELS, branch: int = BRANCH) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(branch ** levels))


def bucket_sums(before: DataFrame, after: DataFrame, key: str, columns: list[str], levels: int = LEVELS,
                branch: int = BRANCH) -> DataFrame:
    """``bucket`` with the differences of the two hash sums and of the counts, for the lowest level."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        values = [F.col(key), *[F.col(name) for name in columns], *[F.col(name).isNull() for name in columns]]
        return rows.select(bucket_of(key, levels, branch).alias("bucket"), F.lit(sign).alias("sign"),
                           F.xxhash64(*values).alias("one"), F.xxhash64(F.lit(1), *reversed(values)).alias("two"))

    both = signed(before, -1).unionByName(signed(after, 1))
    total = lambda name: F.sum(F.col(name).cast("decimal(20,0)") * F.col("sign")).alias(name)
    return both.groupBy("bucket").agg(total("one"), total("two"), F.sum("sign").alias("rows"))


def differing_buckets(sums: DataFrame, levels: int = LEVELS, branch: int = BRANCH) -> list[int] | None:
    """Numbers of the buckets whose sums differ, from the top of the tree down; None where they are too many."""
    sums = cut_lineage(sums)
    open_: list[int] | None = None
    for level in reversed(range(levels)):
        width = branch ** level
        node = F.floor(F.col("bucket") / F.lit(width)).alias("node")
        rows = sums
        if open_ is not None:
            parents = rows.sparkSession.createDataFrame([(one,) for one in open_], "parent bigint")
            rows = rows.join(F.broadcast(parents), F.floor(F.col("bucket") / F.lit(width * branch)) == F.col("parent"), "left_semi")
        if level:  # inside a node differences of single buckets must not cancel out: count the buckets that differ
            found = rows.where("one <> 0 or two <> 0 or rows <> 0").groupBy(node).agg(F.count(F.lit(1)).alias("n")).select("node")
        else:
            found = rows.where("one <> 0 or two <> 0 or rows <> 0").select(node)
        open_ = [row.node for row in found.limit(MOST_OPEN + 1).collect()]
        if len(open_) > MOST_OPEN:
            return None
        if not open_:
            return []
    return open_


def changed_parts(before: DataFrame, after: DataFrame, key: str, columns: list[str], levels: int = LEVELS,
                  branch: int = BRANCH) -> tuple[DataFrame, DataFrame]:
    """Both versions without the buckets in which they are equal."""
    found = differing_buckets(bucket_sums(before, after, key, columns, levels, branch), levels, branch)
    if found is None:
        return before, after
    spark = before.sparkSession
    numbers = spark.createDataFrame([(one,) for one in found], "_bucket bigint")
    return tuple(rows.withColumn("_bucket", bucket_of(key, levels, branch)).join(F.broadcast(numbers), "_bucket", "left_semi")
                 .drop("_bucket") for rows in (before, after))
