"""Centroid clustering by dimension-sharded Lloyd rounds, in exact integers.

Vectors are cut into shards of ``BLOCK`` dimensions. A tile is the block of some thousand vectors' components
in one shard, kept in the narrowest integer type that holds it; tiles are written once, bucketed by their
group of vectors. A round is:

1. Tasks over the tiles of a shard compute exact partial squared distances to the slices of the centroids
   in that shard's dimensions.
2. Partial distances are added by group over the shards, and the smallest sum (ties: the smaller number)
   is each vector's cluster: a byte or two a vector.
3. The clusters go back to the tiles of their group, whose buckets stay where they are. Every task adds up its
   tiles by cluster, the sums are added by (shard, cluster, dimension), and each shard replaces its own slice
   by ``floor(sum / count)``.

Nothing is broadcast but the centroids (k vectors), and no step needs the rows of a cluster together, so
a cluster with a third of all vectors costs what any other costs.

Defined cases: a vector that is null, has another number of components or a null or non-finite one is left out;
repeated rows and null vec_ids are vectors of their own; with fewer than k vectors there are as many
clusters as vectors; an empty table gives no rows; other columns are ignored. Components,
distances and inertias are exact up to 2^63 - 1, where a long ends, and stop there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eavista.llm.common import sha256
from eavista.session import fresh_path, literal_table, stage

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
BLOCK = 32
#: Vectors of a group at most; its partial distances take 8 bytes a vector and cluster at most.
GROUP = 1024

#: Components beyond this are squared as Python numbers.
_PLAIN = 1 << 26
_LONG = (1 << 63) - 1


def components(embedding: Column, dimensions: int, scale: int) -> Column:
    """Whole numbers floor(scale * x), or null if the vector is not kept."""
    x = embedding.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    # Beyond what a long holds floor() ends at its ends.
    return F.when((F.size(x) == dimensions) & finite, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest integer type."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in (np.uint8, np.int8, np.uint16, np.int16, np.uint32, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype(np.int64)


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    small = _narrow(values)
    return small.dtype.str, small.tobytes()


def _unpacked(kind: str, data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(kind)).reshape(-1, width).astype(np.int64)


def _slices(dimensions: int) -> list[slice]:
    return [slice(at, min(at + BLOCK, dimensions)) for at in range(0, dimensions, BLOCK)]


def tiles(vectors: DataFrame, dimensions: int) -> DataFrame:
    """Tiles (group_id, shard, kind, data, ids) of vectors (vec_id, x); the ids are in the first shard's tiles."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, len(batch), GROUP):
                rows = batch.iloc[start : start + GROUP]
                matrix = np.stack(rows["x"].to_numpy())
                group, made = (part << 32) + made, made + 1
                ids = rows["ids"].tolist()
                yield pd.DataFrame(
                    [(group, k, *_packed(matrix[:, s]), ids if k == 0 else None) for k, s in enumerate(_slices(dimensions))],
                    columns=["group_id", "shard", "kind", "data", "ids"],
                )

    # Ids travel as text: pandas would turn a column with nulls into floating numbers.
    return vectors.select(F.col("vec_id").cast("string").alias("ids"), "x").mapInPandas(
        cut, "group_id long, shard int, kind string, data binary, ids array<string>"
    )


def bucketed(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """``df`` written once in the shared folder, in buckets of a column: joins on it leave its rows where they are."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, column).write.option("path", path).bucketBy(buckets, column).sortBy(column).saveAsTable(table)
    return spark.table(table)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest digests of ``seed:vec_id``; equal digests by components."""
    digest = sha256(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    rows = vectors.select(digest.alias("digest"), "x").orderBy("digest", "x").limit(k).collect()
    return np.array([r.x for r in rows], np.int64)


def _squared(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids."""
    if max(np.abs(block).max(initial=0), np.abs(centroids).max(initial=0)) <= _PLAIN and block.min(initial=0) > -_LONG:
        # Differences stay below 2^27 and their squares, added over 32 dimensions, below 2^59.
        return np.stack([((block - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    far = block.astype(object)
    return np.stack([((far - c.astype(object)) ** 2).sum(axis=1).clip(max=_LONG).astype(np.int64) for c in centroids], axis=1)


def _added(shards: list[np.ndarray]) -> np.ndarray:
    """The sum of the shards' partial distances."""
    if sum(int(s.max(initial=0)) for s in shards) <= _LONG:
        return sum(shards)
    return sum(s.astype(object) for s in shards).clip(max=_LONG).astype(np.int64)


def assigned(tiled: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(group_id, kind, clusters, distances): nearest centroids and squared distances of each group's vectors."""
    k, slices = len(centroids), _slices(centroids.shape[1])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([
                (group, *_packed(_squared(_unpacked(kind, data, slices[shard].stop - slices[shard].start), centroids[:, slices[shard]])))
                for group, shard, kind, data in zip(batch["group_id"], batch["shard"], batch["kind"], batch["data"])
            ], columns=["group_id", "kind", "partial"])

    @F.pandas_udf("kind string, clusters binary, distances binary")
    def nearest(partials: pd.Series) -> pd.DataFrame:
        found = []
        for shards in partials:
            total = _added([_unpacked(p["kind"], p["partial"], k) for p in shards])
            clusters = total.argmin(axis=1)
            found.append((*_packed(clusters), total[np.arange(len(total)), clusters].tobytes()))
        return pd.DataFrame(found, columns=["kind", "clusters", "distances"])

    parts = tiled.select("group_id", "shard", "kind", "data").mapInPandas(partial, "group_id long, kind string, partial binary")
    # As many rows a group as there are shards.
    gathered = parts.groupBy("group_id").agg(F.collect_list(F.struct("kind", "partial")).alias("shards"))
    return gathered.select("group_id", nearest("shards").alias("c")).select("group_id", "c.*")


def moved(tiled: DataFrame, clusters: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: every shard's slice is the exact floor of its vectors' means; empty clusters stay."""
    k, slices = len(centroids), _slices(centroids.shape[1])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row a shard, cluster and dimension for each task, whatever it reads."""
        totals = np.zeros(centroids.shape, object)
        counts = np.zeros((len(slices), k), np.int64)
        for batch in batches:
            for shard, kind, data, small, own in zip(
                batch["shard"], batch["kind"], batch["data"], batch["small"], batch["clusters"]
            ):
                cut = slices[shard]
                block = _unpacked(kind, data, cut.stop - cut.start)
                cluster = _unpacked(small, own, 1)[:, 0]
                plain = np.abs(block).max(initial=0) <= _PLAIN and block.min(initial=0) > -_LONG
                for c in np.unique(cluster):
                    rows = block[cluster == c]
                    totals[c, cut] += (rows if plain else rows.astype(object)).sum(axis=0).astype(object)
                    counts[shard, c] += len(rows)
        yield pd.DataFrame([
            (shard, c, d, str(totals[c, d]), int(counts[shard, c]))
            for shard, cut in enumerate(slices) for c in range(k) if counts[shard, c] for d in range(cut.start, cut.stop)
        ], columns=["shard", "cluster", "dimension", "total", "vectors"])

    def slice_of_shard(rows: pd.DataFrame) -> pd.DataFrame:
        means = [int(total) // int(n) for total, n in zip(rows["total"], rows["vectors"])]
        return rows[["cluster", "dimension"]].assign(mean=means)

    joined = tiled.select("group_id", "shard", "kind", "data").join(
        clusters.select("group_id", F.col("kind").alias("small"), "clusters"), "group_id"
    )
    added = joined.mapInPandas(sums, "shard int, cluster int, dimension int, total string, vectors long").groupBy(
        "shard", "cluster", "dimension"
    ).agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"), F.sum("vectors").alias("vectors"))
    # At most k rows for each dimension of the shard.
    means = added.groupBy("shard").applyInPandas(slice_of_shard, "cluster int, dimension int, mean long").collect()
    after = centroids.copy()
    for row in means:
        after[row.cluster, row.dimension] = row.mean
    return after


def cluster(
    embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark = embeddings.sparkSession
    vectors = embeddings.select(
        embeddings["vec_id"].alias("vec_id"), components(embeddings["embedding"], dimensions, scale).alias("x")
    ).filter(F.col("x").isNotNull())
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return _nothing(spark, embeddings.schema["vec_id"].dataType.simpleString())
    tiled = bucketed(tiles(vectors, dimensions), "group_id", int(spark.conf.get("spark.sql.shuffle.partitions")), "tiles")
    for _ in range(rounds):
        centroids = moved(tiled, assigned(tiled, centroids), centroids)
    final = stage(assigned(tiled, centroids), "clusters")
    return _told(tiled, final, centroids, embeddings.schema["vec_id"].dataType.simpleString())


def inertias(clusters: DataFrame, k: int) -> list[int]:
    """The exact sum of distances of every cluster."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros(k, object)
        for batch in batches:
            for kind, small, far in zip(batch["kind"], batch["clusters"], batch["distances"]):
                np.add.at(totals, _unpacked(kind, small, 1)[:, 0], np.frombuffer(far, np.int64).astype(object))
        yield pd.DataFrame({"cluster": range(k), "total": map(str, totals)})

    rows = clusters.mapInPandas(sums, "cluster int, total string").groupBy("cluster").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    ).collect()
    found = {r.cluster: int(r.total) for r in rows}
    return [found.get(c, 0) for c in range(k)]


def _told(tiled: DataFrame, clusters: DataFrame, centroids: np.ndarray, id_type: str) -> DataFrame:
    """One row a vector from the tiles that hold the ids."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ids, small, own, far in zip(batch["ids"], batch["kind"], batch["clusters"], batch["distances"]):
                yield pd.DataFrame({
                    "vec_id": list(ids), "cluster": _unpacked(small, own, 1)[:, 0], "distance": np.frombuffer(far, np.int64),
                })

    joined = tiled.filter("shard = 0").select("group_id", "ids").join(clusters, "group_id")
    found = joined.mapInPandas(rows, "vec_id string, cluster int, distance long")
    own = inertias(clusters, len(centroids))
    facts = literal_table(
        found.sparkSession, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
        [(c, min(own[c], _LONG), min(sum(own), _LONG), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
         for c, row in enumerate(centroids.tolist())],
    )
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("vec_id").cast(id_type).alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _nothing(spark: SparkSession, id_type: str) -> DataFrame:
    return spark.createDataFrame(
        [], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
