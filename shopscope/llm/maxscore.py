"""Exact top-k search by MaxScore (operator 4).

Vectors are integer term weights; a dimension is a query term, whose posting
list in a shard holds the documents in which the term's sign agrees with the
query (all others contribute nothing or less).  For each query and shard the
terms are split by their score bounds: the non-essential ones cannot lift a
document over the current k-th score on their own, so only documents of
essential postings are candidates.  Those are scored on the essential terms
and then probed term by term, in falling order of bound, while the rest of
the bounds can still make them competitive.  Results of shards are merged.

Queries are dealt in blocks and candidates in shards, so a task holds one
block and one shard whatever the size of the table.

Cases: rows with a null id, a null vector or null or non-finite components
take no part; of rows that repeat an id the one with the smallest vector
counts; ties go to the smaller id; a missing dimension counts as 0.  A tile
whose scores could leave the range in which doubles are exact is searched in
the same way on Python integers; results are ranked by the exact score, which
is given as the nearest long.  So are weights beyond the range of long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates per shard and queries per block, about.
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
#: Terms probed between two looks at the bounds.
PROBE_TERMS = 8
#: Factor between components and integer weights.
SCALE = 1024
#: Bytes of a score's sort key: products of two longs, added up over 2**16 dimensions, fit in.
KEY_BYTES = 18
LONG_MAX = (1 << 63) - 1


class Shard:
    """Term postings of a block of documents, with the bounds of each term and sign."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.weights = np.ascontiguousarray(weights[order].T)  # terms x documents
        self.high = np.maximum(self.weights.max(1, initial=0), 0)
        self.low = np.minimum(self.weights.min(1, initial=0), 0)
        self.agree = {1: self.weights > 0, -1: self.weights < 0}

    def top(self, query_id: int, query: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (ids, scores) of this shard with at least ``least``; ties by smaller id."""
        bounds = np.where(query > 0, query * self.high, query * self.low)
        order = np.argsort(-bounds, kind="stable")
        order = order[query[order] != 0]
        rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], np.zeros(1, bounds.dtype)])  # bound of the terms from here on
        seen = np.flatnonzero(self.ids != query_id)
        essential = int(np.argmax(rest < least)) if (rest < least).any() else len(order)
        if essential < len(order):
            candidate = np.zeros(len(self.ids), bool)
            for term in order[:essential]:
                candidate |= self.agree[1 if query[term] > 0 else -1][term]
            seen = seen[candidate[seen]]
        score = query[order[:essential]] @ self.weights[np.ix_(order[:essential], seen)]
        if len(seen) > 4 * k:  # the most promising candidates, scored in full, raise the bound
            ahead = seen[np.argpartition(-score, 4 * k)[: 4 * k]]
            least = max(least, np.sort(query @ self.weights[:, ahead])[-k])
        at = essential
        while len(seen):
            keep = score + rest[at] >= least
            if not keep.all():
                seen, score = seen[keep], score[keep]
            if at >= len(order):
                break
            terms = order[at : at + PROBE_TERMS]
            score = score + query[terms] @ self.weights[np.ix_(terms, seen)]
            at += len(terms)
        best = np.lexsort((self.ids[seen], -score))[:k]
        return self.ids[seen][best], score[best]


def integer_weights(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, w): floor(SCALE * component) of the vectors that take part, one per id."""
    given = F.col(vector_column).cast("array<double>")
    whole = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    w = F.transform(given, lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.when(whole, w).alias("w"))
    return rows.where("id is not null and w is not null").groupBy("id").agg(F.min("w").alias("w"))


def top_k(
    vectors: DataFrame, is_query, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """The ``k`` best candidates of every query row: (query_id, rank, id, score).

    ``is_query`` is a condition on the column ``id``; candidates are all rows
    but the query's own.
    """
    rows = integer_weights(vectors, id_column, vector_column)
    sizes = rows.agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q")).first()
    shards = max(1, -(-sizes["n"] // SHARD_ROWS))
    blocks = max(1, -(-(sizes["q"] or 0) // BLOCK_QUERIES))
    shard, block = F.pmod(F.xxhash64("id"), F.lit(shards)), F.pmod(F.xxhash64("id"), F.lit(blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = rows.where(is_query).select(F.lit(0).alias("side"), "id", "w", block.alias("block"))
    asked = asked.select("side", "id", "w", every(shards).alias("shard"), "block")
    searched = rows.select(F.lit(1).alias("side"), "id", "w", shard.alias("shard"))
    searched = searched.select("side", "id", "w", "shard", every(blocks).alias("block"))
    tiles = asked.unionByName(searched)
    parts = min(shards * blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tiles = tiles.repartition(parts, "shard", "block").sortWithinPartitions("shard", "block")

    def matrix(rows: list, width: int, kind: type) -> np.ndarray:
        out = np.zeros((len(rows), width), kind)
        for i, w in enumerate(rows):
            out[i, : len(w)] = w
        return out

    def largest(rows: list) -> int:
        return max((max(map(abs, w), default=0) for w in rows), default=0)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {0: ([], []), 1: ([], [])}

        def answered() -> pa.RecordBatch:
            width = max([0, *(len(w) for side in held.values() for w in side[1])])
            out: list[list] = [[], [], [], []]
            if held[0][0] and held[1][0]:
                exact = width * largest(held[0][1]) * largest(held[1][1]) < 1 << 53
                kind = np.float64 if exact else object
                queries = matrix(held[0][1], width, kind)
                own = Shard(np.asarray(held[1][0], np.int64), matrix(held[1][1], width, kind))
                # A first bound: the k-th score among a few documents of the shard.
                probe = own.weights[:, : 4 * k]
                for query_id, query in zip(held[0][0], queries):
                    seeds = np.sort((query @ probe)[own.ids[: 4 * k] != query_id])
                    least = seeds[-k] if len(seeds) >= k else -np.inf
                    ids, scores = own.top(query_id, query, k, least)
                    out[0] += [query_id] * len(ids)
                    out[1] += ids.tolist()
                    whole = [int(s) for s in scores]
                    out[2] += [max(-LONG_MAX - 1, min(LONG_MAX, s)) for s in whole]
                    out[3] += [(s + (1 << 8 * KEY_BYTES - 1)).to_bytes(KEY_BYTES, "big") for s in whole]
            kinds = [pa.int64()] * 3 + [pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["query_id", "id", "score", "key"])

        for batch in batches:
            for side, key, w, *tile in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != now:
                    if now is not None:
                        yield answered()
                    now, held = tile, {0: ([], []), 1: ([], [])}
                held[side][0].append(key)
                held[side][1].append(w)
        if now is not None:
            yield answered()

    found = tiles.mapInArrow(search, "query_id long, id long, score long, key binary")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("key"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
