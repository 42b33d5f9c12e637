"""Exact top-k search by inner product with vector-approximation files.

Vectors are integers. Candidates are dealt by a hash of their identifier into blocks of bounded size, queries too, and
every query block meets every candidate block in a task of its own. A candidate block is first quantised: each
dimension is cut into ``2 ** BITS`` cells, and a vector is the list of its cells. The scan of the cells gives a lower
and an upper bound of every score. The exact vectors are then read in the order of their upper bounds, and only until
the k-th best score found lies above the next bound, so nothing is missed. A last step keeps the k best of all blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.batches import workers_import_this
from almanac.sources import table

BITS = 5
K = 5
CANDIDATES_AT_ONCE = 4096
QUERIES_AT_ONCE = 1024
READ_AT_ONCE = 64
SCALE = 256


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v = floor(scale * x) of the vectors that take part: no null, no non-finite component, not empty."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    taking_part = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    return vectors.filter(taking_part & ~F.coalesce(bad, F.lit(True))).select("vec_id", v.alias("v"))


class ApproximationFile:
    """Cells of a block of vectors and the bounds that they give."""

    def __init__(self, vectors: np.ndarray, bits: int = BITS):
        low = vectors.min(0)
        self.step = (vectors.max(0) - low) // (1 << bits) + 1
        self.low = low
        self.cells = ((vectors - low) // self.step).astype(np.uint16)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the score of every query (rows) with every vector (columns)."""
        under = (self.low + self.cells * self.step).astype(float)
        over = under + (self.step - 1)
        plus, minus = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        return plus @ under.T + minus @ over.T, plus @ over.T + minus @ under.T


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of each query's k best in the block, ties to the smaller vec_id, its own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    limit = 2.0**53 / max(1, vectors.shape[1])
    if float(np.abs(vectors).max()) * float(np.abs(queries).max()) >= limit:
        return _search_wide(query_ids, queries, ids, vectors, k)
    file = ApproximationFile(vectors)
    found = []
    for start in range(0, len(queries), 128):
        lower, upper = file.bounds(queries[start : start + 128])
        for i, query in enumerate(queries[start : start + 128]):
            own = ids == query_ids[start + i]
            low, high = np.where(own, -np.inf, lower[i]), np.where(own, -np.inf, upper[i])
            sure = np.partition(low, -k)[-k] if len(low) > k else -np.inf
            hopeful = np.flatnonzero((high >= sure) & ~own)
            hopeful = hopeful[np.argsort(-high[hopeful], kind="stable")]
            best_at = np.empty(0, np.int64)
            best = np.empty(0, np.int64)
            for j in range(0, len(hopeful), READ_AT_ONCE):
                if len(best) == k and best[-1] > high[hopeful[j]]:
                    break
                read = hopeful[j : j + READ_AT_ONCE]
                best = np.concatenate([best, vectors[read] @ query])
                best_at = np.concatenate([best_at, read])
                keep = np.lexsort((best_at, -best))[:k]  # places are in the order of the identifiers
                best, best_at = best[keep], best_at[keep]
            found += [(int(query_ids[start + i]), int(ids[a]), int(s)) for a, s in zip(best_at, best)]
    return found


def _search_wide(query_ids, queries, ids, vectors, k) -> list[tuple[int, int, int]]:
    """The same for components so large that scores need more than 53 bits; scores are held within a long."""
    wide = vectors.astype(object)
    found = []
    for query_id, query in zip(query_ids.tolist(), queries.astype(object)):
        scores = [(-max(-(1 << 63), min((1 << 63) - 1, int(s))), int(i)) for s, i in zip(wide @ query, ids) if i != query_id]
        found += [(query_id, i, -s) for s, i in sorted(scores)[:k]]
    return found


def _matrix(rows: pa.Table) -> np.ndarray:
    flat = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(rows.num_rows, -1)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """From (vec_id, v) of both sides: query_id, rank (from 1), vec_id, score of each query's k best candidates.

    Candidates with the query's own vec_id are left out; repeated candidates count each; equal query rows are asked
    once. Only vectors of equal length are compared; a query without candidates gives no rows.
    """
    workers_import_this(queries.sparkSession)
    queries = queries.distinct()
    n_queries, n_candidates = queries.count(), candidates.count()
    query_blocks = max(1, -(-n_queries // QUERIES_AT_ONCE))
    candidate_blocks = max(1, -(-n_candidates // CANDIDATES_AT_ONCE))
    # The second hash spreads copies of one identifier.
    asked = queries.select(
        F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(candidate_blocks - 1))).alias("cb"), "vec_id", "v",
    )
    dealt = candidates.select(
        F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
        F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(candidate_blocks)).cast("int").alias("cb"),
        "vec_id", "v",
    ).withColumn("qb", F.col("qb").cast("long"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            rows = search_block(
                left.column("vec_id").to_numpy(), _matrix(left), right.column("vec_id").to_numpy(), _matrix(right), k
            )
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    keys = ("dims", "qb", "cb")
    found = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = scaled(table(spark, folder, "embeddings", "vec_id", "embedding"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""

QUERIES = {"op9_vector_search": op9_vector_search}
ORACLES = {"op9_vector_search": ORACLE}
