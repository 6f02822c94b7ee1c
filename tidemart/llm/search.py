"""Exact top-k search by inner product: global score histograms are refined until they name each query's kth value."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written
from tidemart.llm.vectors import matrix, whole_numbers, widths

FAR = 1 << 61


@dataclass(frozen=True)
class Blocks:
    """Blocks of about ``queries`` queries meet blocks of candidates of ``numbers`` components, of which ``columns`` rows
    are scored at once; few candidates still make ``tasks`` blocks of ``least`` rows. A histogram has ``bins`` places."""

    queries: int = 512
    numbers: int = 1 << 21
    least: int = 1024
    tasks: int = 48
    columns: int = 4096
    bins: int = 128

    def count(self, rows: int, width: int) -> int:
        return max(-(-rows * width // self.numbers), min(self.tasks, -(-rows // self.least)), 1)


BLOCKS = Blocks()


def packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """Rows in blocks by a hash of ``uid``, a row per block: ``name`` and the columns as binary (``bits`` of x by their size), by ``id``, nulls last."""
    long = [c for c in rows.columns if c not in ("x", "width")]

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("id", "ascending"), ("uid", "ascending")])
        x = matrix(table["x"].combine_chunks())
        bits = next(t for t in (np.int8, np.int16, np.int32, np.int64) if not x.size or (x.min() >= np.iinfo(t).min and x.max() <= np.iinfo(t).max))
        out = {name: table["block"][:1], "rows": pa.array([len(x)]), "type": pa.array([np.dtype(bits).str]), "x": pa.array([x.astype(bits).tobytes()], pa.binary())}
        for c in long:
            column = table[c].combine_chunks()
            out[c] = pa.array([column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary())
        out["nulls"] = pa.array([table["id"].null_count])
        return pa.table(out)

    schema = f"{name} int, rows long, type string, x binary, " + "".join(f"{c} binary, " for c in long) + "nulls long"
    block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block")
    return rows.select(block, *long, "x").groupBy("block").applyInArrow(pack, schema)


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """All inner products, exact: floating point only where whole sums fit it."""
    size = np.sqrt((q.astype(float) ** 2).sum(axis=1).max(initial=0)) * np.sqrt((c.astype(float) ** 2).sum(axis=1).max(initial=0))
    if size < 1 << 23:
        return (q.astype(np.float32) @ c.T.astype(np.float32)).astype(np.int64)
    if size < 1 << 52:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    exact = q.astype(object) @ c.T.astype(object)
    return np.clip(exact, -FAR, FAR).astype(np.int64)


def tiles(queries: DataFrame, candidates: DataFrame, blocks: int) -> DataFrame:
    """Every block of queries beside every block of candidates."""
    copies = queries.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    one = F.struct(*[c for c in queries.columns]).alias("q")
    return copies.select("c", one).repartition(4 * blocks, "c").join(candidates.select("c", F.struct("*").alias("d")).repartition(4 * blocks, "c"), "c").select("q", "d")


def over_tiles(met: DataFrame, schema: str, width: int, long: tuple[str, ...], each) -> DataFrame:
    """Call ``each(columns of a query block, scores, uid, id and their null mark of some candidates)`` over all tiles.

    A query's own row has the least score there is.
    """

    def numbers(value: bytes) -> np.ndarray:
        return np.frombuffer(value, np.int64)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for q, d in zip(batch["q"].to_pylist(), batch["d"].to_pylist()):
                mine = {c: numbers(q[c]) for c in ("uid", "id", *long)}
                mine["null"] = np.arange(q["rows"]) >= q["rows"] - q["nulls"]
                left = np.frombuffer(q["x"], q["type"]).reshape(-1, width)
                right = np.frombuffer(d["x"], d["type"]).reshape(-1, width)
                uid, id_, null = numbers(d["uid"]), numbers(d["id"]), np.arange(d["rows"]) >= d["rows"] - d["nulls"]
                yield from each(mine, left, right, uid, id_, null)

    return map_batches(met, schema, run)


def scored(mine: dict, left: np.ndarray, right: np.ndarray, uid: np.ndarray, at: int, columns: int) -> np.ndarray:
    """Scores of a block of queries against the candidates from ``at`` on."""
    out = scores(left, right[at : at + columns])
    _, i, j = np.intersect1d(mine["uid"], uid[at : at + columns], assume_unique=True, return_indices=True)
    out[i, j] = -2 * FAR
    return out


def histograms(met: DataFrame, width: int, k: int, how: Blocks) -> DataFrame:
    """How many scores of a query lie in each place of its bracket, from the top down to where its block has enough."""

    def each(mine, left, right, uid, id_, null):
        n, bins = len(left), how.bins
        low, high, step, need = (mine[c][:, None] for c in ("low", "high", "step", "need"))
        counts = np.zeros(n * bins, np.int64)
        for at in range(0, len(right), how.columns):
            s = scored(mine, left, right, uid, at, how.columns)
            known = (s >= low) & (s < high)
            flat = ((s - low) // step + np.arange(n)[:, None] * bins)[known]
            counts += np.bincount(flat, minlength=n * bins)
        counts = counts.reshape(n, bins)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, place = np.nonzero((counts > 0) & (above < need))
        yield {"uid": mine["uid"][query], "place": place, "n": counts[query, place]}

    return over_tiles(met, "uid long, place int, n long", width, ("low", "high", "step", "need"), each)


def selected(met: DataFrame, width: int, how: Blocks) -> DataFrame:
    """Rows above a query's kth value, and of those equal to it as many of a block, by id, as all blocks may need."""

    def each(mine, left, right, uid, id_, null):
        low, need = mine["low"][:, None], mine["need"]
        equal = np.zeros(len(left), np.int64)  # ids rise along the block
        for at in range(0, len(right), how.columns):
            s = scored(mine, left, right, uid, at, how.columns)
            same = s == low
            keep = s > low
            some = np.flatnonzero(same.any(axis=1) & (equal < need))
            if len(some):
                rank = np.cumsum(same[some], axis=1) + equal[some, None]
                keep[some] |= same[some] & (rank <= need[some, None])
            equal += same.sum(axis=1)
            i, j = np.nonzero(keep)
            yield {
                "uid": mine["uid"][i], "query": pa.array(mine["id"][i], mask=mine["null"][i]), "id": pa.array(id_[at + j], mask=null[at + j]),
                "score": s[i, j],
            }

    return over_tiles(met, "uid long, query long, id long, score long", width, ("low", "need"), each)


def refined(state: DataFrame, found: DataFrame, how: Blocks) -> DataFrame:
    """Brackets narrowed to the place that holds the kth value, or the lowest score if there are fewer than k."""
    totals = found.groupBy("uid", "place").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("uid").orderBy(F.desc("place"))
    running = totals.withColumn("upto", F.sum("n").over(down)).join(state, "uid")
    hit = F.struct("place", (F.col("upto") - F.col("n")).alias("above"))
    best = running.groupBy("uid", "low", "high", "step", "need").agg(
        F.coalesce(F.max(F.when(F.col("upto") >= F.col("need"), hit)), F.min(hit)).alias("hit")
    )
    low = F.col("low") + F.col("hit.place") * F.col("step")
    return best.select(
        "uid", low.alias("low"), F.least(low + F.col("step"), F.col("high")).alias("high"),
        F.expr(f"(step - 1) div {how.bins} + 1").alias("step"), (F.col("need") - F.col("hit.above")).alias("need"),
    )


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, how: Blocks = BLOCKS, vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` best rows for every query: ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``.

    Vectors become whole numbers floor(scale * component); the score is their inner product. ``is_query`` says which rows
    are queries, as a condition on the column ``id`` (``vec_id`` as a long); candidates are all rows but the query's own. Equal scores go by the
    smaller ``vec_id``. All blocks of queries and candidates are scored; each round counts the scores in a bracket of
    every query by place and narrows the bracket to the place of the kth, until it is one value. A last round takes what
    lies above it and the smallest ids of what equals it: no more than k rows a block, however many are equal.

    Vectors that are null or empty or hold null or non-finite components take no part, and vectors meet those of their
    own length only. Rows with equal ids are rows of their own: each is a query, and a candidate for the others. A null
    id makes no query and comes last among equals. A query without candidates has no rows; fewer than k candidates are
    all returned; an empty table gives an empty result. Other columns are not looked at. Scores beyond 2^61 in size
    count as 2^61.
    """
    rows = whole_numbers(vectors, scale, embedding, id=vec_id)
    rows = written(rows.withColumn("id", F.col("id").cast("long")).withColumn("uid", F.monotonically_increasing_id()), "search-rows")
    asked = F.coalesce(is_query, F.lit(False))
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for width in widths(rows):
        mine = rows.filter(F.col("width") == width)
        out = out.unionAll(searched(mine, asked, width, k, how))
    return out


def searched(rows: DataFrame, asked: Column, width: int, k: int, how: Blocks) -> DataFrame:
    """``top_k`` for vectors of one length."""
    squares = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    count, norm, queries = rows.agg(F.count("*"), F.sqrt(F.max(squares)), F.count_if(asked)).first()
    if count < 2 or not queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks, groups = how.count(count, width), -(-queries // how.queries)
    candidates = written(packed(rows.drop("width"), blocks, "c"), "search-blocks")
    # no score exceeds the product of the norms
    reach = F.least(F.sqrt(squares) * F.lit(norm * 1.000001) + 2, F.lit(float(FAR + 1))).cast("long")
    asking = rows.filter(asked).drop("width")
    first = asking.select("uid", (-reach).alias("low"), (reach + 1).alias("high"), F.lit(k).cast("long").alias("need"))
    first = first.withColumn("step", F.expr(f"(high - low) div {how.bins} + 1"))
    state, step = written(first, "search-state"), None
    while step is None or step > 1:
        step = state.agg(F.max("step")).first()[0]
        met = tiles(packed(asking.join(state, "uid"), groups, "g"), candidates, blocks)
        state = written(refined(state, histograms(met, width, k, how), how), "search-state")
    best = selected(tiles(packed(asking.join(state, "uid"), groups, "g"), candidates, blocks), width, how)
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
