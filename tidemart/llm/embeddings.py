"""Near-equal vectors by cross-polytope hashing, several probes per table, and verified pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.buckets import tiles
from tidemart.llm.components import components
from tidemart.llm.store import written

ROWS, BLOCK = 1 << 14, 1024


@dataclass(frozen=True)
class Hashing:
    """``tables`` hash tables, each keyed by ``hashes`` cross-polytope hashes; a vector is in its own bucket of a table
    and in the ``probes`` buckets that differ from it by the runner-up of one hash, the closest runners-up first."""

    tables: int = 6
    hashes: int = 3
    probes: int = 2
    seed: int = 7
    tile: int = 4096


HASHING = Hashing()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def bucket_keys(unit: np.ndarray, how: Hashing) -> np.ndarray:
    """Bucket numbers (row, table, probe) of unit vectors, the own bucket first.

    A hash rotates the vector by three rounds of random signs and Hadamard transforms and takes the coordinate that is
    largest by size, with its sign: the nearest corner of the cross-polytope.
    """
    n, width = unit.shape
    wide = 1 << max(1, (width - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :width] = unit
    random = np.random.default_rng([how.seed, width])
    rows = np.arange(n)
    out = np.empty((n, how.tables, 1 + how.probes), np.int64)
    for table in range(how.tables):
        first, second, gap = (np.empty((n, how.hashes), t) for t in (np.int64, np.int64, float))
        for h in range(how.hashes):
            x = padded
            for signs in random.choice([-1.0, 1.0], (3, wide)):
                x = hadamard(x * signs)
            size = np.abs(x)
            top = np.argpartition(size, wide - 2, axis=1)[:, -2:]
            swap = size[rows, top[:, 0]] > size[rows, top[:, 1]]
            best, next_ = np.where(swap, top[:, 0], top[:, 1]), np.where(swap, top[:, 1], top[:, 0])
            first[:, h] = 2 * best + (x[rows, best] < 0)
            second[:, h] = 2 * next_ + (x[rows, next_] < 0)
            gap[:, h] = size[rows, best] - size[rows, next_]
        order = np.argsort(gap, axis=1, kind="stable")
        powers = (2 * wide) ** np.arange(how.hashes, dtype=np.int64)
        own = first @ powers
        out[:, table, 0] = own
        for probe in range(how.probes):
            h = order[:, probe % how.hashes]
            other = own + (second[rows, h] - first[rows, h]) * powers[h]
            if probe >= how.hashes:  # two runners-up at once
                g = order[:, (probe + 1) % how.hashes]
                other = other + (second[rows, g] - first[rows, g]) * powers[g]
            out[:, table, 1 + probe] = other
    return out


def unit_vectors(vectors: list[list[float]]) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding: str) -> object:
    """Whether a vector can be compared: no nulls or non-finite components, not zero."""
    v = F.col(embedding)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def first_meeting(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For pairs of key rows: table and bucket of the first table that they share, the smallest bucket of it."""
    out = np.full((len(mine), 2), -1, np.int64)
    for table in reversed(range(mine.shape[1])):
        a, b = mine[:, table], others[:, table]
        shared = np.where((a[:, :, None] == b[:, None, :]).any(axis=2), a, np.iinfo(np.int64).max).min(axis=1)
        met = shared < np.iinfo(np.int64).max
        out[met, 0], out[met, 1] = table, shared[met]
    return out


def links(classes: DataFrame, least_cosine: float, how: Hashing = HASHING) -> DataFrame:
    """Rows (``kind``, ``u``, ``v``): 'links' with a class and how many vectors a tile links to it, 'edge' with a forest.

    ``classes``: ``cid``, ``grp``, ``vector`` and ``copies``, a row per distinct vector. Pairs are compared in the tile
    where they meet first, so each is counted once; no pair leaves the task.
    """

    def keys(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            ids, vectors = np.array(batch["cid"]), batch["vector"]
            lengths = np.array([len(v) for v in vectors])
            for width in np.unique(lengths):
                these = np.flatnonzero(lengths == width)
                found = bucket_keys(unit_vectors([vectors[i] for i in these]), how)
                n, tables, probes = found.shape
                yield {
                    "cid": np.repeat(ids[these], tables * probes).tolist(), "grp": [batch["grp"][i] for i in these for _ in range(tables * probes)],
                    "tab": np.tile(np.repeat(np.arange(tables), probes), n).tolist(), "bucket": found.ravel().tolist(),
                }

    grp = classes.schema["grp"].dataType.simpleString()
    rows = map_batches(classes.select("cid", "grp", "vector"), f"cid long, grp {grp}, tab int, bucket long", keys).distinct()
    met = tiles(rows, ["grp", "tab", "bucket"], "cid", how.tile, classes.select("cid", "vector", "copies"))

    def compare(tile: dict[str, list]) -> dict[str, list]:
        unit, ids = unit_vectors(tile["vector"]), np.array(tile["cid"])
        copies, part = np.array(tile["copies"]), np.array(tile["part"])
        across = tile["i"][0] != tile["j"][0]
        here = np.array([tile["tab"][0], tile["bucket"][0]])
        all_keys = None
        linked, root, forest = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
        for at in range(0, len(ids), BLOCK):
            near = unit[at : at + BLOCK] @ unit.T >= least_cosine
            a, b = np.nonzero(near)
            a = a + at
            keep = (a < b) & ((part[a] != part[b]) if across else True)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if all_keys is None:
                all_keys = bucket_keys(unit, how)
            for k in range(0, len(a), 1 << 16):
                x, y = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
                first = (first_meeting(all_keys[x], all_keys[y]) == here).all(axis=1)
                x, y = x[first], y[first]
                np.add.at(linked, x, copies[y])
                np.add.at(linked, y, copies[x])
                apart = root[x] != root[y]
                for i, j in zip(x[apart].tolist(), y[apart].tolist()):
                    p, q = top(root, i), top(root, j)
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        forest.append((i, j))
                while (root != (root := root[root])).any():
                    pass
        some = np.flatnonzero(linked)
        return {
            "kind": ["links"] * len(some) + ["edge"] * len(forest), "u": ids[some].tolist() + [int(ids[i]) for i, _ in forest],
            "v": linked[some].tolist() + [int(ids[j]) for _, j in forest],
        }

    names = ["grp", "tab", "bucket", "i", "j"]

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held: dict[str, list] = {}
        tile = None
        for batch in batches:
            marks = list(zip(*(batch[c] for c in names)))
            at = 0
            while at < len(marks):
                end = at
                while end < len(marks) and marks[end] == marks[at]:
                    end += 1
                if tile != marks[at]:
                    if held and len(held["cid"]) > 1:
                        yield compare(held)
                    held, tile = {c: [] for c in batch}, marks[at]
                for c in batch:
                    held[c] += batch[c][at:end]
                at = end
        if held and len(held["cid"]) > 1:
            yield compare(held)

    return map_batches(met.select(*names, "part", "cid", "vector", "copies"), "kind string, u long, v long", run)


def top(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        i = int(root[i])
    return i


def near_duplicates(
    vectors: DataFrame, least_cosine: float = 0.98, how: Hashing = HASHING, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """Links and component of every vector.

    Returns ``vec_id``, ``n_links`` (other vectors of the same label with a cosine of at least ``least_cosine``, as far
    as hashing lets them meet; none below it), ``component_id`` (smallest vec_id reachable) and ``kept`` (it is that
    vector). Equal vectors of a label are one class, compared once and always linked. A null label, and vectors that
    are null, empty, zero or hold null or non-finite components, link with nothing: they have no links and are their
    own component. Vectors of different lengths never link. Rows with equal ids are rows of their own; a null id names
    no component unless all ids of it are null, and is then not kept. An empty table gives an empty result.
    """
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("grp"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.withColumn("fine", F.col("grp").isNotNull() & usable("vector"))
    classes = rows.filter("fine").groupBy("grp", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    found = written(links(classes, least_cosine, how), "vector-links", "kind")
    linked = found.filter("kind = 'links'").groupBy(F.col("u").alias("cid")).agg(F.sum("v").alias("others"))
    reach = components(found.filter("kind = 'edge'")).withColumnRenamed("node", "cid")
    told = classes.join(linked, "cid", "left").join(reach, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = told.groupBy("root").agg(F.min("least").alias("name"))
    told = told.join(names, "root").select("grp", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), "name")
    joined = rows.filter("fine").join(told, ["grp", "vector"]).select("id", "n", "name")
    alone = rows.filter("not fine").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("name"))
    return joined.union(alone).select(
        F.col("id").alias(vec_id), F.col("n").alias("n_links"), F.col("name").alias("component_id"), F.coalesce(F.col("id") == F.col("name"), F.lit(False)).alias("kept"),
    )
