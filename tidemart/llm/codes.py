"""Short codes for vectors: every part is replaced by the nearest of a few entries, found through memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written
from tidemart.llm.vectors import fits, largest, matrix, whole_numbers, widths

LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Coding:
    """``parts`` positions with ``entries`` entries each (62 at most), ``rounds`` of refinement. ``cells`` grid cells of a
    position are remembered by a task, and forgotten together when there are more; ``rows`` are worked on at once."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    cells: int = 50_000
    rows: int = 4096


CODING = Coding()


class Grid:
    """The nearest entries of one position, by squared distance, ties to the lower one.

    Space is cut into cells of equal sides. A cell met first gets the entries that can be nearest to some point of its
    box: the least distance to the box is not above the smallest of the entries' greatest distances. Parts are compared
    with the entries of their cell only, and exactly.
    """

    def __init__(self, book: np.ndarray, how: Coding):
        self.book, self.how = book, how
        self.masks: dict[bytes, int] = {}
        # half the mean distance of two entries along an axis, as a power of two
        apart = np.abs(book[:, None] - book[None]).astype(float).mean() / 2
        self.side = 1 << max(0, int(np.log2(max(apart, 1.0))))

    def open_entries(self, cells: np.ndarray) -> list[int]:
        """For each cell its entries as bits."""
        low = (cells * self.side)[:, None]
        high, book = low + self.side - 1, self.book[None]
        outside = np.maximum(np.maximum(low - book, book - high), 0)
        across = np.maximum(np.abs(book - low), np.abs(book - high))
        least, most = (outside**2).sum(axis=2), (across**2).sum(axis=2)
        bits = 1 << np.arange(len(self.book), dtype=np.int64)
        return ((least <= most.min(axis=1, keepdims=True)) @ bits).tolist()

    def masks_of(self, parts: np.ndarray) -> np.ndarray:
        """The bits of each part's cell."""
        cells = parts // self.side
        place = cells - cells.min(axis=0)
        sizes = place.max(axis=0) + 1
        if fits(*sizes.tolist()):
            radix = np.concatenate(([1], np.cumprod(sizes[:-1])))
            _, first, which = np.unique(place @ radix, return_index=True, return_inverse=True)
        else:
            _, first, which = np.unique(cells, axis=0, return_index=True, return_inverse=True)
        own = np.ascontiguousarray(cells[first])
        keys = [row.tobytes() for row in own]
        if len(self.masks) > self.how.cells:
            self.masks.clear()
        new = [i for i, key in enumerate(keys) if key not in self.masks]
        if new:
            self.masks.update(zip([keys[i] for i in new], self.open_entries(own[new])))
        return np.array([self.masks[key] for key in keys], np.int64)[which.ravel()]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part."""
        bound = largest(parts) + largest(self.book) + 2 * self.side
        if not fits(bound, bound, self.how.parts * parts.shape[1]):  # beyond the range of longs
            far = ((parts.astype(object)[:, None] - self.book.astype(object)[None]) ** 2).sum(axis=2)
            entry = np.array([min(range(len(row)), key=row.__getitem__) for row in far])
            return entry, far[np.arange(len(far)), entry]
        masks = self.masks_of(parts)
        row, entry = np.nonzero(masks[:, None] >> np.arange(len(self.book)) & 1)
        far = ((parts[row] - self.book[entry]) ** 2).sum(axis=1)
        start = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(far, start)
        hit = np.flatnonzero(far == least[row])
        return entry[hit[np.searchsorted(row[hit], np.arange(len(parts)))]], least


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """Vectors as (row, part, place); zeros fill up the last part."""
    own = -(-x.shape[1] // parts)
    full = np.zeros((len(x), parts * own), np.int64)
    full[:, : x.shape[1]] = x
    return full.reshape(len(x), parts, own)


def nearest_entries(batches: Iterator[dict], books: np.ndarray, how: Coding) -> Iterator[tuple]:
    """(columns, parts, entries, distances) of some rows at a time."""
    grids = [Grid(book, how) for book in books]
    for batch in batches:
        rows = batch["row"]
        for at in range(0, len(rows), how.rows):
            some = rows.slice(at, how.rows)
            parts = cut(matrix(some.field("x")), how.parts)
            found = [grid.nearest(np.ascontiguousarray(parts[:, p])) for p, grid in enumerate(grids)]
            yield some, parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def refine(slim: DataFrame, books: np.ndarray, how: Coding) -> np.ndarray:
    """One round: entries become the floored means of the parts they are nearest to; unused ones stay."""
    shape = books.shape

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        total, n = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for _, parts, entries, _ in nearest_entries(batches, books, how):
            kind = np.int64 if fits(largest(parts) + 1, len(parts)) else object
            own = np.zeros(shape, kind)
            for p in range(shape[0]):
                np.add.at(own[p], entries[:, p], parts[:, p].astype(kind))
                n[p] += np.bincount(entries[:, p], minlength=shape[1])
            total = total + own
        part, entry, place = (i.ravel() for i in np.indices(shape))
        used = np.flatnonzero(n[part, entry])
        yield {
            "part": part[used], "entry": entry[used], "place": place[used],
            "total": [Decimal(int(t)) for t in total.ravel()[used]], "n": n[part, entry][used],
        }

    made = map_batches(slim, "part int, entry int, place int, total decimal(38,0), n long", run)
    out = books.copy()
    # a row per component of the codebooks
    for r in made.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[r.part, r.entry, r.place] = int(r.total) // r.n
    return out


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, scale: int = 4096, how: Coding = CODING, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """A code for every vector: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Vectors become whole numbers floor(scale * component), cut into equal consecutive parts; the last ones are filled up with zeros if the
    length does not divide. Each position's codebook starts as the parts of the vectors with the smallest ids and is
    refined in rounds of assigning all parts and averaging. ``code`` is the final entry of every part, two hex digits
    each, ``error`` the sum of their squared distances (null beyond a long), ``label_error`` the error summed over equal
    labels, nulls together (null beyond a long).

    Null and empty vectors and those with null or non-finite components are left out. Vectors of each length have
    codebooks of their own; labels are summed over all of them. Rows with equal ids are rows of their own, the smaller
    vector first in a codebook's start; null ids come last there. With fewer vectors than entries there are fewer
    entries. An empty table gives an empty result, and other columns are not looked at. The driver and every task hold
    the codebooks, as many numbers as ``entries`` vectors have.
    """
    rows = written(whole_numbers(vectors, scale, embedding, key=vec_id, label=label), "code-vectors")
    key, kind = (rows.schema[c].dataType.simpleString() for c in ("key", "label"))
    coded = vectors.sparkSession.createDataFrame([], f"key {key}, label {kind}, code string, error long, codebooks_sha256 string")
    for width in widths(rows):
        coded = coded.unionAll(encoded(rows.filter(F.col("width") == width), how))
    coded = written(coded, "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"), F.bool_or(F.col("error").isNull()).alias("lost"))
    total = F.when(~F.col("lost"), F.col("label_error")).alias("label_error")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(F.col("key").alias(vec_id), "code", "error", total, "codebooks_sha256")


def encoded(rows: DataFrame, how: Coding) -> DataFrame:
    """Codes of vectors of one length."""
    first = rows.orderBy(F.asc_nulls_last("key"), "x").limit(how.entries).select("x").collect()
    books = cut(np.array([r.x for r in first], np.int64), how.parts).transpose(1, 0, 2).copy()
    slim = rows.select(F.struct("key", "label", "x").alias("row"))
    for _ in range(how.rounds):
        books = refine(slim, books, how)
    digest = codebooks_digest(books)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for some, _, entries, far in nearest_entries(batches, books, how):
            errors = [int(e) for e in far.sum(axis=1)]
            yield {
                "key": some.field("key"), "label": some.field("label"), "code": ["".join(f"{e:02x}" for e in row) for row in entries.tolist()],
                "error": [e if e <= LONGEST else None for e in errors],
            }

    key, kind = (rows.schema[c].dataType.simpleString() for c in ("key", "label"))
    return map_batches(slim, f"key {key}, label {kind}, code string, error long", run).withColumn("codebooks_sha256", F.lit(digest))
