"""SimHash fingerprints, and the groups of texts whose fingerprints differ in few bits, compared bit plane by bit plane."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemart.llm.arrow import map_batches
from tidemart.llm.buckets import tiles
from tidemart.llm.components import components
from tidemart.llm.store import written

SHINGLE, RADIUS, BLOCKS, TILE, PAIRS, ROWS = 3, 2, 5, 8192, 1 << 18, 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None) -> int:
    """Majority of each bit over the XXH64 (seed 42) of all word shingles; zero if there are no words."""
    return majority(shingles(text, SHINGLE))


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles of a text, of the whole text if it has fewer words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = list(accumulate(words, lambda at, w: at + len(w) + 1, initial=-1))[1:]
    last = ends[size - 1 :] or ends[-1:]
    starts = [0, *(e + 1 for e in ends[: len(last) - 1])]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, last)), np.uint64, len(last))


def majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), ROWS):
        counts += np.unpackbits(hashes[i : i + ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def planes(words: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit words: 64 rows, row b with bit b of all words, 64 words to a column."""
    a = np.ascontiguousarray(words.reshape(-1, 64).T)
    mask, j = np.uint64(0x00000000FFFFFFFF), 32
    while j:
        shift = np.uint64(j)
        pairs = a.reshape(32 // j, 2, j, -1)
        low, high = pairs[:, 0], pairs[:, 1]
        swap = ((low >> shift) ^ high) & mask
        high ^= swap
        low ^= swap << shift
        j //= 2
        if j:
            mask ^= mask << np.uint64(j)
    return a


def within(differences: np.ndarray, radius: int) -> np.ndarray:
    """Which of the 64-bit differences have at most ``radius`` bits.

    Distances of 64 pairs are counted at once, a bit of the counters to a word, two planes at a step by a carry-save
    adder. Counters start so that they overflow beyond the radius; columns whose 64 pairs all have are left behind.
    """
    n = len(differences)
    padded = np.full(-(-n // 64) * 64, ALL)
    padded[:n] = differences
    rows = planes(padded)
    live = np.arange(rows.shape[1])
    bits = max(1, radius.bit_length())
    if 1 << bits < radius + 1:
        bits += 1
    start = (1 << bits) - radius - 1
    count = [np.full(len(live), ALL if start >> b & 1 else 0, np.uint64) for b in range(bits)]
    over = np.zeros(len(live), np.uint64)
    out = np.full(rows.shape[1], ALL)
    for at in range(0, 64, 2):
        p, q = rows[at], rows[at + 1]
        either = p ^ q
        carry = (p & q) | (count[0] & either)
        count[0] = count[0] ^ either
        for b in range(1, bits):
            count[b], carry = count[b] ^ carry, count[b] & carry
        over = over | carry
        if at % 8 == 6:
            open_ = over != ALL
            if not open_.all():
                rows, over, live = rows[:, open_], over[open_], live[open_]
                count = [c[open_] for c in count]
            if not len(live):
                break
    out[live] = over
    return np.unpackbits(out.view(np.uint8), bitorder="little")[:n] == 0


def forest(group: np.ndarray, part: np.ndarray, across: np.ndarray, words: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest, as index pairs, of the links inside each group; rows are sorted by group.

    Every word is compared with the one ``shift`` rows further, for one shift after the other, all groups side by side.
    Pairs already connected need no comparison, and pairs of one part none in a tile of two.
    """
    root = np.arange(len(words))
    out, active, shift = [], np.arange(len(words) - 1), 1
    while len(active):
        active = active[active + shift < len(words)]
        active = active[group[active] == group[active + shift]]
        pairs = active[root[active] != root[active + shift]]
        pairs = pairs[~across[pairs] | (part[pairs] != part[pairs + shift])]
        for i in range(0, len(pairs), PAIRS):
            some = pairs[i : i + PAIRS]
            near = some[within(words[some] ^ words[some + shift], radius)]
            if not len(near):
                continue
            for a in near.tolist():
                x, y = find(root, a), find(root, a + shift)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((a, a + shift))
            while (root != (root := root[root])).any():
                pass
        shift += 1
    return out


def find(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        i = int(root[i])
    return i


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """``fp`` (long) of every whole text, with ``doc_id``, or with all columns as the struct ``key``."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch["text"]], np.uint64).view(np.int64)
            yield {"key": batch["key"], "fp": values.tolist()}

    key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep else F.col(doc_id)
    slim = docs.select(key.alias("key"), F.col(text).alias("text"))
    return map_batches(slim, StructType([slim.schema["key"], *_parse_datatype_string("fp long")]), run)


def masks(blocks: int, radius: int) -> list[int]:
    """Masks of all choices of ``blocks - radius`` of the blocks that 64 bits are cut into.

    Two words that differ in at most ``radius`` bits agree in all but ``radius`` blocks, so under one of the masks.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(one, blocks - radius)]


def signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (``u``, ``v``) that connect all distinct fingerprints within the radius, a spanning forest per tile."""
    by = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks(blocks, radius)]))
    met = tiles(prints.select("fp", by.alias("mask", "key")), ["mask", "key"], "fp", tile)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        columns = ("mask", "key", "i", "j", "part", "fp")
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 6

        def compare(rows: list[np.ndarray]) -> Iterator[dict[str, list]]:
            mask, key, i, j, part, fp = rows
            if len(fp) > 1:
                new = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
                group = np.concatenate(([0], np.cumsum(new)))
                found = forest(group, part, i != j, fp.view(np.uint64), radius)
                yield {"u": [int(fp[a]) for a, _ in found], "v": [int(fp[b]) for _, b in found]}

        for batch in batches:
            held = [np.concatenate((h, np.asarray(batch[c], np.int64))) for h, c in zip(held, columns)]
            if len(held[5]) >= ROWS:
                # all but the last tile are whole
                last = np.ones(len(held[5]), bool)
                for h in held[:4]:
                    last &= h == h[-1]
                cut = int(np.argmax(last))
                yield from compare([h[:cut] for h in held])
                held = [h[cut:] for h in held]
        yield from compare(held)

    return map_batches(met.select("mask", "key", "i", "j", "part", "fp"), "u long, v long", run)


def groups(prints: DataFrame, **options) -> DataFrame:
    """``fp``, ``root`` (a fingerprint that names the component) and ``component_id`` for every distinct fingerprint.

    ``prints`` has ``doc_id`` and ``fp``; ``component_id`` is the smallest doc_id that links reach, null ids apart.
    """
    each = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(each.select("fp"), **options))
    rooted = each.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Fingerprint and component of every document.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``. Texts whose fingerprints differ in at most
    ``radius`` bits are linked. A null text is an empty one; texts without words have the fingerprint zero and are
    linked by it like others. Rows with equal ids are rows of their own; a null id names no component unless all ids of
    it are null. An empty table gives an empty result, other columns are not looked at.
    """
    prints = written(fingerprints(docs, doc_id, text).select(F.col("key").alias("doc_id"), "fp"), "fingerprints")
    named = groups(prints, **options)
    return prints.join(named, "fp").select(F.col("doc_id").alias(doc_id), hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The columns of ``docs`` for one document of each component: that with the smallest doc_id.

    Where rows share this id, those of the smallest fingerprint are meant, and of repeated rows one stays. A null id
    counts only in components without any other.
    """
    tagged = fingerprints(docs, doc_id, text, keep=True)
    prints = written(tagged.select(F.col(f"key.{doc_id}").alias("doc_id"), "fp"), "fingerprints")
    return least_of_each(tagged, prints.join(groups(prints, **options), "fp"), doc_id, "fp")


def least_of_each(tagged: DataFrame, members: DataFrame, doc_id: str, mark: str) -> DataFrame:
    """The rows of ``tagged`` that ``members``, with ``root`` and ``component_id``, keep; ``mark`` tells texts apart."""
    members = members.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = members.groupBy("root").agg(F.min(mark).alias(mark), F.min("component_id").alias("doc_id"))
    # an id that is never null makes a plain key, so the texts move once for both steps
    known = F.coalesce(F.concat(F.lit("0"), F.col("doc_id").cast("string")), F.lit("1")).alias("id")
    rows = tagged.withColumn("doc_id", F.col(f"key.{doc_id}")).select("key", known, mark)
    rows = rows.join(chosen.select(known, mark).hint("merge"), ["id", mark], "left_semi")
    return rows.dropDuplicates(["id", mark]).select("key.*")
