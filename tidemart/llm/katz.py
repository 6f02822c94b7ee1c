"""Katz backoff language model: counted, stored and looked up in packed tables, evaluated level by level for every token.

A chunk is a run of documents of one task, kept as local word numbers in a table bucketed by chunk. For each level the
chunks send what they hold of it, each n-gram once, to buckets; a bucket counts, stores its part of the level's table
and answers every chunk in the order in which it asked. Requests and answers are arrays, packed, since nearly all
n-grams are rare and a row for each would be several times the text.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written
from tidemart.session import shared_folder

#: Stand for the start and the end of a text; a blank is in no word.
BEGIN, END = b" begin", b" end"
SENT = "chunk long, bucket int, blob binary"
ANSWERED = "kind string, chunk long, level int, bucket int, blob binary, ctx long, nums array<double>"


@dataclass(frozen=True)
class Order:
    """``n``: words in the longest n-gram. ``discounted``: counts up to this are discounted (k of Katz).

    ``chunk_bytes``: text of a chunk. ``bucket_tokens``: tokens per bucket, which sets the number of buckets; a context
    with more than half as many is spread over all buckets by the word that follows.
    """

    n: int = 2
    discounted: int = 5
    chunk_bytes: int = 16 << 20
    bucket_tokens: int = 1 << 20


ORDER = Order()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string: the bytes of equal weight together, sorted integers by their differences."""
    out = []
    for a in arrays:
        out.append(struct.pack("<cq", a.dtype.char.encode(), len(a)))
        out.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        kind, n = struct.unpack_from("<cq", data, at)
        dtype = np.dtype(kind.decode())
        at += 9
        planes = np.frombuffer(data, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n * dtype.itemsize
    return out


def steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def in_order(further: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Words from the steps between them, each context's starting anew."""
    first = np.cumsum(many) - many
    total = np.cumsum(further, dtype=np.uint64)
    return total - np.repeat(total[first] - further[first], many)


def mix(a: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly."""
    a = a.astype(np.uint64)
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def discounts(n_r: list[float], k: int) -> np.ndarray:
    """Factor of counts 0 to k + 1 from the numbers of n-grams seen 1 to k + 1 times: Good-Turing as Katz has it.

    Where the estimate is not between 0 and 1, the count stays as it is.
    """
    out = np.ones(k + 2)
    tail = (k + 1) * n_r[k] / n_r[0] if n_r[0] else 1.0
    for r in range(1, k + 1):
        if tail < 1 and n_r[r - 1]:
            d = ((r + 1) * n_r[r] / (r * n_r[r - 1]) - tail) / (1 - tail)
            if 0 < d < 1:
                out[r] = d
    return out


def seen(count: np.ndarray, total: np.ndarray, left: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Probability of seen n-grams; a context that discounting leaves nothing is counted once more, to leave something."""
    k = len(d) - 2
    return d[np.minimum(count, k + 1)] * count / np.where(left > 0, total, total + 1)


def word_chances(count: np.ndarray, level: Level) -> np.ndarray:
    """Probabilities of words from their counts; all unknown words together have what discounting leaves."""
    unknown = level.left / level.total if level.left > 0 else 1 / (level.total + 1)
    return np.where(count > 0, seen(count, level.total, np.full(len(count), level.left), level.d), unknown)


def by_word(word: np.ndarray) -> np.ndarray:
    """The order in which n-grams' lower probabilities travel: words of like rank have like counts, so most repeat."""
    return np.argsort(word, kind="stable")


def left_over(few: np.ndarray, d: np.ndarray) -> np.ndarray:
    """What discounting takes off, from the numbers of followers seen 1 to k times (one row per context)."""
    r = np.arange(1, len(d) - 1)
    return few @ ((1 - d[1:-1]) * r)


@dataclass
class Level:
    """What all chunks need to know of a level: buckets, discounts, and for words the totals."""

    buckets: int
    d: np.ndarray | None = None
    total: float = 0.0
    distinct: float = 0.0
    left: float = 0.0
    texts: int = 0


@dataclass
class Asked:
    """The n-grams of a level in a chunk, each once, in the order in which buckets get them."""

    positions: np.ndarray
    place: np.ndarray  # of every position's n-gram
    keys: np.ndarray
    bucket: np.ndarray
    train: np.ndarray
    first: np.ndarray  # a position of each
    total: np.ndarray  # of the context
    hot: np.ndarray

    def runs(self, b: int) -> tuple[slice, np.ndarray, np.ndarray]:
        """A bucket's n-grams: where they are, and the first and number of those of each context."""
        part = slice(*np.searchsorted(self.bucket, (b, b + 1)))
        ctx = self.keys[part] >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.empty(0, np.int64)
        return part, first, np.diff(first, append=len(ctx))


class Chunk:
    """A chunk's tokens, and what is known of them so far."""

    def __init__(self, blob: bytes, levels: list[Level], how: Order):
        self.lengths, self.held, self.words, tokens = unpack(blob)
        self.how, self.levels = how, levels
        self.local = tokens
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)
        self.offset = np.arange(len(tokens), dtype=np.int32) - starts[self.doc]
        self.training = (self.held == 0)[self.doc]
        self.scored = self.offset > 0  # all but the begins
        self.prob = np.ones(len(tokens))

    def word_order(self) -> tuple[np.ndarray, np.ndarray]:
        bucket = (self.words % np.uint64(self.levels[0].buckets)).astype(np.int64)
        order = np.lexsort((self.words, bucket))
        return order, bucket[order]

    def ask_words(self) -> Iterator[tuple[int, bytes]]:
        order, bucket = self.word_order()
        train = np.bincount(self.local[self.scored & self.training], minlength=len(self.words))
        for b in np.unique(bucket):
            these = order[slice(*np.searchsorted(bucket, (b, b + 1)))]
            yield int(b), pack(steps(self.words[these]), train[these].astype(np.uint32))

    def take_words(self, answers: dict[int, bytes]) -> None:
        order, _ = self.word_order()
        got = [unpack(answers[b]) for b in sorted(answers)]
        number, count = np.empty(len(order), np.uint32), np.empty(len(order), np.int64)
        number[order] = np.concatenate([g[0] for g in got])
        count[order] = np.concatenate([g[1] for g in got])
        level = self.levels[0]
        p = word_chances(count, level)
        self.known = count
        self.number, self.count = number[self.local], count[self.local]
        self.gram = self.number
        self.prob[self.scored] = p[self.local[self.scored]]

    def ask(self, n: int) -> Asked:
        positions = np.flatnonzero(self.offset >= n - 1).astype(np.int32)
        key = (self.gram[positions - 1].astype(np.uint64) << np.uint64(32)) | self.number[positions]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        keys, first = key[starts], positions[order[starts]]
        del key  # arrays of all tokens set what a chunk takes
        place = np.empty(len(positions), np.int32)
        place[order] = np.cumsum(new, dtype=np.int32) - 1
        train = np.add.reduceat(self.training[positions][order], starts, dtype=np.uint32) if len(keys) else np.empty(0, np.uint32)
        del order, new
        total = self.count[first - 1]
        if n == 2:  # a begin is no token, but every training text has one
            total = np.where(self.offset[first - 1] == 0, self.levels[0].texts, total)
        hot = total > self.how.bucket_tokens // 2
        bucket = (mix(np.where(hot, keys, keys >> np.uint64(32))) % np.uint64(self.levels[n - 1].buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int32)
        back[order] = np.arange(len(order), dtype=np.int32)
        return Asked(positions, back[place], keys[order], bucket[order], train[order], first[order], total[order], hot[order])

    def under(self, n: int, positions: np.ndarray) -> np.ndarray:
        """What a bucket needs to know the lower probabilities of n-grams: of words the counts, beyond them the values."""
        return self.known[self.local[positions]].astype(np.uint64) if n == 2 else self.prob[positions]

    def send(self, n: int, asked: Asked) -> Iterator[tuple[int, bytes]]:
        for b in np.unique(asked.bucket):
            part, first, many = asked.runs(int(b))
            ctx, word = (asked.keys[part] >> np.uint64(32))[first], asked.keys[part].astype(np.uint32)
            further = steps(word)  # words of a context follow in order, the first of each stands as it is
            further[first] = word[first]
            train = asked.train[part]
            # only what is seen in training counts for a context
            values, which = np.unique(self.under(n, asked.first[part][train > 0]), return_inverse=True)
            which = which[by_word(word[train > 0])].astype(np.uint32)
            values = steps(values) if values.dtype.kind == "u" else values
            yield int(b), pack(steps(ctx), many.astype(np.uint32), further, train, values, which, asked.hot[part][first])

    def take(self, n: int, asked: Asked, answers: dict[int, bytes], hot: dict[int, list[float]]) -> None:
        k, d, further = self.how.discounted, self.levels[n - 1].d, n < self.how.n
        p = np.empty(len(asked.keys))
        count, number = (np.empty(len(p), t) for t in (np.int64, np.uint32)) if further else (None, None)
        for b, blob in answers.items():
            part, _, many = asked.runs(b)
            counts, numbers, some, values, which = unpack(blob)
            left, lower = np.repeat(left_over(some.reshape(-1, k), d), many), np.repeat(values[which], many)
            spread = asked.hot[part]
            if spread.any():
                ctx, of = np.unique(asked.keys[part][spread] >> np.uint64(32), return_inverse=True)
                sums = np.array([hot[int(c)] for c in ctx])
                left[spread], lower[spread] = left_over(sums[:, :k], d)[of], sums[of, k]
            total = asked.total[part]
            rest = np.where(left > 0, left / np.maximum(total, 1), 1 / (total + 1)) / np.maximum(1 - lower, 1e-300)
            backed = np.where(total > 0, rest, 1.0) * self.prob[asked.first[part]]
            p[part] = np.where(counts > 0, seen(counts, np.maximum(total, 1), left, d), backed)
            if further:
                count[part], number[part] = counts, numbers
        self.prob[asked.positions] = p[asked.place]
        if further:
            self.gram, self.count = np.zeros(len(self.gram), np.uint32), np.zeros(len(self.count), np.int64)
            self.gram[asked.positions], self.count[asked.positions] = number[asked.place], count[asked.place]
        else:
            del self.gram, self.number, self.count


def tokenise(docs: DataFrame, doc_id: str, text: str, held: Column, how: Order) -> DataFrame:
    """Chunks as rows: ``chunk``, the documents' ids, and ``blob``."""

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        task, made = TaskContext.get().partitionId(), 0
        vocabulary: dict[bytes, int] = {}
        ids, lengths, held_out, tokens, size = [], [], [], [], 0

        def flush() -> dict[str, list]:
            nonlocal made, vocabulary, ids, lengths, held_out, tokens, size
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in vocabulary), np.uint64, len(vocabulary))
            blob = pack(np.array(lengths, np.int64), np.array(held_out, np.uint8), hashes, np.concatenate(tokens))
            row = {"chunk": [(task << 32) + made], "ids": [ids], "tokens": [sum(lengths) - len(lengths)], "texts": [held_out.count(False)], "blob": [blob]}
            made += 1
            vocabulary, ids, lengths, held_out, tokens, size = {}, [], [], [], [], 0
            return row

        for batch in batches:
            for key, value, out in zip(batch["id"], batch["text"], batch["held"]):
                words = [BEGIN, *(value or b"").lower().split(), END]
                put, known = vocabulary.setdefault, vocabulary
                tokens.append(np.fromiter((put(w, len(known)) for w in words), np.uint32, len(words)))
                ids.append(key)
                lengths.append(len(words))
                held_out.append(out)
                size += len(value or b"")
                if size >= how.chunk_bytes:
                    yield flush()
        if ids:
            yield flush()

    slim = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), held.alias("held"))
    return map_batches(slim, "chunk long, ids array<long>, tokens long, texts long, blob binary", run)


def count_words(table: pa.Table, how: Order, buckets: int) -> pa.Table:
    """A bucket of words: totals, numbers (the frequent ones small) and the answer to every chunk."""
    b, k = table["bucket"][0].as_py(), how.discounted
    asked = [unpack(x) for x in table["blob"].to_pylist()]
    words = [np.cumsum(a[0], dtype=np.uint64) for a in asked]
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    count = np.bincount(place, np.concatenate([a[1] for a in asked]), len(distinct)).astype(np.int64)
    number = np.empty(len(distinct), np.uint64)
    number[np.argsort(-count, kind="stable")] = np.arange(len(distinct), dtype=np.uint64) * np.uint64(buckets) + np.uint64(b)
    if len(number) and int(number.max()) >> 32:
        raise OverflowError("more words than 32 bits number")
    places = np.split(place, np.cumsum([len(w) for w in words])[:-1])
    answers = [pack(number[p].astype(np.uint32), count[p]) for p in places]
    return answer(table, 1, b, answers, pack(steps(distinct), count), spectrum(count, k), {}, [])


def spectrum(count: np.ndarray, k: int) -> list[float]:
    """Numbers of n-grams seen 1 to k + 1 times, of all seen, and the sum of counts."""
    few = np.bincount(np.minimum(count, k + 2), minlength=k + 3)
    return [*map(float, few[1 : k + 2]), float((count > 0).sum()), float(count.sum())]


def lower_chances(words: np.ndarray, values: np.ndarray, which: np.ndarray, level: Level) -> np.ndarray:
    """Lower probabilities of the n-grams that a chunk has seen in training, from what came for them in ``by_word`` order."""
    values = word_chances(np.cumsum(values), level) if values.dtype.kind == "u" else values
    out = np.empty(len(words))
    out[by_word(words)] = values[which]
    return out


def count_grams(table: pa.Table, n: int, how: Order, levels: list[Level]) -> pa.Table:
    """A bucket of n-grams: counts, what their contexts need for backing off, and the answer to every chunk."""
    b, k, buckets = table["bucket"][0].as_py(), how.discounted, levels[n - 1].buckets
    asked = [unpack(x) for x in table["blob"].to_pylist()]
    contexts = [np.cumsum(a[0], dtype=np.uint64) for a in asked]
    keys = [(np.repeat(c, a[1]) << np.uint64(32)) | in_order(a[2], a[1]) for c, a in zip(contexts, asked)]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    train = np.concatenate([a[3] for a in asked])
    count = np.bincount(place, train, len(distinct)).astype(np.int64)
    lower = np.zeros(len(distinct))
    lower[place[train > 0]] = np.concatenate([lower_chances(x[a[3] > 0].astype(np.uint32), a[4], a[5], levels[0]) for x, a in zip(keys, asked)])
    ctx, of = np.unique(distinct >> np.uint64(32), return_inverse=True)
    few = np.stack([np.bincount(of, count == r, len(ctx)) for r in range(1, k + 1)], axis=1)
    sums = np.bincount(of, np.where(count > 0, lower, 0.0), len(ctx))
    number = np.empty(0, np.uint64)
    if n < how.n:
        number = np.empty(len(distinct), np.uint64)
        number[np.argsort(-count, kind="stable")] = np.arange(len(distinct), dtype=np.uint64) * np.uint64(buckets) + np.uint64(b)
        if int(number.max()) >> 32:
            raise OverflowError("more n-grams than 32 bits number")
    places = np.split(place, np.cumsum([len(x) for x in keys])[:-1])
    answers, hot, wants = [], {}, []
    for p, c, a, chunk in zip(places, contexts, asked, table["chunk"].to_pylist()):
        at = np.searchsorted(ctx, c)
        values, which = np.unique(sums[at], return_inverse=True)
        numbers = (number[p] if len(number) else number).astype(np.uint32)
        answers.append(pack(count[p], numbers, few[at].astype(np.uint32).ravel(), values, which.astype(np.uint32)))
        for i, x in zip(at[a[6]].tolist(), c[a[6]].tolist()):
            hot[x] = [*few[i].tolist(), float(sums[i])]
            wants.append((chunk, x))
    return answer(table, n, b, answers, pack(steps(distinct), count), spectrum(count, k), hot, wants)


def answer(
    table: pa.Table, level: int, b: int, answers: list[bytes], stored: bytes, stats: list[float], hot: dict[int, list[float]], wants: list[tuple[int, int]],
) -> pa.Table:
    """A bucket's rows: the answers, its part of the table, numbers of n-grams by count, its share of contexts that are
    spread over buckets, and which chunks have those."""
    n, chunks = len(answers), table["chunk"].to_pylist()
    rows = [("answer", c, x, None, None) for c, x in zip(chunks, answers)]
    rows += [("table", None, stored, None, None), ("spectrum", None, None, None, stats)]
    rows += [("hot", None, None, c, nums) for c, nums in hot.items()] + [("want", chunk, None, c, None) for chunk, c in wants]
    kind, chunk, blob, ctx, nums = (list(x) for x in zip(*rows))
    return pa.table({
        "kind": pa.array(kind), "chunk": pa.array(chunk, pa.int64()), "level": pa.array([level] * len(rows), pa.int32()),
        "bucket": pa.array([b] * len(rows), pa.int32()), "blob": pa.array(blob, pa.binary()), "ctx": pa.array(ctx, pa.int64()),
        "nums": pa.array(nums, pa.list_(pa.float64())),
    })


def rebuilt(blob: bytes, rows: dict[str, list], levels: list[Level], how: Order, upto: int) -> Chunk:
    """A chunk with the answers to all levels up to one."""
    chunk = Chunk(blob, levels, how)
    by: dict[int, dict[int, bytes]] = {}
    hot: dict[int, dict[int, list[float]]] = {}
    for kind, level, bucket, data, ctx, nums in zip(*(rows[c] for c in ("kind", "level", "bucket", "blob", "ctx", "nums"))):
        if kind == "hot":
            hot.setdefault(level, {})[ctx] = nums
        else:
            by.setdefault(level, {})[bucket] = data
    chunk.take_words(by[1])
    for n in range(2, upto + 1):
        chunk.take(n, chunk.ask(n), by.get(n, {}), hot.get(n, {}))
    return chunk


@contextmanager
def bucketed(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A table bucketed by chunk in the shared folder, which later steps join without moving it.

    Buckets are known to the catalog only, so it has the table's name in the meantime and forgets it afterwards.
    """
    spark = df.sparkSession
    full = f"{name}_{uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        df.write.option("path", shared_folder(spark, name)).bucketBy(parts, "chunk").sortBy("chunk").saveAsTable(full)
        yield spark.table(full)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {full}")


def score(
    docs: DataFrame, held: Column, how: Order = ORDER, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Score all texts by a model learned from those for which ``held`` is false.

    Tokens are the lower-cased (A to Z) words and one end. Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``
    (tokens seen in training), ``train_tokens``, ``base_score`` (words alone, half a count added) and ``score`` (log10
    of the Katz probability). The probabilities of all words after a context and of one unknown word sum to 1. A null
    text counts as empty, whose only token is the end. Without training texts every token is unknown. Rows with equal
    ids are texts of their own, an empty table gives an empty result, other columns are not looked at.
    """
    with bucketed(tokenise(docs, doc_id, text, held, how), "katz_chunks") as chunks:
        return written(scored(chunks, how), "katz-scores").withColumnRenamed("doc_id", doc_id)


def scored(chunks: DataFrame, how: Order) -> DataFrame:
    """Scores of all texts, level by level."""
    tokens, texts = chunks.agg(F.sum("tokens"), F.sum("texts")).first()
    buckets = max(8, -(-(tokens or 0) // how.bucket_tokens))
    levels: list[Level] = []
    answers = None
    for n in range(1, how.n + 1):
        levels = [*levels, Level(buckets, texts=texts or 0)]
        got = ask(chunks, answers, levels, how).groupBy("bucket").applyInArrow(counter(n, how, levels), ANSWERED)
        got = written(got, f"katz-level-{n}", "kind")
        finish(levels[-1], got, how)
        sums = [F.sum(F.col("nums")[i]) for i in range(how.discounted + 1)]
        hot = got.filter("kind = 'hot'").groupBy("level", "ctx").agg(F.array(*sums).alias("nums"))
        now = got.filter("kind = 'answer'")
        wanted = got.filter("kind = 'want'").select("chunk", "ctx").distinct().join(hot, "ctx")
        wanted = wanted.select(F.lit("hot").alias("kind"), "chunk", "level", "ctx", "nums")
        now = now.unionByName(wanted, allowMissingColumns=True)
        answers = now if answers is None else answers.unionByName(now)
    return final(chunks, answers, levels, how)


def ask(chunks: DataFrame, answers: DataFrame | None, levels: list[Level], how: Order) -> DataFrame:
    """What all chunks send to the buckets of the last of the levels."""
    n = len(levels)

    def words(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for name, blob in zip(batch["chunk"], batch["blob"]):
                rows = list(Chunk(blob, levels, how).ask_words())
                yield {"chunk": [name] * len(rows), "bucket": [b for b, _ in rows], "blob": [x for _, x in rows]}

    def grams(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for name, blob in zip(left["chunk"].to_pylist(), left["blob"].to_pylist()):
            chunk = rebuilt(blob, right.to_pydict(), levels, how, n - 1)
            out += [(name, b, x) for b, x in chunk.send(n, chunk.ask(n))]
        columns = [list(c) for c in zip(*out)] or [[]] * 3
        kinds = (pa.int64(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["chunk", "bucket", "blob"])

    if n == 1:
        return map_batches(chunks.select("chunk", "blob"), SENT, words)
    return chunks.select("chunk", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(grams, SENT)


def counter(n: int, how: Order, levels: list[Level]) -> Callable[[pa.Table], pa.Table]:
    return (lambda t: count_words(t, how, levels[0].buckets)) if n == 1 else (lambda t: count_grams(t, n, how, levels))


def finish(level: Level, got: DataFrame, how: Order) -> None:
    """Discounts and totals of a level, from the sums over its buckets."""
    k = how.discounted
    sums = got.filter("kind = 'spectrum'").select(*[F.sum(F.col("nums")[i]) for i in range(k + 3)]).first()
    n_r = [x or 0.0 for x in sums]
    level.d, level.distinct, level.total = discounts(n_r, k), n_r[k + 1], n_r[k + 2]
    level.left = float(left_over(np.array([n_r[:k]]), level.d)[0])


def final(chunks: DataFrame, answers: DataFrame, levels: list[Level], how: Order) -> DataFrame:
    """Sums over the tokens of every text."""

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for ids, blob in zip(left["ids"].to_pylist(), left["blob"].to_pylist()):
            chunk = rebuilt(blob, right.to_pydict(), levels, how, how.n)
            at, n = chunk.scored, len(chunk.lengths)
            word, doc, words = chunk.local[at], chunk.doc[at], levels[0]
            base = np.log10((chunk.known + 0.5) / (words.total + 0.5 * (words.distinct + 1)))
            parts.append(pa.table({
                "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(chunk.held == 1),
                "n_tokens": pa.array(chunk.lengths - 1, pa.int64()),
                "n_known": pa.array(np.bincount(doc[(chunk.known > 0)[word]], minlength=n)),
                "train_tokens": pa.array(np.full(n, int(words.total), np.int64)),
                "base_score": pa.array(np.bincount(doc, base[word], n)),
                "score": pa.array(np.bincount(doc, np.log10(chunk.prob[at]), n)),
            }))
        return pa.concat_tables(parts)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.select("chunk", "ids", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(sums, schema)
