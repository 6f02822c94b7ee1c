"""Encoding and decoding with a SentencePiece BPE model by matching all pieces at once in a suffix array."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemart.llm.arrow import map_batches

MARK = "▁"
BREAK = b"\xff"  # in no UTF-8 text, so no piece matches across it
PART, INDEX_BYTES, MAX_SEGMENTS = 1 << 21, 1 << 18, 250_000
PAIR_SLOTS, LONG, TOKENS = 20, 256, 1 << 18
NORMAL, BYTE = 1, 6
OPEN, START = -2, -1  # a place not reached, and one where a unit starts


def read_model(path: str) -> dict:
    """Vocabulary of a model file: texts, scores, kinds. Only BPE without character maps is understood."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
    if model.trainer_spec.model_type != pb.TrainerSpec.BPE or not plain:
        raise ValueError("a BPE model with a dummy prefix and no normalisation is needed")
    return {"pieces": [(p.piece, p.score, p.type) for p in model.pieces], "unknown": model.trainer_spec.unk_id}


class Pieces:
    """The vocabulary, and which pieces may stand side by side in an encoding.

    An encoding merges, again and again, the two neighbours whose text together is the piece of the best score, the
    leftmost on equal scores. It is the only sequence of pieces of which every two neighbours are the encoding of their
    text together, and so is every prefix of it. Followed back in time, the pieces that touch at a border tell whether
    something merges across it.
    """

    def __init__(self, model: dict):
        self.model = model
        self.ids = {text: i for i, (text, _, kind) in enumerate(model["pieces"]) if kind == NORMAL}
        self.texts = [text for text, _, _ in model["pieces"]]
        self.scores = [score for _, score, _ in model["pieces"]]
        self.bytes_of = [bytes([int(text[1:-1], 16)]) if kind == BYTE else text.encode() for text, _, kind in model["pieces"]]
        self.byte_ids = {self.bytes_of[i][0]: i for i, (_, _, kind) in enumerate(model["pieces"]) if kind == BYTE}
        self.halves: dict[int, tuple[int, int]] = {}
        self.time = [-1.0] * len(self.texts)
        self.usable = [i for text, i in sorted(self.ids.items(), key=lambda x: len(x[0])) if self.grow(text, i)]
        self.tables()

    def tables(self) -> None:
        """The same as arrays: how pieces come about, what two pieces make, and a table of pairs already judged."""
        n = len(self.texts)
        self.when_made, self.least_time = np.array(self.time), -np.array(self.scores)
        self.first_half, self.last_half = np.full(n, -1), np.full(n, -1)
        for piece, (left, right) in self.halves.items():
            self.first_half[piece], self.last_half[piece] = left, right
        made = {}
        for text, i in self.ids.items():
            for k in range(1, len(text)):
                left, right = self.ids.get(text[:k]), self.ids.get(text[k:])
                if left is not None and right is not None:
                    made[(left << 24) + right] = i
        self.made_of = np.array(sorted(made), np.int64)
        self.made = np.array([made[k] for k in self.made_of.tolist()], np.int64)
        self.blanks = np.array([MARK * 2 in t for t in self.texts])
        self.blank_first, self.blank_last = (np.array([f(t) for t in self.texts]) for f in (lambda t: t.startswith(MARK), lambda t: t.endswith(MARK)))
        self.judged, self.verdict = np.full(1 << PAIR_SLOTS, -1, np.int64), np.zeros(1 << PAIR_SLOTS, bool)

    def merge(self, chars: Iterable[str], seen: dict[int, tuple[int, int]] | None = None) -> list[str]:
        """The encoding by merging, step by step."""
        parts = list(chars)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                made = self.ids.get(parts[i] + parts[i + 1])
                if made is not None and (best is None or self.scores[made] > self.scores[best]):
                    best, at = made, i
            if best is None:
                return parts
            if seen is not None:
                seen[best] = (self.ids.get(parts[at], -1), self.ids.get(parts[at + 1], -1))
            parts[at : at + 2] = [self.texts[best]]

    def grow(self, text: str, piece: int) -> bool:
        """Note how a piece comes about; False if its own text is encoded otherwise."""
        if len(text) == 1:
            return True
        seen: dict[int, tuple[int, int]] = {}
        if self.merge(text, seen) != [text]:
            return False
        self.halves[piece] = seen[piece]
        left, right = seen[piece]
        self.time[piece] = max(-self.scores[piece], self.time[left], self.time[right])
        return True

    def side_by_side(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of pieces whether the encoding of both texts together is these two."""
        out = np.ones(len(left), bool)
        # runs of blanks have equal scores, where only the order of merging decides
        blank = self.blanks[left] | self.blanks[right] | (self.blank_last[left] & self.blank_first[right])
        for i in np.flatnonzero(blank).tolist():
            a, b = self.texts[left[i]], self.texts[right[i]]
            out[i] = self.merge(a + b) == [a, b]
        live = np.flatnonzero(~blank)
        a, b = left[live], right[live]
        end_a, end_b = np.full(len(live), np.inf), np.full(len(live), np.inf)
        while len(live):
            key = (a << 24) + b
            at = np.minimum(np.searchsorted(self.made_of, key), len(self.made_of) - 1)
            found = self.made_of[at] == key if len(self.made_of) else np.zeros(len(key), bool)
            time_a, time_b = self.when_made[a], self.when_made[b]
            when = np.maximum(np.maximum(time_a, time_b), self.least_time[self.made[at]]) if len(self.made_of) else time_a
            merged = found & (when < end_a) & (when <= end_b)
            out[live[merged]] = False
            # the half that was made later is undone, as long as there is one
            undo_a = time_a > time_b
            undo_b = ~undo_a & (self.first_half[b] >= 0)
            end_a, end_b = np.where(undo_a, time_a, end_a), np.where(undo_b, time_b, end_b)
            a, b = np.where(undo_a, self.last_half[a], a), np.where(undo_b, self.first_half[b], b)
            on = ~merged & (undo_a | undo_b)
            live, a, b, end_a, end_b = live[on], a[on], b[on], end_a[on], end_b[on]
        return out

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The same, looked up where a pair was judged before; the table forgets a pair when another takes its slot."""
        key = (left << 24) + right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_SLOTS)).astype(np.int64)
        out = self.verdict[slot]
        new = np.flatnonzero(self.judged[slot] != key)
        if len(new):
            pairs, which = np.unique(key[new], return_inverse=True)
            told = self.side_by_side(pairs >> 24, pairs & 0xFFFFFF)[which]
            out[new] = told
            # slot by slot the last pair stays, with its own verdict
            self.judged[slot[new]] = key[new]
            own = self.judged[slot[new]] == key[new]
            self.verdict[slot[new][own]] = told[own]
        return out


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the text that follows them, compared to ``depth`` bytes at least, by prefix doubling.

    A position's rank is the first place of its group of equals; only groups that are not yet told apart are sorted again.
    """
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n]
    eight = np.ascontiguousarray(eight).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(eight)
    eight = eight[order]
    first = np.append(True, eight[1:] != eight[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    width = 8
    while width < depth:
        tied = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(tied):
            break
        some = order[tied]
        later = np.where(some + width < n, rank[np.minimum(some + width, n - 1)] + 1, 0)
        key = rank[some] * (n + 1) + later
        by = np.argsort(key)
        order[tied], key = some[by], key[by]
        first[tied] = np.append(True, key[1:] != key[:-1])
        rank[order[tied]] = np.maximum.accumulate(np.where(first[tied], tied, 0))
        width *= 2
    return order


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its length, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes texts; segments met before are remembered, up to a bound.

    No piece holds a blank after another character, so a text falls into segments, each blanks and what follows them,
    which are encoded by themselves. Segments that a batch brings new are joined to one text, with breaks also where no
    piece goes on, and indexed.
    """

    def __init__(self, model: dict):
        self.pieces = p = Pieces(model)
        if any(re.search(f"[^{MARK}]{MARK}", t) for t in p.ids):
            raise ValueError("a piece goes across a word's start")
        order = sorted(p.usable, key=lambda i: p.bytes_of[i])
        self.order = np.array(order)
        self.lengths = np.array([len(p.bytes_of[i]) for i in order])
        self.depth = int(self.lengths.max())
        self.low = np.array([p.bytes_of[i] for i in order], f"S{self.depth}")
        self.high = np.array([p.bytes_of[i].ljust(self.depth, BREAK) for i in order], f"S{self.depth}")
        pairs = {t[i : i + 2] for t in p.ids for i in range(len(t) - 1)}
        self.inside = np.array(sorted((ord(a) << 21) + ord(b) for a, b in pairs), np.int64)
        self.lone = np.array([len(t) == 1 and t in p.ids for t in p.texts])
        self.byte_ids = np.array([p.byte_ids.get(b, model["unknown"]) for b in range(256)], np.int32)
        self.blob = np.frombuffer(b"".join(p.bytes_of), np.uint8)
        self.blob_length = np.array([len(b) for b in p.bytes_of])
        self.blob_start = np.cumsum(self.blob_length) - self.blob_length
        self.forget()

    def forget(self) -> None:
        self.segments: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)  # of all segments, one after the other
        self.start, self.length, self.used = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All occurrences of all pieces as (start, end, piece), by end, the longest first."""
        order = suffix_array(text, self.depth)
        padded = np.concatenate((text, np.full(self.depth, BREAK[0], np.uint8)))
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.depth)[order]
        windows = np.ascontiguousarray(windows).view(f"S{self.depth}").ravel()
        low, high = np.searchsorted(windows, self.low, "left"), np.searchsorted(windows, self.high, "right")
        times = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(times)), times)
        start = order[spread(low, times)]
        end = start + self.lengths[which]
        by = np.argsort(end * (len(text) + 1) + start)
        return start[by], end[by], self.order[which][by]

    def broken(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The segments as one text with a break after every unit, the starts of the units, and those of the segments.

        A unit ends with its segment and between characters that follow each other in no piece: nothing merges there.
        """
        joined = "".join(segments)
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        first = np.cumsum([0, *map(len, segments)])[:-1]
        pair = (chars[:-1] << 21) + chars[1:]
        at = np.minimum(np.searchsorted(self.inside, pair), max(len(self.inside) - 1, 0))
        starts = np.ones(len(chars), bool)
        starts[1:] = self.inside[at] != pair if len(self.inside) else True
        starts[first] = True
        size = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        place = np.cumsum(size) - size
        unit = np.cumsum(starts) - 1  # of each character
        raw = np.frombuffer(joined.encode(), np.uint8)
        text = np.insert(raw, np.append(place[starts][1:], len(raw)), BREAK[0])
        return text, place[starts] + np.arange(unit[-1] + 1), place[first] + unit[first]

    def encode_new(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after the other, and how many each has: relaxes the edges of their joined text."""
        text, units, firsts = self.broken(segments)
        starts, ends, names = self.edges(text)
        unknown = len(self.pieces.texts)
        # characters without a piece of their own are edges too; they merge with nothing
        head = np.flatnonzero(((text & 0xC0) != 0x80) & (text != BREAK[0]))
        single = np.zeros(len(text) + 1, bool)
        single[starts[self.lone[names]]] = True
        lost = head[~single[head]]
        if len(lost):
            lead = text[lost]
            after = lost + 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            starts, ends = np.concatenate((starts, lost)), np.concatenate((ends, after))
            names = np.concatenate((names, np.full(len(lost), unknown)))
            by = np.argsort(ends, kind="stable")
            starts, ends, names = starts[by], ends[by], names[by]
        last, back = np.full(len(text) + 1, OPEN), np.zeros(len(text) + 1, np.int64)
        last[units] = START
        stops = np.append(units[1:] - 1, len(text) - 1)
        begin = np.repeat(units, np.append(units[1:], len(text)) - units)  # the start of the unit of each place
        long = (stops - units > LONG).any() and np.repeat(stops - units > LONG, np.append(units[1:], len(text)) - units)[starts]
        self.relax(starts, ends, names, ends - begin[starts], last, back, long)
        return self.followed(text, units, stops, firsts, last, back)

    def relax(self, starts, ends, names, reach, last, back, long) -> None:
        """Extend what is reached edge by edge: ``last`` piece and where it starts, for every place.

        Units do not touch, so the edges that end equally far into their units are taken together; those of long units,
        of which few are as long, one by one.
        """
        if np.any(long):
            self.relax_one_by_one(starts[long], ends[long], names[long], last, back)
            starts, ends, names, reach = (x[~long] for x in (starts, ends, names, reach))
        by = np.argsort(reach.astype(np.int16), kind="stable")  # by digits
        starts, ends, names, reach = starts[by], ends[by], names[by], reach[by]
        cuts = np.flatnonzero(np.diff(reach)) + 1
        for some in zip([0, *cuts.tolist()], [*cuts.tolist(), len(reach)]):
            start, end, name = (x[slice(*some)] for x in (starts, ends, names))
            before = last[start]
            fit = before != OPEN
            fit[fit] = self.follows(before[fit], name[fit])
            start, end, name = start[fit], end[fit], name[fit]
            if len(end):
                longest = np.append(True, end[1:] != end[:-1])
                last[end[longest]], back[end[longest]] = name[longest], start[longest]

    def follows(self, before: np.ndarray, name: np.ndarray) -> np.ndarray:
        """Whether a piece may follow the one before; anything may follow a start or an unknown character."""
        unknown = len(self.pieces.texts)
        out = (before == START) | (before == unknown) | (name == unknown)
        pair = ~out
        out[pair] = self.pieces.fits(before[pair], name[pair])
        return out

    def relax_one_by_one(self, starts, ends, names, last, back) -> None:
        judged: dict[tuple[int, int], bool] = {}
        for start, end, name in zip(starts.tolist(), ends.tolist(), names.tolist()):
            if last[start] == OPEN or last[end] != OPEN:
                continue
            pair = (int(last[start]), name)
            if pair not in judged:
                judged[pair] = bool(self.follows(np.array(pair[:1]), np.array(pair[1:]))[0])
            if judged[pair]:
                last[end], back[end] = name, start

    def followed(self, text, units, stops, firsts, last, back) -> tuple[np.ndarray, np.ndarray]:
        """The pieces on the way back from the end of every unit, in order, and how many each segment has."""
        unknown, found, here, begin = len(self.pieces.texts), [], stops, units
        while len(here):
            start = back[here]
            found.append((start, last[here], here - start))
            on = start > begin
            here, begin = start[on], begin[on]
        start, name, size = (np.concatenate(x) for x in zip(*found))
        lost = name == unknown
        if lost.any():  # a byte each
            at = spread(start[lost], size[lost])
            start = np.concatenate((start[~lost], at))
            name = np.concatenate((name[~lost], self.byte_ids[text[at]]))
        by = np.argsort(start)
        start, name = start[by], name[by].astype(np.int32)
        return name, np.diff(np.append(np.searchsorted(start, firsts), len(start)))

    def learn(self, segments: list[str]) -> None:
        """Encode new segments, as much text at a time as is indexed at once."""
        run, size = [], 0
        for segment in [*segments, None]:
            if run and (segment is None or size > INDEX_BYTES):
                ids, counts = self.encode_new(run)
                first = len(self.segments)
                self.segments.update(zip(run, range(first, first + len(run))))
                self.ids, self.start, self.length = (
                    room(a, n) for a, n in ((self.ids, self.used + len(ids)), (self.start, first + len(run)), (self.length, first + len(run)))
                )
                self.ids[self.used : self.used + len(ids)] = ids
                self.length[first : first + len(run)] = counts
                self.start[first : first + len(run)] = self.used + np.cumsum(counts) - counts
                self.used += len(ids)
                run, size = [], 0
            if segment is not None:
                run.append(segment)
                size += len(segment)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        split = [segments_of(text) for text in texts]
        out, counts, i = [np.empty(0, np.int32)], [], 0
        while i < len(split):
            # as many texts at once as bring a bounded number of new segments
            new: set[str] = set()
            j = i
            while j < len(split) and (j == i or len(new) < MAX_SEGMENTS // 4):
                new.update(set(split[j]).difference(self.segments))
                j += 1
            if len(self.segments) + len(new) > MAX_SEGMENTS and self.segments:
                self.forget()
                new = set(chain.from_iterable(split[i:j]))
            self.learn(list(new))
            sizes = np.array([len(x) for x in split[i:j]])
            at = np.fromiter(map(self.segments.__getitem__, chain.from_iterable(split[i:j])), np.int64, int(sizes.sum()))
            length = self.length[at]
            upto = np.append(0, np.cumsum(length))
            ends = np.cumsum(sizes)
            counts += (upto[ends] - upto[ends - sizes]).tolist()
            out.append(self.ids[spread(self.start[at], length)])
            i = j
        return np.concatenate(out), np.array(counts, np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[str]:
        """Texts of pieces; the dummy prefix goes."""
        upto = np.append(0, np.cumsum(self.blob_length[ids]))
        parts = (ids[i : i + TOKENS] for i in range(0, len(ids), TOKENS))
        joined = b"".join(self.blob[spread(self.blob_start[x], self.blob_length[x])].tobytes() for x in parts)
        ends = np.cumsum(counts)
        for a, b in zip(upto[ends - counts].tolist(), upto[ends].tolist()):
            text = joined[a:b].decode("utf-8", "replace").replace(MARK, " ")
            yield text[1:] if text.startswith(" ") else text


def room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, made longer by half again or more if it has to be."""
    return array if size <= len(array) else np.concatenate((array, np.empty(max(size, 3 * len(array) // 2) - len(array), array.dtype)))


SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def segments_of(text: str) -> list[str]:
    if not text:
        return []
    words = (MARK + text.replace(" ", MARK)).split(MARK)
    if words.count("") == 1:
        return [MARK + w for w in words[1:]]
    return SEGMENT.findall(MARK + text.replace(" ", MARK))


def encode(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), back: tuple[str, ...] = ("decoded", "same_text"),
) -> DataFrame:
    """Token ids of every whole text, and the text that they decode to.

    Returns the columns in ``keep``, ``ids``, ``n_tokens``, and as ``back`` names them ``decoded`` and whether this is the
    text again, ``same_text``. Ids are as the library of the model file gives them, without begin and end. A null text
    has null ids and decodes to null, the same as it; an empty one has no tokens. Characters without a piece become their UTF-8 bytes. A text that
    holds U+2581 decodes with a blank in its place, as there. Repeated rows are encoded one by one, an empty table gives
    an empty result, and other columns are not looked at.
    """
    model = read_model(path)

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        encoder = Encoder(model)
        for batch in batches:
            texts, at = batch["text"], 0
            while at < len(texts):  # a bounded amount of text at a time, or one text
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or b"") <= PART):
                    size += len(texts[end] or b"")
                    end += 1
                values = [None if v is None else v.decode() for v in texts[at:end]]
                ids, counts = encoder.encode([v or "" for v in values])
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                out = {
                    "key": batch["key"].slice(at, end - at), "n_tokens": [None if v is None else n for v, n in zip(values, counts.tolist())],
                    "ids": pa.ListArray.from_arrays(offsets, pa.array(ids), mask=pa.array([v is None for v in values])),
                }
                if back:
                    decoded = [None if v is None else d for v, d in zip(values, encoder.decode(ids, counts))]
                    out |= {"decoded": decoded, "same_text": [d == v for d, v in zip(decoded, values)]}
                yield out
                at = end

    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("key"), F.col(text).alias("text"))
    kinds = {"decoded": "string", "same_text": "boolean"}
    columns = ", ".join(["ids array<int>", "n_tokens long", *(f"{c} {kinds[c]}" for c in back)])
    schema = StructType([slim.schema["key"], *_parse_datatype_string(columns)])
    return map_batches(slim, schema, run).select("key.*", "ids", "n_tokens", *back)
