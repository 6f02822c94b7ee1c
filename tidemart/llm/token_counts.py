"""Counting the tokens of a byte-level BPE with deterministic transducers, without building token lists.

Two machines run one after the other. The first splits text into words: it reads character classes, and its transitions
say where a word begins. A batch is cut into chunks; every chunk's map from each entry state to its exit state is
computed for all chunks side by side, a parallel prefix scan composes the maps, and then every chunk runs once more from
the state that the scan gives it. The second machine reads the bytes of a word, and each transition adds to the number
of tokens. Its states are made when first needed.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from tidemart.llm.arrow import map_batches

# Character classes: letters (those that contractions end in apart), numbers, blank, other white space, the rest.
LETTER, SHORT, R, V, L, E, NUMBER, BLANK, SPACE, OTHER, QUOTE, END = range(12)
# States: what the open word is so far.
START, WORD, DIGITS, SIGNS, ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST, QUOTED, QUOTE_R, QUOTE_V, QUOTE_L, CLOSED = range(13)
#: What a transition tells: a word begins at this character, or at the one before it.
HERE, BEFORE = 1, 2
SENTINEL = 0x110000
CHUNK, PART = 256, 1 << 22
MAX_STATES, MAX_WORDS, MAX_PAIRS = 150_000, 400_000, 1_000_000


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output of the word splitter, by state and class.

    Words are: an apostrophe with s, t, m, d, re, ve or ll; an optional blank with letters, numbers or other signs; runs
    of white space, the last of which goes to the next word if it is a blank and otherwise stands alone.
    """
    letters = range(LETTER, E + 1)
    begin = dict.fromkeys(letters, WORD) | {NUMBER: DIGITS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, OTHER: SIGNS, QUOTE: QUOTED, END: START}
    table, said = np.zeros((13, 12), np.uint8), np.zeros((13, 12), np.uint8)

    def put(state: int, classes, to: int | None = None, out: int = 0) -> None:
        for c in classes:
            table[state, c], said[state, c] = begin[c] if to is None else to, out

    for state in range(13):
        put(state, range(12), None, HERE)
    put(WORD, letters, WORD)
    put(DIGITS, [NUMBER], DIGITS)
    put(SIGNS, [OTHER, QUOTE], SIGNS)
    for state in (ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST):
        put(state, [BLANK], BLANK_LAST)
        put(state, [SPACE], SPACE_LAST)
    for state, out in ((ONE_BLANK, 0), (BLANK_LAST, BEFORE)):
        put(state, letters, WORD, out)
        put(state, [NUMBER], DIGITS, out)
        put(state, [OTHER, QUOTE], SIGNS, out)
    put(SPACE_LAST, [*letters, NUMBER, OTHER, QUOTE], None, HERE | BEFORE)
    put(QUOTED, [SHORT], CLOSED)
    put(QUOTED, [OTHER, QUOTE], SIGNS)
    for opened, by, last in ((QUOTE_R, R, E), (QUOTE_V, V, E), (QUOTE_L, L, L)):
        put(QUOTED, [by], opened)
        put(opened, range(12), None, HERE | BEFORE)
        put(opened, letters, WORD, BEFORE)
        put(opened, [last], CLOSED)
    return table, said


def character_classes() -> np.ndarray:
    out = np.full(SENTINEL + 1, OTHER, np.uint8)
    for point in range(SENTINEL):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            out[point] = LETTER
        elif kind == "N":
            out[point] = NUMBER
    for points in ((9, 14), (0x85, 0x86), (0xA0, 0xA1), (0x1680, 0x1681), (0x2000, 0x200B), (0x2028, 0x202A), (0x202F, 0x2030), (0x205F, 0x2060), (0x3000, 0x3001)):
        out[slice(*points)] = SPACE
    for chars, kind in (("stmd", SHORT), ("r", R), ("v", V), ("l", L), ("e", E), (" ", BLANK), ("'", QUOTE)):
        for char in chars:
            out[ord(char)] = kind
    out[SENTINEL] = END
    return out


def word_starts(classes: np.ndarray, table: np.ndarray, said: np.ndarray) -> np.ndarray:
    """Positions at which words begin in a stream of classes that ends with END."""
    n = len(classes)
    rows = -(-n // CHUNK)
    padded = np.full(rows * CHUNK, END, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, CHUNK).T)
    step = table.astype(np.intp) * 12
    flat = step.ravel()
    maps = np.tile(np.arange(13) * 12, (rows, 1))
    for column in columns:
        maps = flat[maps + column[:, None]]
    maps //= 12
    shift = 1
    while shift < rows:  # after the round, a row maps through itself and up to 2 * shift - 1 rows before it
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift], axis=1)
        shift *= 2
    state = np.zeros(rows, np.intp)
    state[1:] = maps[:-1, START] * 12
    out, outs = np.empty((CHUNK, rows), np.uint8), said.ravel()
    for i, column in enumerate(columns):
        at = state + column
        out[i] = outs[at]
        state = flat[at]
    marks = out.T.ravel()[:n]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE) > 0
    return np.flatnonzero(starts)


class Merges:
    """The vocabulary's merges: a trie of its tokens, and which tokens may stand side by side.

    Tokens 0 to 255 are bytes, token 256 + i comes from merge i. Merges happen in the order of their numbers.
    """

    def __init__(self, pairs: list[tuple[int, int]], unreachable: frozenset[int] = frozenset()):
        self.halves = [(-1, -1)] * 256 + pairs
        self.merge = {(a << 20) + b: 256 + i for i, (a, b) in enumerate(pairs)}
        self.unreachable = unreachable
        texts = token_texts(pairs)
        self.children: list[dict[int, int]] = [{}]
        self.token_at = [-1]
        for token, text in enumerate(texts):
            node = 0
            for byte in text:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][byte]
            if token not in unreachable:
                self.token_at[node] = token
        self.known: dict[int, bool] = {}

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether the encoding of both texts together is these two tokens.

        The pieces that touch at the border are followed back in time, the younger of the two taken apart first. The
        tokens stay apart unless two pieces merge while both are there: after the later of them was made, before either
        goes into its token (where the same merge could happen on both sides, the one further left comes first).
        """
        before_left = before_right = 1 << 60
        while True:
            made = self.merge.get((left << 20) + right)
            if made is not None and left < made > right and made < before_left and made <= before_right:
                return False
            if left > right:
                if left < 256:
                    return True
                before_left, left = left, self.halves[left][1]
            else:
                if right < 256:
                    return True
                before_right, right = right, self.halves[right][0]

    def fits(self, left: int, right: int) -> bool:
        """The same with an answer kept; left is -1 at the start of a word."""
        if left < 0:
            return True
        key = (left << 20) + right
        known = self.known.get(key)
        if known is None:
            if len(self.known) > MAX_PAIRS:
                self.known.clear()
            known = self.known[key] = self.side_by_side(left, right)
        return known


def token_texts(pairs: list[tuple[int, int]]) -> list[bytes]:
    texts = [bytes([i]) for i in range(256)]
    for a, b in pairs:
        texts.append(texts[a] + texts[b])
    return texts


def unreachable_tokens(pairs: list[tuple[int, int]]) -> frozenset[int]:
    """Tokens whose own text is encoded otherwise."""
    merge = {pair: 256 + i for i, pair in enumerate(pairs)}

    def encode(text: bytes) -> list[int]:
        parts = list(text)
        while len(parts) > 1:
            made, at = min((merge.get(pair, 1 << 60), i) for i, pair in enumerate(pairwise(parts)))
            if made == 1 << 60:
                break
            parts[at : at + 2] = [made]
        return parts

    return frozenset(i for i, text in enumerate(token_texts(pairs)) if encode(text) != [i])


class Counter:
    """The transducer over bytes that counts the tokens of a word.

    Every prefix of a word ends in one token of its own encoding, and a token extends the encoding of a shorter prefix
    exactly if it may stand beside that prefix's last token. So a state holds, for every position from which a token
    may still go on: the trie node reached, the last token before the position, and the tokens up to there less those
    up to now. States are made on demand; beyond a bound the machine starts afresh, which changes no result.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        self.words: dict[bytes, int] = {}
        self.moves: dict[int, tuple[int, int]] = {}
        self.reset()

    def reset(self) -> None:
        self.states = [((0, -1, 0),)]
        self.index = {self.states[0]: 0}
        self.moves.clear()

    def move(self, state: int, byte: int) -> tuple[int, int]:
        m, ways, end = self.merges, [], None
        for node, last, tokens in self.states[state]:
            child = m.children[node].get(byte)
            if child is None:
                continue
            token = m.token_at[child]
            if end is None and token >= 0 and m.fits(last, token):
                end = (token, tokens + 1)
            ways.append((child, last, tokens))
        token, more = end
        to = tuple((n, a, c - more) for n, a, c in ways if m.children[n]) + ((0, token, 0),)
        if to not in self.index:
            if len(self.states) >= MAX_STATES:
                self.reset()
                state = -1
            self.index[to] = len(self.states)
            self.states.append(to)
        out = (self.index[to], more)
        if state >= 0:
            self.moves[(state << 8) + byte] = out
        return out

    def count(self, word: bytes) -> int:
        known = self.words.get(word)
        if known is not None:
            return known
        state = total = 0
        moves = self.moves.get  # the dictionary is emptied, never replaced
        for byte in word:
            state, more = moves((state << 8) + byte) or self.move(state, byte)
            total += more
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        if len(word) < 64:
            self.words[word] = total
        return total


def read_merges(path: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Merges as pairs of tokens, and the special strings, of a byte-level BPE in a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    # fixed values: printable characters stand for their own byte, the others for 256 and up in order
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    token = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    pairs = []
    for pair in content["model"]["merges"]:
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        token[a + b] = 256 + len(pairs)
        pairs.append((token[a], token[b]))
    return pairs, [t["content"] for t in content["added_tokens"]]


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every whole text, as the library of the tokenizer file counts them.

    Returns ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens). A null text counts as
    empty, which has no tokens. A special string inside a text is one token and separates what stands around it.
    Repeated rows are counted one by one, an empty table gives an empty result, other columns are not looked at.
    """
    pairs, special = read_merges(path)
    unreachable, packed = unreachable_tokens(pairs), zlib.compress(character_classes().tobytes())
    cut = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(special, key=len, reverse=True))) if special else None

    def count(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        classes, (table, said) = np.frombuffer(zlib.decompress(packed), np.uint8), splitter()
        counter = Counter(Merges(pairs, unreachable))

        def counts_of(texts: list[bytes]) -> np.ndarray:
            """Tokens of each text; the texts form one stream with END after each."""
            points = np.frombuffer("\0".join([*(t.decode("utf-8", "replace") for t in texts), ""]).encode("utf-32-le"), np.uint32).copy()
            stream = b"\0".join([*texts, b""])
            wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            offsets = np.concatenate(([0], np.cumsum(wide)))
            ends = np.cumsum([len(t) + 1 for t in texts]) - 1
            points[np.searchsorted(offsets, ends)] = SENTINEL
            starts = word_starts(classes[points], table, said)
            real = classes[points[starts]] != END
            at = offsets[starts]
            total, words = counter.count, counter.words
            each = [
                0 if not r else (words.get(w := stream[a:b]) or total(w))
                for r, (a, b) in zip(real.tolist(), pairwise([*at.tolist(), len(stream)]))
            ]
            # every END begins a word of no tokens, so the sums up to the ENDs give the texts' counts
            return np.diff(np.cumsum(each)[~real], prepend=0)

        def parts(values: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
            """Runs of pieces between special strings, of bounded size unless one piece is larger."""
            run, size = [], 0
            for value in values:
                for i, piece in enumerate(cut.split(value) if cut else [value]):
                    run.append((piece, i > 0))
                    size += len(piece)
                    if size > PART:
                        yield run
                        run, size = [], 0
            if run:
                yield run

        for batch in batches:
            values, totals = [v or b"" for v in batch["text"]], []
            for run in parts(values):
                for n, (_, more) in zip(counts_of([piece for piece, _ in run]).tolist(), run):
                    if more:
                        totals[-1] += n + 1
                    else:
                        totals.append(n)
            yield {"key": batch["key"], "n_bytes": [len(v) for v in values], "n_tokens": totals, "over_limit": [n > limit for n in totals]}

    slim = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text"))
    schema = StructType([slim.schema["key"], *_parse_datatype_string("n_bytes long, n_tokens long, over_limit boolean")])
    return map_batches(slim, schema, count).withColumnRenamed("key", doc_id)
