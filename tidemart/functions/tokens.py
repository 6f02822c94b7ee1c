"""Words of a text, as rows.

Runs of letters, marks and digits of any script are words, lower-cased. Han characters are written without blanks, so
they make runs of their own: such a run is one word, or, with the user's dictionary, gives every substring that is a
word of it, overlapping ones included, and its single characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# ---- fixed values: character classes
HAN = r"\p{IsHan}+"
LETTERS = r"[\p{L}\p{M}\p{N}&&[^\p{IsHan}]]+"
# --------------------------------------


#: Prefixes of a dictionary up to which their index goes to every task whatever the planner thinks.
FEW_PREFIXES = 200_000
#: Characters of a dictionary's Han words up to which a trie of them goes to every task.
TRIE_CHARS = 4_000_000
#: Entries up to which a trie's steps are a table, and characters of text that walk through it at a time.
TABLE_ENTRIES, WALK_CHARS = 1 << 22, 1 << 19
CODE_POINTS = 0x110000


class Trie:
    """Han words of two and more characters, each found at every place of many texts at once.

    The i-th step, in the order of (node, character), leads to node i + 1; node 0 is the root. A small trie looks its
    steps up in a table, a large one by binary search.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        size = np.array([len(w) for w in self.words], "int64")
        codes = np.frombuffer("".join(self.words).encode("utf-32-le"), "uint32")
        start = np.cumsum(size) - size
        letters = np.unique(codes)
        self.classes = np.zeros(int(letters[-1]) + 2 if len(letters) else 1, "int32")  # the last stands for all beyond
        self.classes[letters] = np.arange(1, len(letters) + 1)
        self.width, self.ends = len(letters) + 1, np.full(1, -1, "int64")
        node, left, steps = np.zeros(len(size), "int64"), np.arange(len(size)), []
        while len(left):
            depth, first = len(steps), len(self.ends)
            made, at = np.unique(node[left] * self.width + self.classes[codes[start[left] + depth]], return_inverse=True)
            steps.append(made)
            node[left] = first + at
            self.ends = np.concatenate([self.ends, np.full(len(made), -1, "int64")])
            done = size[left] == depth + 1
            self.ends[node[left[done]]] = left[done]
            left = left[~done]
        self.steps = np.concatenate([*steps, np.zeros(0, "int64")])

    def walker(self):
        """A function from nodes and character classes to the next nodes, 0 where there is none."""
        if len(self.ends) * self.width <= TABLE_ENTRIES:
            table = np.zeros(len(self.ends) * self.width, "int32")
            table[self.steps] = np.arange(1, len(self.steps) + 1)
            return lambda node, kind: table[node * self.width + kind]

        def search(node: np.ndarray, kind: np.ndarray) -> np.ndarray:
            keys = node * np.int64(self.width) + kind
            at = np.minimum(np.searchsorted(self.steps, keys), len(self.steps) - 1)
            return np.where(self.steps[at] == keys, at + 1, 0)

        return search

    def found(self, text: str, lengths: np.ndarray, step) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts that end in a blank, one after the other: text, word and number, in the order of the texts.

        A word is the code point of a single character, or ``CODE_POINTS`` and the place in ``words``.
        """
        codes = np.frombuffer(text.encode("utf-32-le"), "uint32")
        kinds, ends = self.classes[np.minimum(codes, len(self.classes) - 1)], np.cumsum(lengths)
        span, out = CODE_POINTS + len(self.words), []
        for low in range(0, len(codes), WALK_CHARS):
            at = low + np.flatnonzero(codes[low : low + WALK_CHARS] != 32)
            row = np.searchsorted(ends, at, "right") * span
            keys = [row + codes[at]]
            node, ahead = np.zeros(len(at), "int64"), 0
            while len(at):  # a walk ends at a blank at the latest
                node = step(node, kinds[at + ahead])
                on = np.flatnonzero(node)
                at, row, node, ahead = at[on], row[on], node[on], ahead + 1
                word = self.ends[node]
                hit = word >= 0
                keys.append(row[hit] + CODE_POINTS + word[hit])
            out.append(np.unique(np.concatenate(keys), return_counts=True))
        keys, counts = (np.concatenate([*x, np.zeros(0, "int64")]) for x in (zip(*out) if out else ((), ())))
        if len(out) > 1:
            keys, back = np.unique(keys, return_inverse=True)
            counts = np.bincount(back, counts, len(keys)).astype("int64")
        return keys // span, keys % span, counts

    def counter(self):
        """An Arrow function from texts of Han runs, each followed by a blank, to the words in them and how often they come."""
        kind = "array<struct<_han: boolean, _word: string, _n: bigint>>"

        @arrow_udf(kind)
        def count(texts: pa.Array) -> pa.Array:
            step, parts = self.walker(), []
            chars = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype("int64")
            part = np.cumsum(chars) // WALK_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                text = "".join(x or "" for x in texts.slice(a, b - a).to_pylist())
                row, word, n = self.found(text, chars[a:b], step)
                parts.append((row + a, word, n))
            row, word, n = (np.concatenate(x) for x in zip(*parts))
            ids, back = np.unique(word, return_inverse=True)
            names = pa.array([chr(i) if i < CODE_POINTS else self.words[i - CODE_POINTS] for i in ids.tolist()], pa.string())
            rows = [pa.array(np.ones(len(n), bool)), names.take(pa.array(back)), pa.array(n)]
            offsets = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype("int32"))
            return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(rows, ["_han", "_word", "_n"]))

        return count


class Prefixes:
    """Which lengths the words of ``dictionary(word)`` have, by their first two characters: an index to cut by.

    ``longest`` is that of its longest word. Both come from one aggregate, at most a row per word and no more than there
    are pairs of characters; ``small`` says that it may be broadcast. ``trie`` has the Han words themselves where they
    are few enough for every task.
    """

    def __init__(self, dictionary: DataFrame):
        words = dictionary.select(F.lower("word").alias("_w")).filter(F.length("_w") > 1).distinct()
        han = F.col("_w").rlike(f"^{HAN}$")
        index = words.groupBy(F.left("_w", F.lit(2)).alias("_two")).agg(
            F.collect_set(F.length("_w")).alias("_lengths"), F.sum(F.when(han, F.length("_w")).otherwise(0)).alias("_chars")
        )
        prefixes, longest, chars = index.agg(F.count(F.lit(1)), F.max(F.array_max("_lengths")), F.sum("_chars")).first()
        self.index, self.small, self.longest = index.drop("_chars"), prefixes <= FEW_PREFIXES, longest or 1
        few = self.small and (chars or 0) <= TRIE_CHARS
        self.trie = Trie([r["_w"] for r in words.filter(han).collect()]) if few else None

    def lengths_for(self, pieces: DataFrame) -> DataFrame:
        """Pieces with the lengths to cut them to as ``_lengths``; null where no word begins like them."""
        index = F.broadcast(self.index) if self.small else self.index
        return pieces.join(index, F.left("_piece", F.lit(2)) == F.col("_two"), "left").drop("_two")


def candidate_words(
    df: DataFrame, text: str, prefixes: Prefixes | None = None, name: str = "word", counts: str | None = None
) -> DataFrame:
    """One row per word, dropping ``text``; a text without words keeps one null row.

    With ``prefixes`` every place of a Han run gives its single character and the dictionary words that begin there;
    ``_han`` marks them. A dictionary too large for every task gives the substrings instead that are as long as some
    word with the same two first characters, not yet checked. Runs become rows then, so no array holds the places of a
    whole text, and a place carries no more text than the longest word.

    With ``counts`` a row stands for that many words of a text, so those that a text repeats need not all be rows.
    """
    keep = [c for c in df.columns if c != text]
    number = [counts] if counts else []
    if prefixes is not None and prefixes.trie is not None:
        others = F.transform(
            F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0)),
            lambda w: F.struct(F.lit(False).alias("_han"), F.lower(w).alias("_word"), F.lit(1).cast("bigint").alias("_n")),
        )
        runs = F.concat(F.regexp_replace(F.col(text), r"\P{IsHan}+", " "), F.lit(" "))
        both = df.select(*keep, F.concat(others, prefixes.trie.counter()(runs)).alias("_found"))
        words = both.select(*keep, F.inline_outer("_found"))
        if not counts:
            words = words.withColumn("_n", F.explode_outer(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
        found = F.coalesce("_han", F.lit(False)).alias("_han")
        return words.select(*keep, found, F.col("_word").alias(name), *[F.coalesce("_n", F.lit(1)).alias(c) for c in number])
    found = F.regexp_extract_all(F.col(text), F.lit(f"{HAN}|{LETTERS}"), F.lit(0))
    runs = df.select(*keep, F.explode_outer(found).alias("_run"), *[F.lit(1).cast("bigint").alias(c) for c in number])
    keep += number
    if prefixes is None:
        return runs.select(*keep, F.lower("_run").alias(name))
    runs = runs.withColumn("_han", F.coalesce(F.col("_run").rlike(f"^{HAN}"), F.lit(False)))

    def cut(rows: DataFrame) -> DataFrame:
        places = F.when(F.col("_han"), F.sequence(F.lit(1), F.length("_run")))
        placed = rows.select("*", F.explode_outer(places).alias("_at"))
        piece = F.when(F.col("_han"), F.substring(F.col("_run"), F.col("_at"), F.lit(prefixes.longest)))
        pieces = prefixes.lengths_for(placed.select(*keep, "_han", piece.alias("_piece"), F.when(~F.col("_han"), F.col("_run")).alias("_run")))
        sizes = F.filter(F.coalesce("_lengths", F.array().cast("array<int>")), lambda n: n <= F.length("_piece"))
        cuts = F.when(F.col("_han"), F.transform(F.concat(F.array(F.lit(1)), sizes), lambda n: F.left("_piece", n)))
        words = pieces.select(*keep, "_han", "_run", F.explode_outer(cuts).alias("_cut"))
        return words.select(*keep, "_han", F.lower(F.coalesce("_cut", "_run")).alias(name))

    if prefixes.small or df.isStreaming:
        return cut(runs)
    # only Han runs go through the shuffle of a large index
    others = runs.filter(~F.col("_han")).select(*keep, "_han", F.lower("_run").alias(name))
    return others.unionAll(cut(runs.filter("_han")))


def in_dictionary(words: DataFrame, dictionary: DataFrame, name: str = "word", singles: bool = True) -> DataFrame:
    """Drop Han candidates that are not in ``dictionary(word)``; ``singles`` keeps single characters all the same.

    All words go through one join, as two branches would make them twice (and keep a stream's state twice); only the
    candidates can match in it.
    """
    known = dictionary.select(F.lower("word").alias("_known")).distinct().withColumn("_met", F.lit(True))
    open_ = F.col("_han") & (F.length(name) > 1) if singles else F.col("_han")
    asked = words.withColumn("_open", open_)
    joined = asked.join(known, (F.col(name) == F.col("_known")) & (F.col("_open") == F.col("_met")), "left")
    return joined.filter(~F.col("_open") | F.col("_known").isNotNull()).drop("_han", "_open", "_known", "_met")


def split_words(df: DataFrame, text: str = "full_word", dictionary: DataFrame | None = None, singles: bool = True) -> DataFrame:
    """Join every row with the words of its text; columns of ``df`` but ``text``, plus ``word``."""
    if dictionary is None:
        return candidate_words(df, text)
    return in_dictionary(candidate_words(df, text, Prefixes(dictionary)), dictionary, singles=singles)
