"""Quality rules: base counts of a text, and its divergence from what its language looks like."""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string
from pyspark.sql.window import Window

from tidemart.llm.arrow import map_batches
from tidemart.llm.store import written

#: Character classes. The first two together are what ``word_chars`` leaves out.
BLANK, SPACE_LIKE, VOWEL, CONSONANT, CAPITAL, LETTER, DIGIT, STOP, SYMBOL, OTHER = range(10)
CLASSES = 10
SYMBOLS = "#*$%&|<>"
TABLE_END = 0x3000


@dataclass(frozen=True)
class Rules:
    """Limits of the quality rules.

    ``common``: how many of a language's most frequent words its histogram has; all others share one more bin.
    ``char_distance``, ``word_distance``: Jensen-Shannon distances (0 to 1) above which a text is rejected.
    ``least_chars``, ``least_words``: shorter texts have too few counts to be judged by that histogram.
    ``least_reference``: a language with fewer words has no histograms to be judged by.
    """

    common: int = 50
    char_distance: float = 0.33
    word_distance: float = 0.48
    least_chars: int = 200
    least_words: int = 50
    least_reference: int = 2000


RULES = Rules()


#: Of a language that nothing is known of.
NO_REFERENCE = {"chars": np.zeros(CLASSES), "words": {}, "counts": np.zeros(1)}


def class_of(char: str) -> int:
    if char in SYMBOLS:
        return SYMBOL
    if char in "\n\r\t\x0b\x0c":
        return SPACE_LIKE
    if char == " ":
        return BLANK
    if char in "aeiou":
        return VOWEL
    kind = unicodedata.category(char)
    if kind == "Lu":
        return CAPITAL
    if kind[0] in "LM":
        return CONSONANT if char.isascii() else LETTER
    if kind[0] == "N":
        return DIGIT
    if char in ".,;:!?'\"()-":
        return STOP
    return OTHER


def class_table() -> np.ndarray:
    return np.fromiter((class_of(chr(c)) for c in range(TABLE_END)), np.uint8, TABLE_END)


def histogram(text: bytes, table: np.ndarray) -> np.ndarray:
    """Code points of a text by class."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    low = points < TABLE_END
    out = np.bincount(table[points[low]], minlength=CLASSES)
    if not low.all():
        for point, n in zip(*np.unique(points[~low], return_counts=True)):
            out[class_of(chr(point))] += n
    return out


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that occurs at least twice."""
    if len(words) < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(first) + ids[1:], return_inverse=True)
    _, which, times = np.unique(pair[:-1] * len(first) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts, base 2."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    ratio = lambda a: float((a[a > 0] * np.log2(a[a > 0] / m[a > 0])).sum())
    return max(0.0, (ratio(p) + ratio(q)) / 2) ** 0.5


def references(docs: DataFrame, rules: Rules = RULES, text: str = "text", lang: str = "lang") -> dict[str, dict]:
    """Histograms of every language that has enough words.

    Counts all texts, whole. Words are counted per task and summed by a shuffle; the most
    frequent ones are found by a ranked window over (language, word) with at most ``common`` rows left per language, so
    what reaches the driver is bounded by languages times ``common``. Ties go to the word that sorts first.
    """

    def count(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        table, words, chars = class_table(), defaultdict(Counter), defaultdict(lambda: np.zeros(CLASSES, np.int64))

        def rows() -> Iterator[dict[str, list]]:
            # nothing is dropped: what leaves a task early is summed later
            for name, counter in words.items():
                out = list(counter.items())
                yield {"lang": [name] * len(out), "word": [w for w, _ in out], "chars": [None] * len(out), "n": [n for _, n in out]}
            words.clear()

        for batch in batches:
            for name, value in zip(batch["lang"], batch["text"]):
                value = value or b""
                words[name].update(value.split())
                chars[name] += histogram(value, table)
                if sum(map(len, words.values())) > 200_000:
                    yield from rows()
        yield from rows()
        for name, classes in chars.items():
            yield {"lang": [name] * CLASSES, "word": [None] * CLASSES, "chars": list(range(CLASSES)), "n": classes.tolist()}

    slim = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = map_batches(slim, "lang string, word binary, chars int, n long", count).groupBy("lang", "word", "chars").agg(F.sum("n").alias("n"))
    totals = F.sum(F.when(F.col("word").isNotNull(), F.col("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    counts = written(counts, "references")
    sizes = {r["lang"]: r["n"] or 0 for r in counts.groupBy("lang").agg(totals.alias("n")).collect()}
    classes = counts.filter("chars is not null").collect()
    own = counts.filter("word is not null").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= rules.common).collect()

    def entry(words: list, chars: list, size: int) -> dict:
        bins = np.zeros(CLASSES)
        for r in chars:
            bins[r["chars"]] += r["n"]
        listed = {bytes(r["word"]): i for i, r in enumerate(words)}
        counts = [r["n"] for r in words]
        return {"chars": bins, "words": listed, "counts": np.array([*counts, size - sum(counts)], float)}

    out = {}
    for name, size in sizes.items():
        if name is not None and size >= rules.least_reference:
            out[name] = entry([r for r in own if r["lang"] == name], [r for r in classes if r["lang"] == name], size)
    return out


def judge(docs: DataFrame, against: dict[str, dict], rules: Rules = RULES, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", row: bool = False) -> DataFrame:
    """Base counts, distances and verdict of every text.

    Returns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``char_distance``, ``word_distance`` (null where the text is too small or there is no reference) and ``kept``; with ``row``
    the columns of ``docs`` instead, for the kept rows only, unchanged. A null or empty text has no words and fails.
    In a null language, or one without a reference, distances are null and the base counts alone decide. Repeated rows
    are judged one by one, an empty table gives an empty result, and other columns are not looked at.
    """

    def measure(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        table = class_table()
        for batch in batches:
            out = defaultdict(list)
            for name, value in zip(batch["lang"], batch["text"]):
                value = value or b""
                words, bins = value.split(), histogram(value, table)
                repeated = repeated_words(words)
                failed = len(words) < 50 or 100 * repeated > 50 * len(words)
                reference = against.get(name.decode(), NO_REFERENCE) if name is not None else NO_REFERENCE
                chars = wording = None
                if bins.sum() >= rules.least_chars and reference["chars"].sum() > 0:
                    chars = distance(bins, reference["chars"])
                if len(words) >= rules.least_words and reference["counts"].sum() > 0:
                    listed = reference["words"]
                    hits = Counter(map(listed.get, words))
                    mine = np.array([hits.get(i, 0) for i in range(len(listed))] + [hits.get(None, 0)], float)
                    wording = distance(mine, reference["counts"])
                bad = (chars or 0) > rules.char_distance or (wording or 0) > rules.word_distance
                for key, v in zip(NAMES, (
                    len(words), int(bins.sum() - bins[BLANK] - bins[SPACE_LIKE]), int(bins[SYMBOL]), duplicate_lines(value), repeated,
                    failed, chars, wording, not failed and not bad,
                )):
                    out[key].append(v)
            yield {"key": batch["key"]} | {k: out[k] for k in NAMES}

    measures = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
        "char_distance double, word_distance double, kept boolean"
    )
    NAMES = [m.split()[0] for m in measures.split(", ")]
    key = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if row else F.col(doc_id)
    slim = docs.select(key.alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    schema = StructType([slim.schema["key"], *_parse_datatype_string(measures)])
    found = map_batches(slim, schema, measure)
    if row:
        return found.filter("kept").select("key.*")
    return found.withColumnRenamed("key", doc_id)
