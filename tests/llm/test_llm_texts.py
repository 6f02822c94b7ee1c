"""Operators on single texts against plain Python and the tokenizers' own libraries."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_data import documents, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import quality, secrets, sentencepieces, token_counts
from tidemart.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def small_docs(spark, small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def base_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_base_counts(spark):
    docs = documents(spark)
    out = quality.judge(docs, quality.references(docs))
    got = Counter((r["doc_id"], *(r[c] for c in BASE)) for r in out.collect())
    assert got == Counter((r[0], *base_of(r[1])) for r in rows())
    assert all(not r["kept"] for r in out.collect() if r["base_failed"])


def test_quality_query(spark, small):
    texts = small_docs(spark, small)
    out = QUERIES["op2_quality_divergence"](spark, small).collect()
    assert {r["doc_id"]: tuple(r[c] for c in BASE) for r in out} == {i: base_of(t) for i, t in texts.items()}


def test_quality_references_and_distances(spark):
    docs = spark.createDataFrame([(1, "aa bb aa cc " * 20, "en"), (2, "dd ee " * 40, "de"), (3, "Zz! 9 ", None), (4, None, "en")], "doc_id long, text string, lang string")
    rules = quality.Rules(common=2, least_reference=50, least_chars=1, least_words=2)
    found = quality.references(docs, rules)
    assert list(found["en"]["words"]) == [b"aa", b"bb"] and found["en"]["counts"].tolist() == [40, 20, 20]
    assert list(found["de"]["words"]) == [b"dd", b"ee"] and set(found) == {"en", "de"}
    got = {r["doc_id"]: r for r in quality.judge(docs.union(docs.sparkSession.createDataFrame([(5, "dd xx dd yy", "de")])), found, rules).collect()}
    assert got[1]["word_distance"] == pytest.approx(0, abs=1e-9)
    p, q = np.array([2, 0, 2]) / 4, np.array([40, 40, 0]) / 80
    m = (p + q) / 2
    expected = math.sqrt(sum(a * math.log2(a / b) for a, b in zip(p, m) if a) / 2 + sum(a * math.log2(a / b) for a, b in zip(q, m) if a) / 2)
    assert got[5]["word_distance"] == pytest.approx(expected)
    assert got[3]["char_distance"] is None and got[3]["word_distance"] is None
    assert got[4]["char_distance"] is None and got[4]["word_distance"] is None


def test_quality_tells_junk_from_prose(spark):
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.judge(sf, quality.references(sf)).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in out if r["quality"] == 1], [r["kept"] for r in out if r["quality"] == 0]
    assert all(good) and len(good) > 100 and sum(bad) <= 0.1 * len(bad)


def test_quality_of_rare_and_null_languages(spark):
    """Clean texts in a script of their own are not held against others, however few they are, and short texts count."""
    r = random.Random(3)
    text = lambda signs, n: " ".join("".join(r.choice(signs) for _ in range(r.randint(2, 9))) for _ in range(n))
    latin, greek, russian = "etaoinshrdlu", "αβγδεζηθικλμνοπρστυ", "абвгдежзиклмнопрсту"
    table = [(i, text(latin, 100), "en") for i in range(60)] + [(100, text(greek, 200), "el"), (101, text(russian, 200), None)]
    table += [(200 + i, text(russian, 30), "ru") for i in range(80)] + [(300, text(latin, 200), "ru"), (301, text(latin, 200), None)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    found = quality.references(docs)
    assert set(found) == {"en", "ru"} and found["ru"]["counts"].sum() == 80 * 30 + 200
    got = {x["doc_id"]: x for x in quality.judge(docs, found).collect()}
    for i in (100, 101, 301):
        assert got[i]["kept"] and got[i]["char_distance"] is None and got[i]["word_distance"] is None
    assert got[300]["char_distance"] > quality.RULES.char_distance and not got[300]["kept"]


def test_quality_rows_keep_columns(spark):
    docs = documents(spark)
    kept = quality.judge(docs, quality.references(docs), row=True)
    assert kept.schema == docs.schema
    verdicts = quality.judge(docs, quality.references(docs)).filter("kept")
    assert kept.count() == verdicts.count() > 10
    assert quality.judge(docs.limit(0), quality.references(docs.limit(0))).count() == 0


def test_token_counts(spark, small):
    library = Tokenizer.from_file(BPE)

    def count(text):
        return len(library.encode(text or "", add_special_tokens=False).ids)

    got = Counter(tuple(r) for r in token_counts.count_tokens(documents(spark), BPE, limit=20).collect())
    assert got == Counter((r[0], len((r[1] or "").encode()), count(r[1]), count(r[1]) > 20) for r in rows())
    out = QUERIES["op3_transducer_counts"](spark, small).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {i: count(t) for i, t in small_docs(spark, small).items()}
    assert token_counts.count_tokens(documents(spark).limit(0), BPE).count() == 0


def test_token_counts_fuzz(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 300)  # machines that start afresh
    monkeypatch.setattr(token_counts, "MAX_WORDS", 50)
    r = random.Random(4)
    signs = [*" \n\t'strevlmdaXé1½日.,-\x85", "　", "'ll", "'re", "<|endoftext|>", "😀", "\0", "the", " of"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(60))) for _ in range(3000)] + ["a" * 3000 + "b" * 3000]
    library = Tokenizer.from_file(BPE)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["n_tokens"] for x in token_counts.count_tokens(docs, BPE).collect()}
    assert [got[i] for i in range(len(texts))] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_words_start_where_the_pattern_says():
    import regex

    table, said = token_counts.splitter()
    classes = token_counts.character_classes()
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice(" \n'strevlmdaX1.é　") for _ in range(r.randrange(1, 700)))
        stream = classes[np.array([*map(ord, text), token_counts.SENTINEL])]
        expected = [m.start() for m in regex.finditer(public_tokenizers.PATTERN, text)] + [len(text)]
        assert token_counts.word_starts(stream, table, said).tolist() == expected


def test_sentencepieces(spark, small):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = sentencepieces.encode(documents(spark), PIECES, keep=("doc_id", "text", "ids")).toDF("doc_id", "text", "old", "ids", "n_tokens", "decoded", "same").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((r[0], r[1]) for r in rows())
    for r in out:
        ids = None if r["text"] is None else library.encode(r["text"])
        assert r["ids"] == ids and r["n_tokens"] == (None if ids is None else len(ids))
        assert r["decoded"] == (None if ids is None else library.decode(ids)) and r["same"] == (r["decoded"] == r["text"])
    texts = small_docs(spark, small)
    for r in QUERIES["op1_sentencepiece"](spark, small).collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["same_text"]
    assert sentencepieces.encode(documents(spark).limit(0), PIECES).count() == 0
    assert sentencepieces.encode(documents(spark), PIECES, back=()).columns == ["doc_id", "ids", "n_tokens"]


def encoded_lists(encoder, texts):
    """Ids of each text, and that they decode as the pieces say."""
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    return [ids[b - n : b].tolist() for b, n in zip(ends, counts)], list(encoder.decode(ids, counts))


def test_sentencepieces_of_long_texts():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = sentencepieces.Encoder(sentencepieces.read_model(PIECES))
    texts = ["a" * 300_000, " " * 50_000, "ab" * 40_000, "the" * 500 + " end", "日本" * 3000, "", "▁" * 300, "é" * 999, "x", "-" * 5000, "\n" * 700, "1" * 2000]
    assert encoded_lists(encoder, texts) == (library.encode(texts), library.decode(library.encode(texts)))


@pytest.mark.parametrize("long", [3, 256])
def test_sentencepieces_fuzz(monkeypatch, long):
    monkeypatch.setattr(sentencepieces, "MAX_SEGMENTS", 200)
    monkeypatch.setattr(sentencepieces, "INDEX_BYTES", 2000)
    monkeypatch.setattr(sentencepieces, "PAIR_SLOTS", 6)
    monkeypatch.setattr(sentencepieces, "TOKENS", 100)
    monkeypatch.setattr(sentencepieces, "LONG", long)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = sentencepieces.Encoder(sentencepieces.read_model(PIECES))
    r = random.Random(9)
    signs = [" ", "  ", " " * 17, "▁", "\n", *"etasé日本😀1", "th", "he", "in", "er", "on", "tion", "00", "...", "==", "the", "of", "\0"]
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(30))) for _ in range(4000)]
    assert encoded_lists(encoder, texts) == (library.encode(texts), library.decode(library.encode(texts)))
    assert encoded_lists(encoder, [])[0] == [] and encoded_lists(encoder, ["", ""])[0] == [[], []]


def test_suffix_array():
    r = np.random.default_rng(3)
    for n in (1, 2, 50, 400):
        text = r.integers(97, 100, n).astype(np.uint8)
        order = sentencepieces.suffix_array(text, 20).tolist()
        data = text.tobytes()
        assert [data[i:][:20] for i in order] == sorted(data[i:][:20] for i in range(n))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


WORDS_AND_IDS = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[A-Z]?[a-z]+([-_/+]+[A-Z]?[a-z]+)*", r"[A-Z]+([-_/+]+[A-Z]+)*",
    r"[0-9]+([-_/+]+[0-9]+)*", r"(sha1|sha256|sha384|sha512|md5)-.*",
)


def entropy_spans(text, kind):
    for m in re.finditer(f"[{kind.chars}]{{{kind.window},}}", text):
        run = m.group()
        if any(re.fullmatch(a, run) for a in WORDS_AND_IDS):
            continue
        best = 0.0
        listed = [x.span() for x in re.finditer("abcdefghij|ABCDEFGHIJ|0123456789|EXAMPLE", run)]
        for i in range(len(run) - kind.window + 1):
            if any(i < b and a < i + kind.window for a, b in listed):
                continue
            counts = Counter(run[i : i + kind.window]).values()
            best = max(best, -sum(c / kind.window * math.log2(c / kind.window) for c in counts))
        if best >= kind.bits - 1e-6:
            yield m.span()


def secrets_of(text):
    text = text or ""
    base = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    more = [(a, 3 + i, b) for i, kind in enumerate(secrets.CLASSES) for a, b in entropy_spans(text, kind)]
    join = lambda spans: ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(s[1] == k for s in base) for k in range(3)), hashlib.sha256(join(base).encode()).hexdigest(), join(base + more))


def test_secrets(spark, small):
    r = random.Random(8)
    texts = dict(enumerate(x[1] for x in rows())) | {1000 + i: t for i, t in small_docs(spark, small).items()}
    signs = ["token", "=", "TOKEN", ":", " ", "'", "AKIA", "ABCD", "api_key", "secret", "deadbeef", "00ff11", "Zz/+", "x9Q", "é", "😀", "\n", "a.b", "01234567-89ab-cdef-0123-456789abcdef"]
    for i in range(400):
        texts[5000 + i] = "".join(r.choice(signs) for _ in range(r.randrange(40)))
    for i in range(60):
        texts[9000 + i] = "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789+/"[: r.choice([12, 30, 58])]) for _ in range(r.choice([23, 24, 30, 64, 2500])))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs.write.mode("overwrite").parquet(folder := f"{spark.conf.get('spark.checkpoint.dir')}/secret-test/documents.parquet")
    out = QUERIES["op10_secret_scan"](spark, folder.rsplit("/", 1)[0]).collect()
    assert {x["doc_id"]: tuple(x[1:]) for x in out} == {i: secrets_of(t) for i, t in texts.items()}
    assert any("random_base64" in x["spans"] for x in out) and any("random_hex" in x["spans"] for x in out)


def test_secrets_of_every_alphabet():
    """Random tokens are caught with their alphabet's share, names and paths are not."""
    r = random.Random(3)
    for name, chars in (
        ("random_base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), ("random_hex", "0123456789abcdef"),
        ("random_alnum", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ):
        kind = next(k for k in secrets.CLASSES if k.name == name)
        hits = sum(bool(list(entropy_spans("".join(r.choice(chars) for _ in range(24)), kind))) for _ in range(1000))
        assert hits > 975
    for text in ("internationalization_of_responsibilities", "src/main/java/org/example/Application", "A_VERY_LONG_CONSTANT_NAME_INDEED"):
        assert not any(list(entropy_spans(text, kind)) for kind in secrets.CLASSES)


def test_secrets_in_very_long_runs(spark):
    """Runs of megabytes end without error; a key beside a documented example is found."""
    key = "q8Rz1LmT0vKp7Yw3Hs5Nd2Bf6Gj4Xc9"
    texts = [
        "ab-" * 1_000_000 + "ab", "1/" * 1_000_000 + "1", "AB_" * 300_000 + "AB", "Ab+" * 300_000 + "Ab", "x" * 10_000_000, "é" * 100_000 + key,
        "ab-" * 5000 + key, "EXAMPLE" + key, "EXAMPLE" + key[:20] + "EXAMPLE", key + "0123456789", "a" * 3000 + key + "a" * 3000,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    spans = {r["doc_id"]: {secrets.KINDS[s["rank"]] for s in r["secret_spans"]} for r in secrets.scan(docs).collect()}
    assert not any(spans[i] for i in (0, 1, 2, 3, 4, 8))
    assert all("random_base64" in spans[i] for i in (5, 6, 7, 9, 10)) and all("random_alnum" in spans[i] for i in (5, 7, 9, 10))
    masked = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert masked[0] == texts[0] and masked[7] == "[SECRET]" and masked[8] == texts[8]


def test_secrets_plan_is_native(spark):
    plan = secrets.scan(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_redact(spark):
    docs = documents(spark)
    out = secrets.redact(docs, mask="#")
    assert out.schema == docs.schema
    got = {r["doc_id"]: r["text"] for r in out.filter("doc_id is not null and doc_id != 7 and doc_id != 30").collect()}
    for r in rows():
        if r[0] in (None, 7, 30):
            continue
        expected, at = ("" if r[1] is not None else None), 0
        for a, b in sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in secrets_of(r[1])[4].split(",") if x):
            if a >= at:
                expected += r[1][at:a] + "#"
            at = max(at, b)
        if r[1] is not None:
            expected += r[1][at:]
        assert got[r[0]] == expected
    assert out.filter(F.col("text").contains("#") & F.col("text").contains(" and ")).count() == 1
