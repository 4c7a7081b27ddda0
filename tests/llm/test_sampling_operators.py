"""Toxicity, importance resampling and tokenizer alignment against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carryover.llm import alignment, resampling, tokens, toxicity
from carryover.llm.queries import public_tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
A_PATH, B_PATH = public_tokenizer(), public_tokenizer("piece_bpe_32k.model")


def docs_of(spark, texts, schema=DOCS):
    """A documents table, three partitions, with columns of clashing names."""
    rows = [(i, t, "en", "s", len(t or ""), 1, "x", 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, schema + ", score int, chunk string, segment int, rank int").repartition(3)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b\n\tc"), (5, "▁ has the mark"), (6, "<|endoftext|> x <s></s> <0x41>"), (7, "日本 語 é 😀"),
    (8, "it's 12,345 tokens"), (8, "the same id again"), (None, "no id"), (None, None), (9, "the the the"), (9, "the the the"), (10, "x" * 3000), (11, "trailing "), (12, "\r\n"),
]


# --- importance resampling


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=20))
def test_crc_matrices_equal_zlib(items):
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in items])]).astype(np.int64)
    got = resampling.crc_matrices(np.frombuffer(b"".join(items), np.uint8), offsets)
    assert got.tolist() == [zlib.crc32(i) for i in items]


def plain_resample(docs, target, ngram=1, buckets=10_000, least=20, percent=10, seed=2024):
    """Rows by the operator's definition, word by word."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    upper = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})

    def features(text):
        words = word.findall((text or "").translate(upper))
        return len(words), [" ".join(words[i : i + n]) for n in range(1, ngram + 1) for i in range(len(words) - n + 1)]

    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = counts(x for _, x in docs), counts(target)
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
    rows = []
    for doc_id, text in docs:
        n_words, own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in own)
        rows.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words))
    can = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = defaultdict(list)
    for i, r in enumerate(can[: percent * len(can) // 100]):
        ranks[r].append(i + 1)
    return sorted(((*r[:4], ranks[r].pop(0) if ranks[r] else None) for r in rows), key=repr)


@pytest.mark.parametrize("ngram, buckets, percent", [(1, 10_000, 10), (2, 50, 50), (3, 997, 100)])
def test_resampling_equals_a_plain_version(spark, ngram, buckets, percent):
    rng = np.random.default_rng(ngram)
    docs = [(i, " ".join(rng.choice(["Red", "blue", "grün", "x9", "Zoë-7", "und", "a.b"], rng.integers(0, 40)))) for i in range(200)]
    docs += [*ODD, (500, "word " * 400), (500, "word " * 400), (501, "q" * 700 + " " + "z " * 30)]
    target = ["blue blue x9", None, "", "grün und blue q"]
    targets = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, doc_id string")
    got = resampling.importance_resample(docs_of(spark, docs), targets, ngram, buckets, 3, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(docs, target, ngram, buckets, 3, percent)


def test_resampling_of_empty_tables(spark):
    none = docs_of(spark, []).limit(0)
    target = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert resampling.importance_resample(none, target).collect() == []
    docs = [(i, "some words of text " * (i + 1)) for i in range(30)]
    got = resampling.importance_resample(docs_of(spark, docs), target.limit(0))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(docs, [])


# --- tokenizer alignment


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400))), max_size=6))
def test_galloping_finds_every_place(texts):
    """Ends of several texts end to end; a text's lists end alike."""
    short, long, short_first, long_first, base = [], [], [0], [0], 0
    for x, y in texts:
        top = max(x | y | {1})
        pair = sorted(sorted([x | {top}, y | {top}], key=len), key=len)
        short += [base + v for v in sorted(pair[0])]
        long += [base + v for v in sorted(pair[1])]
        short_first.append(len(short))
        long_first.append(len(long))
        base += top
    args = [np.asarray(v, np.int64) for v in (short, short_first, long, long_first)]
    assert alignment.intersect(*args).tolist() == np.searchsorted(args[2], args[0]).tolist()


def plain_alignment(docs):
    """Rows by the operator's definition, token by token."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a_side.encode_special_tokens = True
    a_bytes = tokens.byte_pairs(A_PATH).pieces
    encoded, held = [], Counter()
    for doc_id, text in docs:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        names = [b_side.id_to_piece(i) for i in b]
        b_parts = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
        a_parts = [a_bytes[i] for i in a]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            a, b, a_parts, b_parts = [], [], [], []
        spans = []
        for ids, own in ((a, a_parts), (b, b_parts)):
            ends = np.cumsum([len(p) for p in own]).tolist()
            spans.append(list(zip(ids, [0, *ends], ends)))
        links = [(x, y) for x, s, e in spans[0] for y, u, v in spans[1] if s < v and u < e]
        held.update(links)
        both = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, at = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for i, s, e in side if at <= s and e <= end) for side in spans))
            at = end
        encoded.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = Counter()
    for (_, y), n in held.items():
        top[y] = max(top[y], n)
    return sorted(
        ((i, a, b, g, len(links), sum(held[x] == top[x[1]] for x in links), sum(held[x] for x in links), sha) for i, a, b, g, links, sha in encoded), key=repr
    )


@pytest.mark.parametrize("segments", [1, 7])
def test_alignment_equals_a_plain_version(spark, monkeypatch, segments):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(40).collect()
    docs = [(r["doc_id"], r["text"][:900]) for r in texts] + ODD
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 9000)
    got = alignment.align_tokenizers(docs_of(spark, docs), A_PATH, B_PATH, segments)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_alignment(docs)


def test_alignment_of_an_empty_table_and_of_none_but_empty_texts(spark):
    assert alignment.align_tokenizers(docs_of(spark, []).limit(0), A_PATH, B_PATH).collect() == []
    got = alignment.align_tokenizers(docs_of(spark, [(1, None), (2, "")]), A_PATH, B_PATH, 3).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("text", [
    "", " ", "a  b", "<|endoftext|>", "x <|endoftext|> y", " " * 300_000 + "x", "\n" * 300_000, "^" * 50_000, "it's　日本 \x1c\x85 é", "a" * 100_000,
])
def test_byte_pairs_equal_the_tokenizer(text):
    own = tokens.byte_pairs(A_PATH)
    assert own.encode(text, special=True).tolist() == own.marked.encode(text, add_special_tokens=False).ids
    assert own.encode(text, special=False).tolist() == own.plain.encode(text, add_special_tokens=False).ids


# --- toxicity


def toxic_corpus(n=400, seed=5):
    """Ordinary texts of invented words; every fifth has insults among them."""
    rng = np.random.default_rng(seed)
    syllables = ["an", "the", "or", "ti", "re", "lo", "mi", "ver", "sen", "ka", "po", "du"]
    vocabulary = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(1500)]
    insults = ["blockhead", "numbskull", "dimwitted"]
    docs, labels = [], []
    for i in range(n):
        words = [str(w) for w in rng.choice(vocabulary, rng.integers(30, 120))]
        if i % 5 == 0:
            for at in rng.integers(0, len(words), len(words) // 12):
                words[at] = insults[int(rng.integers(3))]
        docs.append((i, " ".join(words)))
        labels.append((i, 0, int(i % 5 == 0)))
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_tells_held_out_documents_apart(spark):
    docs, labels = toxic_corpus()
    copies = [(1000 + i, docs[1][1]) for i in range(200)]  # copies of an ordinary text, labelled
    rows = toxicity.toxicity(docs_of(spark, docs + copies + ODD), labels_of(spark, labels + [(i, 0, 0) for i, _ in copies])).collect()
    assert len(rows) == len(docs) + len(copies) + len(ODD)
    truth = {i: t for i, _, t in labels}
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    judged = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth and r["doc_id"] > 12]
    assert len(judged) > 50
    caught = sum(p for t, p in judged if t) / sum(t for t, _ in judged)
    wrong = sum(p for t, p in judged if not t) / sum(not t for t, _ in judged)
    assert caught >= 0.9 and wrong <= 0.05


def test_toxicity_scores_are_those_of_single_texts(spark):
    """Scoring by hand, one text and window at a time, with the model the operator learns."""
    docs, labels = toxic_corpus(200)
    table, marks = docs_of(spark, docs + [(5000, "word " * 40_000), (5001, None)]), labels_of(spark, labels)
    model = toxicity.fit(table, marks)
    plain, other = toxicity.compressor(model.ordinary), toxicity.compressor(model.toxic + model.ordinary)

    def score(text):
        seen = np.zeros((1, toxicity.BINS), np.int64)
        for w in toxicity.windows((text or "").encode()):
            seen[0, int(np.clip(len(plain.compress(w)) - len(other.compress(w)) + toxicity.LOWEST, 0, toxicity.BINS - 1))] += 1
        return float(model.scores(seen)[0])

    for r in toxicity.toxicity(table, marks).join(table.select("doc_id", "text"), "doc_id").collect():
        assert r["score"] == pytest.approx(score(r["text"]), abs=1e-12)


def test_windows_hold_the_whole_text():
    for text in (b"", b"a", b"word " * 1000, b"x" * 5000, "é\n".encode() * 300, b"A B\tC\n" * 50):
        assert b"".join(toxicity.windows(text)) == b" %s " % text.lower()


def test_held_out_and_conflicting_labels_do_not_train(spark):
    docs, labels = toxic_corpus(200)
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0]
    table = docs_of(spark, docs)
    first = toxicity.toxicity(table, labels_of(spark, labels))
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels] + [(None, 0, 1), (7000, 0, None), (7001, 1, 1)]
    second = toxicity.toxicity(table, labels_of(spark, turned))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    both = [(i, 0, t) for i, _, _ in labels for t in (0, 1)]
    assert {(r["score"], r["predicted"]) for r in toxicity.toxicity(table, labels_of(spark, both)).collect()} == {(0.0, 0)}


def test_toxicity_without_a_class_and_of_empty_tables(spark):
    docs, labels = toxic_corpus(60)
    none = docs_of(spark, []).limit(0)
    assert toxicity.toxicity(none, labels_of(spark, labels)).collect() == []
    rows = toxicity.toxicity(docs_of(spark, docs), labels_of(spark, [(i, 0, 0) for i, _ in docs])).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}
    rows = toxicity.toxicity(docs_of(spark, docs), labels_of(spark, labels).limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in rows} == {(0.0, 0)}
