"""Packing, language ID, near-duplicates and substring removal against plain versions."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carryover.llm import dedup, language, packing, substrings, textcore
from carryover.llm.queries import public_tokenizer
from carryover.llm.tokens import byte_pairs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts, extra=""):
    """A documents table, three partitions, with columns of clashing names."""
    rows = [(i, t, "en", "s", len(t or ""), "x", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS + ", score string, label int").repartition(3)


def random_texts(seed, n, vocabulary=30, longest=60):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{v}" for v in rng.integers(0, vocabulary, rng.integers(0, longest))) for _ in range(n)]


# --- words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x1c\x85 Ω", max_size=30)), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    buf, offsets = textcore.join_texts([None if t is None else t.encode() for t in texts])
    starts, ends, first = textcore.find_words(buf, offsets)
    raw = buf.tobytes()
    for i, t in enumerate(texts):
        own = [raw[a:b].decode() for a, b in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])]
        assert own == WORD.findall(t or "")


def test_equal_words_hash_alike():
    words = ["alpha", "be", "gamma-delta-epsilon-zeta", "be", "alpha"] * 5
    buf, offsets = textcore.join_texts([" ".join(words).encode()])
    starts, ends, _ = textcore.find_words(buf, offsets)
    for hashes in textcore.hash_spans(buf, starts, ends):
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


def thue_morse(n):
    """A word over a, b and its complement: alike under any polynomial hash modulo a power of two."""
    bits = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return bits, bits.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_words_alike_under_polynomial_hashes_are_told_apart(spark, n):
    one, two = thue_morse(n)
    buf, offsets = textcore.join_texts([f"{one} {two}".encode()])
    starts, ends, _ = textcore.find_words(buf, offsets)
    assert all(x[0] != x[1] for x in textcore.hash_spans(buf, starts, ends))
    rest = " ".join(f"w{i}" for i in range(12))
    docs = docs_of(spark, [(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, one), (4, two)])
    assert {(r.doc_id, r.n_removed) for r in substrings.remove_repeats(docs).collect()} == {(1, 0), (2, 0), (3, 0), (4, 0)}
    found = dedup.near_duplicates(docs_of(spark, [(1, one), (2, two), (3, f"{one} a b c d"), (4, f"{two} a b c d")]), k=5).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(i, i, True) for i in (1, 2, 3, 4)}


def test_arrangements_of_two_words_hash_apart():
    """Windows of two words in the arrangements that cancel out in a polynomial."""
    for k in (4, 8, 13, 16):
        for seed in (1, 2):
            pair = np.asarray([11, 2**63 + 7], np.uint64)
            rows = [pair[[bin(i).count("1") % 2 ^ turned for i in range(k)]] for turned in (0, 1)]
            assert textcore.hash_ngrams(rows[0], k, seed)[0] != textcore.hash_ngrams(rows[1], k, seed)[0]


# --- packing


@pytest.mark.parametrize("text", [
    "", " ", " a", "a ", "a  b c\n d", "x　y z   q", "x\n\ny  ", "<|endoftext|> a <|endoftext|> b", "  a b",
    "日本 語   é é", "tab\t a b", "it's 're a's don't", "a \x1c b c", "a\x85 b \x85c d", "1234 5 6.7 -- !!", "é ü ñ Ω ж", "word" * 300 + " " + "long" * 200,
])
def test_ids_are_the_tokenizers(text):
    from tokenizers import Tokenizer

    path = public_tokenizer()
    wanted = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert byte_pairs(path).encode(text, special=True).tolist() == wanted


def test_packed_words_alike_under_polynomial_hashes_keep_their_own_ids(spark):
    import zlib

    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizer())
    texts = [(i, f"first {w} last") for i, w in enumerate([*thue_morse(1024), *thue_morse(2048)])]
    for r in packing.pack_documents(docs_of(spark, texts), public_tokenizer()).collect():
        ids = [*own.encode(dict(texts)[r.doc_id], add_special_tokens=False).ids, 0]
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_takes_the_tightest_open_bin(lengths):
    lengths = sorted(lengths, reverse=True)
    left: list[int] = []
    wanted = []
    for x in lengths:
        fitting = [c for c in left if c >= x]
        wanted.append(min(fitting) if fitting else None)
        if fitting:
            left[left.index(min(fitting))] -= x
        else:
            left.append(20 - x)
    bins, offsets = packing.best_fit(lengths, 20)
    used: dict[int, int] = {}
    for x, b, at, want in zip(lengths, bins, offsets, wanted):
        assert at == used.get(b, 0)
        assert (b not in used) == (want is None) and (want is None or 20 - used[b] == want)
        used[b] = at + x
    assert len(used) == len(left)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    texts = list(enumerate(random_texts(3, 40, 500, 900))) + [(100, None), (101, ""), (102, "same"), (102, "same"), (None, "no id"), (103, "a " * 5000)]
    out = packing.pack_documents(docs_of(spark, texts), public_tokenizer(), capacity=256, group_size=30).collect()
    tokenizer = Tokenizer.from_file(public_tokenizer())
    pieces = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        stop, at, n = len(ids) % 256 or 256, 0, 0
        while at < len(ids):
            pieces[doc_id, n, at, stop - at, zlib.crc32(np.asarray(ids[at:stop], "<u4").tobytes())] += 1
            at, stop, n = stop, stop + 256, n + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == pieces
    bins: dict = {}
    for r in out:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= 1.1 * sum(r.length for r in out) / 256 + 4


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(docs_of(spark, []).limit(0), public_tokenizer()).count() == 0


# --- language


def test_language_cases(spark):
    en = "the cat and the dog went to the house with a hat "
    de = "der hund und die katze gingen nicht ohne einen hut "
    rows = [(i, (en if i % 2 else de) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", "de"), (102, "123 !? —", "en"), (103, en, None), (None, de, None), (104, en * 20 + de * 20, None), (105, "日本語", None), (106, en, "en"), (106, en, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "'y' AS lang_pred")
    out = {r.doc_id: r for r in language.identify(docs.repartition(3)).collect()}
    assert all(out[i].lang_pred == ("en" if i % 2 else "de") for i in range(60))
    assert [out[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and out[100].score == 0
    assert out[103].lang_pred == "en" and out[None].lang_pred == "de" and out[105].lang_pred != "und"
    assert set(out[104].lang_shares) == {"en", "de"} and 0.3 < out[104].score < 0.7
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == r.held_out for i, r in out.items() if i is not None)
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(out) - {100, 101, 102}
    assert language.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in language.identify(docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()} == {"und"}


def test_nothing_learned_rejects_only_rows_without_a_letter(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    rows = [(held, "the cat and the dog", "en"), (None, "der hund", "de"), (200, "日本語", None), (201, "é", None), (202, "123 !?", None), (203, "", None), (204, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score")
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.lang) for r in kept.collect()} == {(held, "en"), (None, "de"), (200, None), (201, None)}


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null")
    assert out.where("lang = lang_pred").count() >= 0.98 * out.count()


# --- near duplicates


def sets_of(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def components_of(texts, k, percent):
    sets = [(i, sets_of(t, k)) for i, t in texts]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets}


def edited(rng, words, share):
    return [f"e{rng.integers(10**9)}" if rng.random() < share else w for w in words]


def test_near_duplicates_like_all_pairs(spark):
    rng = np.random.default_rng(11)
    texts, base = [], [f"w{v}" for v in rng.integers(0, 10**6, 150)]
    for i in range(160):  # one family with few and many edits around the threshold
        texts.append(" ".join(edited(rng, base, rng.choice([0.0, 0.01, 0.03, 0.06, 0.1]))))
    for _ in range(30):  # small families sharing a passage
        own = [f"w{v}" for v in rng.integers(0, 10**6, 80)] + base[:70]
        texts += [" ".join(own), " ".join(own).upper(), " ".join(own[:-2]) + " x\ty"]
    texts += ["", None, " \n", "one two", "One  two", "one two three", "a b c d", "A b c d", "a b c d e"]
    texts += [" ".join(edited(rng, ["p", "q", "r", "s", "t", "u"] * 5, 0.05)) for _ in range(20)]
    texts = list(enumerate(texts))
    out = {r.doc_id: r for r in dedup.near_duplicates(docs_of(spark, texts), k=4).collect()}
    wanted = components_of(texts, 4, 80)
    assert {i: (r.n_shingles, r.component_id) for i, r in out.items()} == wanted
    assert all(r.kept == (r.component_id == i) for i, r in out.items())
    assert len({c for _, c in wanted.values()}) < 200


def test_near_duplicates_with_null_and_repeated_ids(spark):
    same = " ".join(f"w{i}" for i in range(40))
    texts = [(5, same), (5, same), (7, same + " end"), (None, same), (None, None), (9, "other")]
    docs = docs_of(spark, texts)
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in dedup.near_duplicates(docs).collect()), key=str)
    # a null id with a text counts with the class of its text, one without stands alone
    assert out == sorted([(5, 5, True), (5, 5, True), (7, 5, False), (None, 5, True), (None, None, True), (9, 9, True)], key=str)
    kept = dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [5, 9]
    assert dedup.near_duplicates(docs.limit(0)).count() == 0 and dedup.keep_one_each(docs.limit(0)).count() == 0


def test_near_duplicates_of_texts_that_share_an_id(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    texts = [(3, one), (5, one), (5, two), (7, two + " end"), (5, three), (4, three + " end"), (8, one + " end"), (5, two)]
    out = dedup.decided(docs_of(spark, texts), 5, 80)
    keys = {r.tkey: r.text for r in docs_of(spark, texts).selectExpr("text", "xxhash64(text) AS tkey").collect()}
    got = Counter((r.doc_id, keys[r.tkey], r.component_id, r.kept) for r in out.collect())
    wanted = [(3, one, 3, True), (5, one, 3, False), (8, one + " end", 3, False), (5, two, 5, True), (5, two, 5, True), (7, two + " end", 5, False)]
    assert got == Counter(wanted + [(5, three, 4, False), (4, three + " end", 4, True)])
    kept = dedup.keep_one_each(docs_of(spark, texts)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(3, one), (5, two), (4, three + " end")])


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(2)
    universe = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    sets = [universe[:1], universe[:3], universe[:1000], universe[200:1200], universe[:0]]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sketch = dedup.sketches(np.concatenate(sets), offsets, 1024)
    unset = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (sketch[:4] != unset).all() and (sketch[4] == unset).all()
    assert abs((sketch[2] == sketch[3]).mean() - 800 / 1200) < 0.06


# --- repeated windows


def removed_by_hand(texts, k):
    words = [(i, WORD.findall(t or "")) for i, t in texts]
    first: dict = {}
    for i, w in words:
        for a in range(len(w) - k + 1):
            g = tuple(w[a : a + k])
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for i, w in words:
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                gone.update(range(a, a + k))
        out[i, len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone)] += 1
    return out


@pytest.mark.parametrize("chunk, segment", [(4 << 20, 12 << 20), (600, 900)])
def test_repeated_windows_like_all_windows(spark, monkeypatch, chunk, segment):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substrings, "SEGMENT_BYTES", segment)
    texts = list(enumerate(random_texts(21, 120, 3, 40)))
    passage = " ".join(f"p{i}" for i in range(20))
    texts += [(200 + i, f"a{i} {passage}\n b{i} é") for i in range(15)]
    texts += [(300, None), (301, ""), (302, " \t"), (303, passage), (303, passage), (304, "x " * 40), (305, "é" * 50)]
    out = substrings.remove_repeats(docs_of(spark, texts), k=6).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in out) == removed_by_hand(texts, 6)


def test_repeated_windows_null_ids_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(30))
    out = substrings.remove_repeats(docs_of(spark, [(None, long), (4, long), (2, "a b")]), k=13).collect()
    assert {r.doc_id: r.n_removed for r in out} == {None: 30, 4: 0, 2: 0}
    assert substrings.remove_repeats(docs_of(spark, [(1, "x")]).limit(0)).count() == 0


def test_a_counter_goes_to_one_segment_from_every_chunk():
    edge = 2**64 // 3
    cell = edge >> (64 - substrings.CELL_BITS)
    below, above = cell << (64 - substrings.CELL_BITS), edge + 5  # two windows of one cell, astride an edge
    segment = lambda h, cut: int(np.searchsorted(cut(h, 3), 0, "right")) - 1
    one, two = np.asarray([below], np.uint64), np.asarray([above], np.uint64)
    assert one >> np.uint64(64 - substrings.CELL_BITS) == two >> np.uint64(64 - substrings.CELL_BITS)
    assert segment(one, substrings._cuts) != segment(two, substrings._cuts)
    own = [segment(h >> np.uint64(64 - substrings.CELL_BITS), substrings._cell_cuts) for h in (one, two)]
    assert own[0] == own[1]


def test_packed_integers_come_back():
    for values in ([], [0], [0, 0, 5], [2**64 - 1, 7], list(range(1000))):
        x = np.asarray(values, np.uint64)
        assert substrings._unpack(substrings._pack(x), len(x)).tolist() == values
