"""The parts of the operators, against slow and plain versions."""

import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratiform.llm import encoding, minhash, order, packing, substrings, toxicity, warc, words
from stratiform.llm.transducer import MARK, transducer

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = Tokenizer.from_file(encoding.BYTE_BPE)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TEXT = st.lists(st.sampled_from([*"abcdethin  \n\t▁-=*é日①​\x00<s>", "\U0001f600", "ing", "    "]), max_size=40).map("".join)


def packed_one_by_one(sizes, length):
    """Best-two-fit as it is told: bin by bin, piece by piece."""
    left, bins = Counter(sizes), 0
    while +left:
        used, gap = [], length
        while fits := [s for s in left if left[s] and s <= gap]:
            used.append(max(fits))
            left[used[-1]] -= 1
            gap -= used[-1]
        while gap:
            small = min(used)
            pairs = [(a + b, a, b) for a in left for b in left if a >= b and left[a] and left[b] > (a == b) and small < a + b <= small + gap]
            if not pairs:
                break
            total, a, b = max(pairs)
            used.remove(small)
            left[small] += 1
            used += [a, b]
            left[a] -= 1
            left[b] -= 1
            gap -= total - small
        bins += 1
    return bins


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_planned_bins_are_those_of_packing_one_by_one(sizes):
    counts = np.bincount(sizes, minlength=25) if sizes else np.zeros(25, np.int64)
    bins = packing.best_two_fit(counts, 24)
    assert sum(n for _, n in bins) == packed_one_by_one(sizes, 24)
    assert all(sum(s * n for s, n in used.items()) <= 24 for used, _ in bins)
    spread = Counter()
    for used, again in bins:
        spread.update({s: n * again for s, n in used.items()})
    assert spread == Counter(sizes)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_other_library(text):
    for t in (text, text + "<|endoftext|>" + text, " ".join([text] * 3)):
        assert encoding.encode(t, encoding.BYTE_BPE).tolist() == BYTES.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 1_000_000 + "b<|endoftext|>"])
def test_long_white_space_is_encoded(run):
    assert encoding.encode(run, encoding.BYTE_BPE).tolist() == BYTES.encode(run, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_transducer_counts_and_composes(text, size):
    machine = transducer(PIECES)
    n = len(LIBRARY.encode(text))
    assert machine.count(text) == n
    maps = [machine.chunk((MARK if a == 0 else "") + text[a : a + size]) for a in range(0, len(text), size)]
    assert machine.through(maps) == n
    if maps:
        left, right = maps[0], maps[-1]
        for m in maps[1:]:
            left = left.then(m, machine)
        for m in maps[-2::-1]:
            right = m.then(right, machine)
        assert left.closed(machine) == right.closed(machine) == n


def test_transducer_reads_a_text_without_spaces_in_one_pass():
    text = "ab" * 50_000 + "-" * 50_000
    assert transducer(PIECES).count(text) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_order_is_a_permutation_and_depends_on_the_seed(n):
    slots = order.Order(n).slots(np.arange(n))
    assert sorted(slots) == list(range(n))
    if n > 100:
        assert (slots != order.Order(n, "other").slots(np.arange(n))).any()


def test_words_are_hashed_by_their_bytes_alone(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 64)
    text = (" a bb\tccc " * 30 + "x" * 500 + "\n\x0b" + "y" * 80).encode()
    found = words.word_hashes(text)
    parts = text.split()
    assert len(found) == len(parts)
    assert len(set(found.tolist())) == len(set(parts))
    assert len({(h, p) for h, p in zip(found.tolist(), parts)}) == len(set(parts))


def test_super_kmers_cover_each_window_once_and_meet_equal_ones():
    rng = random.Random(3)
    text = " ".join(rng.choice("abc") for _ in range(300))
    parts = text.split()
    for window, size in ((10, 4), (5, 5), (7, 1)):
        hashes, first, windows = substrings.super_kmers(text.encode(), window, size)
        assert [p for f, n in zip(first, windows) for p in range(f, f + n)] == list(range(len(parts) - window + 1))
        seen = {}
        for h, f, n in zip(hashes.tolist(), first, windows):
            for p in range(f, f + n):
                assert seen.setdefault(tuple(parts[p : p + window]), h) == h


def test_bounds_of_the_comparison_keep_what_is_similar():
    least = minhash.least_matches(80, 1e-6)
    assert list(least) == sorted(least) and least[-1] < 0.8 * minhash.HASHES
    rng = np.random.default_rng(1)
    lost = 0
    for _ in range(300):
        both, other = rng.integers(0, 1 << 63, 400).astype(np.uint64), rng.integers(0, 1 << 63, 100).astype(np.uint64)
        a, b = minhash.signature(np.concatenate((both, other[:50]))), minhash.signature(np.concatenate((both, other[50:])))
        alive, _ = minhash.surviving(a[None], b[None], 80, 1e-6)
        lost += not len(alive) or not (minhash.band_keys(a[None]) == minhash.band_keys(b[None])).any()
    assert lost == 0


def test_obfuscated_words_are_restored():
    texts = ["the idiot and the moron are stupid losers and clowns", "trash is worthless and disgusting, a pathetic loser said"] * 50
    counts = np.full((toxicity.CLASSES,) * 3, 0.1)
    counts += toxicity.trigrams(texts).reshape(counts.shape)
    decoder = toxicity.Decoder(-np.log(counts / counts.sum(axis=2, keepdims=True)))
    for written, meant in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("m0r0n", "moron"), ("s.t.u.p.i.d", "stupid"), ("tr@sh", "trash"), ("looooser", "loser"), ("and", "and"), ("stupid!!", "stupid")):
        assert decoder.text(written) == meant
        assert meant in decoder.words(f"said {written} then")
    assert decoder.text("") == "" and decoder.words(" \n") == set()


def test_borders_and_signs_of_any_length_are_decoded():
    texts = ["the idiot and a moron are stupid, you are a dumbass and an ass, you suck", "a moron is a moron, a clown and a pathetic loser, an ass said you idiot"] * 50
    counts = np.full((toxicity.CLASSES,) * 3, 0.1)
    counts += toxicity.trigrams(texts).reshape(counts.shape)
    decoder = toxicity.Decoder(-np.log(counts / counts.sum(axis=2, keepdims=True)))
    for written, meant in (
        ("you are a m o r o n", "you are a moron"), ("i d i o t s u c k", "idiot suck"), ("y o u i d i o t", "you idiot"),
        ("i d i o t!", "idiot"), ("i d i o t.", "idiot."), ("i d i o t,", "idiot,"), ("a$$", "ass"), ("dumba$$", "dumbass"), ("st" + "u" * 90 + "pid", "stupid"),
    ):
        assert decoder.text(written).rstrip("!") == meant
        assert set(meant.rstrip(".,").split()) <= decoder.words(written)
    assert decoder.text("i d i o t  " * 5000).split() == ["idiot"] * 5000


MARKUP = ["<", ">", "<p>", "</p>", "<b>", "<!--", "-->", "<head>", "<header x>", "</head >", "<script src=a>", "</script>", "<STYLE>", "</style", "<title>", "</title>", "&amp;", "&nbsp;", " ", "\n\t", "x", "<a href=", "<a ", "<html lang=", "lang=", '"en-US"', "href=", "é", "</"]


def by_regular_expressions(page):
    """The chain of replacements that the SQL is made of."""
    text = re.sub(warc.HIDDEN, " ", page, flags=re.A)
    text = re.sub(warc.TAG, "", re.sub(warc.BLOCK, "\n", re.sub(r"[\x20\x09-\x0D]+", " ", text), flags=re.A))
    text = re.sub(" +", " ", re.sub(r" *\n[ \n]*", "\n", warc.unescaped(text)))
    found = re.search(r"(?is)<title\b[^>]*>(.*?)</title\s*>", page, re.A)
    title = warc.unescaped(re.sub(r"[\x20\x09-\x0D]+", " ", found[1])).strip(" ") if found else ""
    lang = re.search(r"(?is)<html\b[^>]*\blang=\"?([A-Za-z-]+)", page, re.A)
    return re.sub(r"^[ \n]+|[ \n]+$", "", text), title or None, lang and lang[1], len(re.findall(r"(?is)<a\b[^>]*\bhref=", page, re.A))


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(MARKUP), max_size=30).map("".join))
def test_pages_are_read_as_by_regular_expressions(page):
    assert (warc.plain_text(page), warc.title(page), warc.language(page), warc.outlinks(page)) == by_regular_expressions(page)


@pytest.mark.parametrize("part", ["<!-- ", "<script>", "<style ", "<a href=", "<title>", "<title ", "<html lang=", "<p ", "&nbsp;", " \n", "<head>x", "</", "<!-- <script> <style> <head> <template> "])
def test_very_long_pages_are_read_in_linear_time(part):
    page, began = part * (5_000_000 // len(part)), time.perf_counter()
    for read in (warc.plain_text, warc.title, warc.language, warc.outlinks):
        read(page)
    assert time.perf_counter() - began < 20


def test_long_white_space_does_not_stall_the_search():
    text, began = (" " * 99_999 + "x") * 20, time.perf_counter()
    assert not encoding._LONG_RUN.search(text) and encoding._LONG_RUN.search(text + "\n" * 100_000)
    assert time.perf_counter() - began < 1


@pytest.mark.parametrize("size", [words.BLOCK // 4 - 1, words.BLOCK // 4, words.BLOCK - 1, words.BLOCK, words.BLOCK + 1, 3 * words.BLOCK])
@pytest.mark.parametrize("before", ["", " ", "a ", "  \n" * 40_000, "abc " * 70_000])
def test_a_word_has_one_hash_wherever_it_stands(size, before):
    word = b"w" * size
    alone = words.word_hashes(word)
    assert len(alone) == 1
    for text in (before.encode() + word, before.encode() + word + b" after", before.encode() + word + b" " + word):
        found = words.word_hashes(text)
        assert len(found) == len(text.split()) and found[len(before.split())] == alone[0]
