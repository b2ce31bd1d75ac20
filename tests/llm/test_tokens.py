"""Token files and packing against the tokenizers library and plain best fit."""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from courtlake.llm import packing, token_file, tokens
from courtlake.llm.common import text_slices
from courtlake.llm.queries import QUERIES
from courtlake.llm.tokens import Encoder
from courtlake.session import shared_dir

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
KINDS = {WORD: False, BYTE: True}


def plain(path, texts):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", KINDS)
def test_pieces_change_no_id(path):
    encoder = Encoder(path, KINDS[path])
    alphabet = st.sampled_from(list(" \n\t\r\x0b\x0c\x1c\x85\xa0 　aAéß'’s1٣.,!-́ΣИ中😀<|>") + [
        "  ", "<|endoftext|>", "'ll", "the", "퟿"])

    @settings(max_examples=150, deadline=None)
    @given(st.lists(alphabet, max_size=14).map("".join))
    def same(text):
        assert np.frombuffer(encoder.ids([text.encode()])[0], "<u4").tolist() == plain(path, [text])[0]

    same()


@pytest.mark.parametrize("path", KINDS)
def test_every_letter_before_a_mark(path):
    """Also letters that the tokenizer takes apart into a letter and a mark, which joins what follows."""
    encoder = Encoder(path, KINDS[path])
    letters = [c for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]) if c.isalnum()]
    for start in range(0, len(letters), 4000):
        texts = [f"MER{c}. x{c}, {c}. a{c}.{c}," for c in letters[start:start + 4000]]
        found = [np.frombuffer(i, "<u4").tolist() for i in encoder.ids([t.encode() for t in texts])]
        assert found == plain(path, texts)


@pytest.mark.parametrize("path", KINDS)
def test_plain_words_need_no_regular_expressions(path):
    encoder, words = Encoder(path, KINDS[path]), ["the", "Zyzzogeton", "QI", "a", "ofananst", "The", "the"]
    expected = [plain(path, [" " + w if KINDS[path] else w])[0] for w in words]
    encoder._tokenizer = None
    assert [np.frombuffer(i, "<u4").tolist() for i in encoder._encoded_words(words)] == expected


def test_words_of_a_slice_are_learned_once(monkeypatch):
    encoder, asked = Encoder(WORD, False), []
    learn = encoder._learn_words
    monkeypatch.setattr(encoder, "_learn_words", lambda pieces: (asked.extend(pieces), learn(pieces)))
    texts = [" one two, one\ttwo ", "", "one", "\n", "two, \u00c9one"]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.ids([t.encode() for t in texts])] == plain(WORD, texts)
    assert sorted(a for a in asked if a) == sorted(w.encode() for w in ["one", "two,", "two", "\u00c9one"])


def test_pieces_of_a_slice_are_learned_once(monkeypatch):
    """A word with and without a full stop or comma behind it is one piece; also over lines and texts."""
    encoder, asked = Encoder(BYTE, True), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: (asked.extend(pieces), learn(pieces))[1])
    texts = ["a one two, one.\ntwo one, two,\n\u00c9, one", "one two", "", "one  two", ",", "one,.", "a\0 b, c"]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.ids([t.encode() for t in texts])] == plain(BYTE, texts)
    assert len(asked) == len(set(asked))
    assert not {"two,", "one.", "one,"} & set(asked)


def test_other_tasks_free_the_tokenizers():
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [b"a b"]})
    first = tokens.encoder(WORD, False)
    list(text_slices([batch], encoding=True))
    assert tokens.encoder(WORD, False) is first
    list(text_slices([batch]))
    assert not tokens._encoders


def test_token_file(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    expected, start = {}, 0
    for row, ids in zip(docs, plain(WORD, [r.text for r in docs])):
        ids = ids + [2]
        expected[row.doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    found = QUERIES["op5_orc_token_ids"](spark, sf_dir).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected
    assert len(found) == len(expected)


def odd_rows(spark):
    rows = [(3, "a b", 1), (None, "c", 1), (1, None, 1), (2, "", 1), (3, "a b", 1), (3, "x y z", 1),
            (9, "long text " * 60_000, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int")


def test_token_file_edge_cases(spark):
    path = shared_dir(spark, "test-tokens")
    docs = odd_rows(spark)
    token_file.write_tokens(docs, path, WORD, False, 2)
    rows = sorted(token_file.token_digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 3, 3, 9]
    assert [r.n_tokens for r in rows[1:3]] == [1, 1]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows]).tolist()[:-1]
    assert {r.ids_crc32 for r in rows} == {crc(i + [2]) for i in plain(WORD, [r.text for r in docs.collect()])}
    some = token_file.token_digests(spark, path, [9, 77]).collect()
    assert [(r.doc_id, r.start) for r in some] == [(9, rows[-1].start)]
    empty = shared_dir(spark, "test-tokens")
    token_file.write_tokens(docs.limit(0), empty, WORD, False, 2)
    assert token_file.token_digests(spark, empty).count() == 0


def best_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, n)
        room = free.pop(at) if at < len(free) else capacity
        bisect.insort(free, room - n)
    return len(free)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300))
def test_plan(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.plan_slots(counts, 50)
    used, taken = {}, {n: [] for n in counts}
    for i, (length, rank, each, sequence, offset) in enumerate(plan.tolist()):
        later = [r for r in plan.tolist() if r[0] == length and r[1] > rank]
        stop = min((r[1] for r in later), default=counts[length])
        for t in range(rank, stop):
            taken[length].append(t)
            used.setdefault(sequence + (t - rank) // each, []).append((offset + (t - rank) % each * length, length))
    assert all(sorted(t) == list(range(counts[n])) for n, t in taken.items())
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 50
    assert len(used) == best_fit_decreasing(lengths, 50)


def check_packed(rows, texts, capacity=1024):
    """``texts``: (doc_id, text) in any order; ids may repeat."""
    expected = []
    for (doc_id, _), ids in zip(texts, plain(BYTE, [t for _, t in texts])):
        ids = ids + [2]
        first = len(ids) % capacity or capacity
        for piece, a in enumerate([0, *range(first, len(ids), capacity)]):
            part = ids[a:first if a == 0 else a + capacity]
            expected.append((doc_id, piece, a, len(part), crc(part)))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got, key=key) == sorted(expected, key=key)
    slots = {}
    for r in rows:
        slots.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in slots.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)]).tolist()
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= capacity
    assert len(slots) == best_fit_decreasing([r.length for r in rows], capacity)


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check_packed(QUERIES["op7_best_fit_packing"](spark, sf_dir).collect(), [tuple(r) for r in docs])


def test_packing_edge_cases(spark):
    docs = odd_rows(spark)
    packed = packing.pack(spark, docs, BYTE)
    rows = packed.collect()
    check_packed(rows, [(r.doc_id, r.text) for r in docs.collect()])
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert joined[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert packing.pack(spark, docs.limit(0), BYTE).count() == 0
