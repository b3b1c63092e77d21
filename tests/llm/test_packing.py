import sys
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import packing as p
from tallyloom.llm.queries import vocabulary

TEXTS = ["", None, "Hello, World's end... ÀÉß don't", "a b c\n\tD  ", "I'll Été,;x 12345 日本語",
         "<|endoftext|> x<|startoftext|>y", "é ́e İSTANBUL ΣΑΣ ẞ Ǆ", "word " * 9000,
         "x" * 5000, "\x00\x1c\x1f\x85a", "Aaa.Bbb Aaa, aaa! ﬁ Ⅷ"]


def test_ids_are_those_of_whole_texts(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    docs = spark.createDataFrame([(i % 9, t, "x") for i, t in enumerate(TEXTS)],
                                 "doc_id long, text string, length string")
    got = p.pack_documents(docs, vocabulary(), size=256).collect()
    want = []
    for i, text in enumerate(TEXTS):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, start in enumerate(range(0, len(ids), 256)):
            part = ids[start:start + 256]
            want.append((i % 9, k, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256


def best_fit_decreasing(lengths, size):
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(size - n)
    return len(free)


@pytest.mark.parametrize("mean, spread", [(1200, 900), (300, 500), (2500, 800), (1500, 300)])
def test_few_sequences(mean, spread):
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.normal(mean, spread, 3000).astype(np.int64), 1, p.SIZE)
    sequence, offset = p.pack(lengths)
    used = np.zeros(sequence.max() + 1, np.int64)
    np.add.at(used, sequence, lengths)
    assert used.max() <= p.SIZE and (used > 0).all() and (sequence >= 0).all()
    ends = {}
    for s, o, n in sorted(zip(sequence, offset, lengths)):
        assert ends.get(s, 0) == o
        ends[s] = o + n
    assert len(used) <= best_fit_decreasing(lengths.tolist(), p.SIZE) * 1.01 + 1
    assert len(used) >= -(-int(lengths.sum()) // p.SIZE)


def test_groups_and_empty_table(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some words " * (i % 50)) for i in range(400)],
                                 "doc_id long, text string")
    monkeypatch.setattr(p, "GROUP", 64)
    found = p.token_pieces(docs, vocabulary())
    got = p.pack_pieces(found, group=64).collect()
    assert len(got) == 400 and len({r.sequence_id >> 32 for r in got}) > 3
    assert p.pack_documents(docs.where("false"), vocabulary()).collect() == []


def test_bounded_cache_and_the_ids_of_each_part(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(p, "CACHED", 100)
    monkeypatch.setattr(p, "MISSED", 50, raising=False)
    tokens, whole = p.Tokens(vocabulary()), Tokenizer.from_file(vocabulary())
    parts = [f"{'Wo' if i % 3 else 'wö'}rd{'abcdefghij'[i % 10]}{chr(97 + i // 100)}{'.,'[i % 2]}"
             f"{i if i % 7 == 0 else ''}" for i in range(2000)]
    for turn in (parts, parts[::-1]):
        for part, ids in zip(turn, tokens.of(turn)):
            assert ids == np.array(whole.encode(part, add_special_tokens=False).ids,
                                   "<u4").tobytes()
    kept = [x for x in vars(tokens).values() if isinstance(x, p.Recent)]
    assert sum(len(x.new) + len(x.old) for x in kept) <= 2 * (100 + 2 * 50)


def test_little_memory_beside_a_batch():
    """The ids of a batch are gathered bit by bit: 8 MB of text take some 60 MB, not 120."""
    column = pa.array(["a word and more, " * 100] * 4700)
    tokens = p.Tokens(vocabulary())
    tracemalloc.start()
    try:
        ids, counts = p.batch_ids(column, tokens)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(ids) == counts.sum() > 2_000_000 and peak < 90 << 20


def test_known_words_cost_no_python_call_for_each_part():
    """Parts are looked up as Arrow arrays: once its words are known, a text takes few calls."""
    from tokenizers import Tokenizer

    marks = ["", *map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]),
             "...", "'#", "<|", "|>", "$$$", "\\]\"", "-_'"]
    words = [f"w\u00f6{a}{b}r" for a in "abcdefghij" for b in "klmnopqrst"]
    parts = [w + m for w in [*words, *map(str.upper, words)] for m in marks]
    column = pa.array([" ".join(parts), None, "", " ".join(parts[::-1])])
    tokens, whole = p.Tokens(vocabulary()), Tokenizer.from_file(vocabulary())
    want = [whole.encode(x or "", add_special_tokens=False).ids for x in column.to_pylist()]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    for known in (False, True):
        sys.setprofile(count if known else None)
        try:
            ids, counts = p.batch_ids(column, tokens)
        finally:
            sys.setprofile(None)
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]
    assert calls < 500 < len(parts)


def test_long_words_are_not_kept():
    tokens = p.Tokens(vocabulary())
    first = tokens.of(["a" * 10_000, "short"])
    assert tokens.words.new["word"].to_pylist() == ["short", ""]
    assert tokens.of(["a" * 10_000, "short"]) == first
