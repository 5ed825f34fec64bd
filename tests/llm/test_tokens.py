"""Token counts, records and packing against the library itself."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import cases
from wattspan.llm import encode, packing, records, token_counts
from wattspan.llm.batches import slices


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encode.default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["Hello's  wORLD!!", "don't WE'LL I'd", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "a\x0bb c\x0cd\x1ce\x85f\xa0g　h",
       "ΑΣ ΑΣ.Β ΣΑ,", "é ́x a ̈", "İstanbul K ﬁ", "日本語 テスト", "1234 5.6 $$$ ###a'sb", "\x00 \x01a", "a\x7fb",
       "'S 'tis it'd've", "<|", "﻿abc"]


@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.sampled_from(ODD)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_have_the_librarys_ids(tokenizer, texts):
    coder = encode.encoder(encode.default_path())
    for lo, hi, data, off in slices(pa.array(texts, pa.string())):
        ids, ends = coder.encode(data, off)
        lengths = coder.lengths(data, off)
        for k in range(hi - lo):
            want = ids_of(tokenizer, texts[lo + k])
            assert ids[ends[k]:ends[k + 1]].tolist() == want and lengths[k] == len(want)


def test_full_table_starts_anew(tokenizer, monkeypatch):
    monkeypatch.setattr(encode, "MOST_WORDS", 50)
    coder = encode.WordEncoder(encode.default_path())
    texts = [t for _, t in cases.documents()]
    for size in (200, 5000):
        for lo, hi, data, off in slices(pa.array(texts, pa.string()), size):
            assert coder.lengths(data, off).tolist() == [len(ids_of(tokenizer, t)) for t in texts[lo:hi]]


def test_counts(spark, tokenizer):
    rows = cases.documents()
    got = {r.doc_id: tuple(r)[1:] for r in token_counts.token_counts(cases.frame(spark, rows)).collect()}
    assert got == {i: (len((t or "").encode()), n := len(ids_of(tokenizer, t)), n > 2048) for i, t in rows}
    assert token_counts.token_counts(cases.frame(spark, [])).count() == 0


def test_records_round_trip(spark, tokenizer, tmp_path):
    rows = cases.documents()
    got = sorted(tuple(r)[:4] for r in records.round_trip(cases.frame(spark, rows)).collect())
    want, start = [], 0
    for i, t in sorted(rows):
        ids = np.array([*ids_of(tokenizer, t), 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    assert records.round_trip(cases.frame(spark, [])).count() == 0


def test_records_of_many_files_and_repeated_rows(spark, tokenizer, tmp_path):
    rows = [(3, "b"), (3, "b"), (None, "a"), (1, None)] + [(10 + i, "word " * i) for i in range(30)]
    folder = str(tmp_path / "out")
    manifest = records.write_records(cases.frame(spark, rows), folder, file_bytes=200)
    assert manifest.count() > 4
    got = records.read_records(manifest, folder).orderBy("shard", "record").collect()
    assert [r.doc_id for r in got] == [None, 1, 3, 3, *range(10, 40)]
    assert [r.ids for r in got][:2] == [[*ids_of(tokenizer, "a"), 2], [2]]
    # Any record by its offset alone.
    name = got[-1].shard
    data = (tmp_path / "out" / f"{name}.rec").read_bytes()
    last = np.frombuffer((tmp_path / "out" / f"{name}.idx").read_bytes(), "<u8")[-1]
    payload, end = records.unframe(data, int(last))
    assert end == len(data) and records.parse(payload)[0] == 39


def test_damage_is_seen():
    good = records.frame(records.payload_of(7, np.array([1, 70000])))
    assert records.parse(records.unframe(good, 0)[0])[1].tolist() == [1, 70000]
    for at in (0, 9, 15, len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(bytes(bad), 0)


@given(st.lists(st.integers(0, 300), max_size=30))
@settings(max_examples=100, deadline=None)
def test_plan_is_gapless(lengths):
    size = 64
    got = packing.plan(lengths, size)
    for d, n in enumerate(lengths):
        own = sorted((s, k) for doc, s, k, _, _ in got if doc == d)
        assert sum(k for _, k in own) == n and all(a + k == b for (a, k), (b, _) in zip(own, own[1:]))
    fill = {}
    for _, _, n, s, o in sorted(got, key=lambda p: (p[3], p[4])):
        assert fill.get(s, 0) == o
        fill[s] = o + n
    # Full, or a power of two.
    assert all(n == size or n & (n - 1) == 0 for n in fill.values())
    assert sum(n == size for n in fill.values()) == sum(lengths) // size


def test_plan_cuts_only_what_fits_nowhere():
    # Seven of 300 fit in one of 2,048 with 52 left: one per sequence at most is cut.
    lengths = [300] * 70 + [1900] * 5
    got = packing.plan(lengths, 2048)
    whole = {d for d, start, n, _, _ in got if n == lengths[d]}
    assert len(whole) >= 60 and set(range(70, 75)) <= whole
    rooms = [2048] * (sum(lengths) // 2048) + [1 << b for b in reversed(range(12)) if sum(lengths) % 2048 >> b & 1]
    left = list(rooms)
    for d, start, n, s, at in got:
        want = lengths[d] - start
        assert at == rooms[s] - left[s]
        # A cut means that no sequence had room for the piece.
        assert n == want or max(left) < want
        left[s] -= n
    assert not any(left)


def test_plan_balances_cost():
    lengths = [40, 30, 20, 10] * 64
    cost = lambda n: n + packing.ATTENTION_SHARE * n * n
    spent = {}
    for _, _, n, s, _ in packing.plan(lengths, 128, packing.ATTENTION_SHARE):
        spent[s] = spent.get(s, 0) + cost(n)
    assert max(spent.values()) - min(spent.values()) < 0.05 * max(spent.values())


def test_packing(spark, tokenizer):
    rows = cases.documents()
    out = packing.pack(cases.frame(spark, rows), block_tokens=5000).collect()
    fill, got = {}, {}
    for r in out:
        ids = [*ids_of(tokenizer, dict(rows)[r.doc_id]), 1]
        part = ids[r.start:r.start + r.length]
        assert r.ids == part and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == {i: len(ids_of(tokenizer, t)) + 1 for i, t in rows}
    for own in fill.values():
        own.sort()
        assert own[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(own, own[1:]))
        total = sum(n for _, n in own)
        assert total <= 2048 and (total == 2048 or total & (total - 1) == 0)
    assert packing.pack(cases.frame(spark, [])).count() == 0


@pytest.mark.parametrize("pair", ["x7", "ab"])
def test_words_that_a_polynomial_cannot_tell_apart(pair):
    """a to ab, b to ba, repeated: equal polynomial hashes modulo a power of two in any odd base."""
    from wattspan.llm.encode import default_path, encoder

    one, two = pair
    while len(one) < 1024:
        one, two = one + two, two + one
    words = encoder(default_path())
    for w in (one, two):
        data = np.frombuffer(w.encode(), np.uint8)
        assert words.encode(data, np.array([0, len(data)]))[0].tolist() == words.tokenizer.encode(w, add_special_tokens=False).ids
