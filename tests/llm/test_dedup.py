"""Substring, line and near-duplicate removal against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import cases
from pyspark.sql import functions as F
from wattspan.llm import line_dedup, near_dups, substrings
from wattspan.llm.components import components
from wattspan.llm.suffixes import permuted_prefixes, suffix_array


@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([6, 5000]))
@settings(max_examples=150, deadline=None)
def test_suffix_array_and_prefixes(symbols, kinds):
    s = np.array([*symbols, 0])
    sa = suffix_array(s, kinds)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    got = permuted_prefixes(s, sa, np.array([0]), 200)
    for a, b in zip(sa, sa[1:]):
        n = 0
        while s[a + n] == s[b + n] and max(a, b) + n + 1 < len(s):
            n += 1
        assert got[b] == n


def _spans(df):
    out = df.select("doc_id", "n_bytes", "n_removed", F.size("spans").alias("s"), F.sha2("kept", 256).alias("h"))
    return {r[0]: tuple(r)[1:] for r in out.collect()}


@pytest.mark.parametrize("most", [substrings.MOST_PIECES, 2])
def test_substrings(spark, most):
    """Also with anchors taken for too frequent for one shard."""
    rows = cases.documents()
    assert _spans(substrings.remove_repeats(cases.frame(spark, rows), most_pieces=most)) == cases.repeated_bytes(rows)


def test_resolving_does_not_depend_on_batches():
    rng = np.random.default_rng(3)
    rows = sorted((int(a), int(p), int(d), int(s), 3 if p else -50) for a, p, d, s in zip(
        rng.integers(0, 12, 300), rng.integers(0, 3, 300), rng.integers(0, 9, 300), rng.integers(0, 4, 300)))
    whole = None
    for size in (300, 1, 7):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + size]), substrings._PIECE.types)],
                                              schema=substrings._PIECE) for k in range(0, 300, size)]
        pieces, covered = set(), set()
        for b in substrings._resolved(batches):
            for d, s, e, a in zip(*(b.column(c).to_pylist() for c in "dsea")):
                pieces.add((d, s, e, a)) if a is not None else covered.update((d, x) for x in range(s, e))
        pieces = frozenset(pieces)
        assert whole is None or whole == (pieces, covered)
        whole = (pieces, covered)


def test_substrings_with_small_shards_and_segments(spark, monkeypatch):
    """Texts cut with an overlap, pieces folded often, and many shards give the same."""
    monkeypatch.setattr(substrings, "SHARD_BYTES", 2000)
    rows = cases.documents(30, 3)
    data = np.frombuffer(("".join(t or "" for _, t in rows)).encode(), np.uint8)
    whole = substrings.pieces(data, np.array([0, len(data)]))
    monkeypatch.setattr(substrings, "SEGMENT_BYTES", 500)
    anchors = set()
    for at, part, bounds in substrings.segments(data, np.array([0, len(data)])):
        got = substrings.pieces(part, bounds)
        if got is None:
            continue
        _, s, n, a, _ = got
        anchors |= {(at + x + k, y) for x, m, y in zip(s.tolist(), n.tolist(), a.tolist()) for k in range(m)}
    _, s, n, a, _ = whole
    assert anchors == {(x + k, y) for x, m, y in zip(s.tolist(), n.tolist(), a.tolist()) for k in range(m)}
    assert _spans(substrings.remove_repeats(cases.frame(spark, rows))) == cases.repeated_bytes(rows)


def test_substrings_empty_null_id_and_repeated_rows(spark):
    assert _spans(substrings.remove_repeats(cases.frame(spark, []))) == {}
    text = "the same words again and again, " * 8
    out = substrings.remove_repeats(cases.frame(spark, [(None, "z" + text), (4, text), (4, text)]))
    got = sorted((r.doc_id is None, r.n_removed) for r in out.collect())
    # The null id comes first; both rows of the other id lose the whole text.
    assert got == [(False, 256), (False, 256), (True, got[2][1])] and 0 < got[2][1] < 256


@pytest.mark.parametrize("bits", [line_dedup.MOST_FILTER_BITS, 1 << 12])
def test_lines(spark, monkeypatch, bits):
    """Also with filters that are nearly full."""
    monkeypatch.setattr(line_dedup, "LEAST_FILTER_BITS", 1 << 12)
    rows = cases.documents()
    out = line_dedup.dedup_lines(cases.frame(spark, rows), most_bits=bits)
    assert out.columns[:5] == ["doc_id", "text", "kept", "spans", "_id"]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in out.collect()}
    want = cases.deduped_lines(rows)
    assert got == want and sum(x[1] for x in want.values()) > 0


def test_lines_repeated_rows_and_empty_table(spark):
    line = "a line that is long enough to be judged by its key"
    out = line_dedup.dedup_lines(cases.frame(spark, [(1, line), (1, line), (2, line + "\nx"), (3, line), (None, line)])).collect()
    got = sorted((r.doc_id or 0, r.n_dropped, r.text) for r in out)
    assert got == [(0, 1, ""), (1, 1, ""), (1, 1, ""), (2, 1, "x"), (3, 0, line)]
    assert line_dedup.dedup_lines(cases.frame(spark, [])).count() == 0


def test_twice_filter_has_no_misses(spark):
    """Every key of two documents passes, whichever tasks held it."""
    rows = cases.documents()
    slim = cases.frame(spark, rows, parts=7).select(F.col("text").alias("_t")).select(F.col("_t").alias("_text"))
    bitmap = line_dedup.twice_filter(slim, 1 << 14, 40)
    import pyarrow as pa
    from wattspan.llm.batches import slices

    held = {}
    for lo, hi, data, off in slices(pa.array([t for _, t in rows], pa.string())):
        doc, _, _, _, h = line_dedup.long_keys(data, off, 40)
        for d, x in zip(doc.tolist(), h.tolist()):
            held.setdefault(x, set()).add(lo + d)
    twice = np.array([x for x, d in held.items() if len(d) > 1], np.uint64)
    assert len(twice) and line_dedup.passes(bitmap, twice).all()


def _near(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("large, block", [(50_000, 2_000_000), (3, 2_000_000), (50_000, 400)])
def test_near_duplicates(spark, monkeypatch, large, block):
    """Also with buckets joined whole, and with clusters of several blocks."""
    monkeypatch.setattr(near_dups, "LARGE_BUCKET", large)
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", block)
    rows = cases.documents()
    out = near_dups.near_duplicates(cases.frame(spark, rows))
    got = _near(out)
    assert got == cases.near_components(rows)
    assert len({c for _, c in got.values()}) < len(got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_near_duplicates_odd_rows(spark):
    assert _near(near_dups.near_duplicates(cases.frame(spark, []))) == {}
    out = near_dups.near_duplicates(cases.frame(spark, [(5, "a b c"), (5, "a b c"), (7, "A b\nc"), (None, "a b c"), (8, None)]))
    got = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in out.collect())
    assert got == [(0, None, False), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True)]


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for n in (1, 3, 40, 900):
        a, b = np.sort(pool[:n]), np.sort(pool[n // 5:n + n // 5])
        s = near_dups.sketches(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        true = len(set(a) & set(b)) / len(set(a) | set(b))
        assert (s != np.uint64(2**64 - 1)).all() and abs((s[0] == s[1]).mean() - true) < 0.15


def test_components_of_a_long_chain(spark):
    ids = list(range(200))
    random.Random(2).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(900, 901), (903, 903)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in ids}, 900: 900, 901: 900}


def test_shingles_of_words_that_a_polynomial_cannot_tell_apart(spark):
    """Words by doubling (a to ab, b to ba) share a rolling hash modulo 2^64 in every base."""
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    rows = [(1, f"{one} c d e f"), (2, f"{two} c d e f"), (3, f"{one} c d e f")]
    assert _near(near_dups.near_duplicates(cases.frame(spark, rows))) == cases.near_components(rows)
