"""Phrases, vectors and prefix tries against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from wattspan.llm import embeddings, phrases, tries

CLASH = "`lang_` string, k int, g string, c bigint, f bigint, `_lang` string, n bigint, a string"


# Phrases

def pieces_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def phrase_rows(rows, min_count, percent=80, first=2000):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for ws in pieces_of(text):
            n[lang or "und"] += len(ws)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = set()
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i:i + m]] = max(longest[p[i:i + m]], a)
        kept = []
        for p, a in found.items():
            score, j = min((2_000_000 * a // (f[p[:j]] + f[p[j:]]), j) for j in range(1, len(p)))
            if not (longest[p] and 100 * longest[p] >= percent * a):
                kept.append((-score, -a, " ".join(p).encode(), f[p[:j]], f[p[j:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return out


def phrase_texts():
    rng = random.Random(5)
    words = ["a", "B", "c", "d", "é", "x\x0bY", "　", "日本", "no-1"]
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice([".", "\n", ",  ", "\t"]), rng.choice("ef"))
            for _ in range(80)]
    rows += [(f"{rng.choice(words)} {passage} {rng.choice(words)}", "e")] * 3 + [(passage.upper(), "e")] * 3 + [(passage, "p")] * 4
    rows += [("r s " * 30, "ring")] * 2 + [(None, "e"), ("", "e"), (" \t\n", None), ("one two three four", None)] * 4
    return rows


@pytest.mark.parametrize("most", [phrases.MOST_COUNTERS, 8])
@pytest.mark.parametrize("min_count", [3, 1])
def test_phrases(spark, most, min_count):
    """Also with counters so full that nothing is cut."""
    rows = phrase_texts()
    docs = spark.createDataFrame([(*r, None, 1, "g", 2, 3, "l", 4, "a") for r in rows], "text string, lang string, " + CLASH).repartition(3)
    got = phrases.collocations(docs, min_count=min_count, most_counters=most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == phrase_rows(rows, min_count)


def test_paths(spark):
    """Each frequent edge lies on one path; repeated passages come out whole."""
    rows = phrase_texts()
    graph = phrases.Graph(spark.createDataFrame(rows, "text string, lang string"), min_count=3)
    paths = [tuple(r) for r in graph.paths().collect()]
    edges = Counter()
    for lang, path, n, c in paths:
        ws = path.split(" ")
        assert len(ws) == n
        edges.update({(lang, " ".join(ws[i:i + 4]), c): 1 for i in range(n - 3)})
    assert set(edges.values()) == {1}
    want = Counter((lang or "und", " ".join(ws[i:i + 4])) for text, lang in rows for ws in pieces_of(text) for i in range(len(ws) - 3))
    assert {e[:2]: e[2] for e in edges} == {e: c for e, c in want.items() if c >= 3}
    assert (("p", " ".join(f"w{i}" for i in range(40)), 40, 4)) in paths


def test_phrases_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


def test_long_texts_in_parts():
    import pyarrow as pa

    text = "ab cd. " * 50 + "x" * 400 + "," + "y z " * 10
    parts = list(phrases._parts(pa.array([text]), 64))
    assert b"".join(d.tobytes() for _, d, _ in parts).decode() == text and len(parts) > 4
    assert all(d.tobytes().decode()[-1] in ".," for _, d, _ in parts[:-1])


# Vectors

def vector_rows(rows, threshold=0.98):
    """vec_id, n_links, component_id, kept of each row."""
    fits = lambda v, l: l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.abs(v).max() if fits(v, l) else None for _, v, l in rows]
    unit = [u if u is None else u / np.linalg.norm(u) for u in unit]
    near = defaultdict(set)
    for i, (_, _, l) in enumerate(rows):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[j][2] == l and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                near[i].add(j), near[j].add(i)
    out = []
    for i, (id_, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if id_ is not None else None
        out.append((id_, len(near[i]), component, id_ is not None and id_ == component))
    return sorted(out, key=str)


def vectors(groups=6, dim=24, seed=2):
    rng = np.random.default_rng(seed)
    rows, at = [], 1000
    for g in range(groups):
        base = rng.standard_normal(dim)
        for _ in range(40):
            v = base + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.14])
            rows.append((at, [float(np.float32(x)) for x in v], int(g % 3)))
            at -= 1
    copy = rows[5][1]
    rows += [(7, copy, 0), (7, copy, 0), (8, [x * 3e30 for x in copy], 0), (None, copy, 0), (9, copy, None), (10, None, 0)]
    rows += [(11, [0.0] * dim, 0), (12, [], 0), (13, [None, *copy[1:]], 0), (14, [float("nan"), *copy[1:]], 0)]
    rows += [(15, [float("inf"), *copy[1:]], 0), (16, copy[:5], 0), (17, copy[:5], 0), (18, copy, 1), (19, [-0.0, 1.0], 5), (20, [0.0, 1.0], 5)]
    return rows


@pytest.mark.parametrize("block", [embeddings.BLOCK, 7])
def test_vectors(spark, block):
    """Also with buckets cut into many blocks."""
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, cid string, kept int").repartition(5)
    got = embeddings.near_vectors(df, block=block, miss=1e-6)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == vector_rows(rows)


def test_vectors_of_nothing(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_recall_at_the_threshold(spark):
    """Pairs whose cosine is just the threshold, the hardest ones, with production parameters."""
    rng = np.random.default_rng(4)
    rows, n = [], 600
    for i in range(n):
        a, b = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        rows += [(2 * i, a.tolist(), i % 2), (2 * i + 1, (0.9801 * a + math.sqrt(1 - 0.9801**2) * b).tolist(), i % 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    linked = embeddings.near_vectors(df).filter("n_links > 0").count()
    assert linked >= 0.98 * 2 * n


@pytest.mark.parametrize("rows", [2, 5000, 10**6, 10**9])
def test_tables(rows):
    k, tables, width = embeddings.plan_tables(rows)
    p = embeddings.same_bucket(math.sqrt(0.04), width) ** k
    assert (1 - p) ** tables <= embeddings.MISS and rows * embeddings.same_bucket(math.sqrt(1.4), width) ** k <= 2


# Tries

def trie_rows(rows):
    """The nodes of the rebuilt conversations of (conv_id, turn, role, text)."""
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder has the sign of the id.
        whole[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + ts[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    ends = lambda p: ",".join(map(str, sorted(c for c in members[p] if whole[c] == p)))
    return sorted((min(cs), len(p), min(members[p[:-1]]) if p else -99, len(cs), children[p], leaves[p], saved[p],
                   hashlib.sha256(ends(p).encode()).hexdigest()) for p, cs in members.items())


def talks(seed, n=60, kinds=2):
    rng = random.Random(seed)
    rows = []
    for c in range(-5, n):
        if rng.random() < 0.8:
            for t in range(rng.randint(0, 12)):
                rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["hé", "no", "", None][:kinds])))
    rows += [(1000 + i, 0, "user", "same") for i in range(0, 400, 5)] + [(None, 1, "user", "x")] + rows[:5]
    return rows


@pytest.mark.parametrize("slices", [1, 3, 50])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, slices, seed):
    """One slice, and so many that most nodes reach over several."""
    rows = talks(seed, kinds=seed + 1)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, depth int")
    got = tries.conversation_trie(df, slices)
    assert sorted(tuple(-99 if x is None else x for x in r) for r in got.collect()) == trie_rows(rows)


def test_trie_of_nothing_and_of_one(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert tries.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    for rows in ([(3, 1, None, None)], [(3, 1, "a", "b" * 9000)]):
        got = tries.conversation_trie(spark.createDataFrame(rows, schema))
        assert sorted(tuple(-99 if x is None else x for x in r) for r in got.collect()) == trie_rows(rows)


@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(0, 5))
@settings(max_examples=100, deadline=None)
def test_minima(values, depth):
    table = tries.Minima(np.array(values))
    n = len(values)
    at = np.arange(n)
    right = table.right(at, np.full(n, depth), n - 1)
    left = table.left(at, np.full(n, depth))
    for p in range(n):
        assert right[p] == max(q for q in range(p, n) if all(v >= depth for v in values[p + 1:q + 1]))
        assert left[p] == min(q for q in range(p + 1) if all(v >= depth for v in values[q + 1:p + 1]))
    lo, hi = np.minimum(at, at[::-1]), np.maximum(at, at[::-1])
    assert table.least(lo, hi).tolist() == [min(values[a:b + 1]) for a, b in zip(lo, hi)]
