"""Documents with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re

SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def documents(n=60, seed=7):
    """(doc_id, text): random texts with shared lines, copies and near copies, nulls, empty and odd ones."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgéñ") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [sentence(12) for _ in range(3)]
    passage = sentence(70)
    rows = []
    for i in range(n):
        lines = [sentence(rng.randint(3, 25)) for _ in range(rng.randint(1, 8))]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), "  " + shared[i % 3].upper() + "\t")
        if i % 5 == 0:
            lines.append(sentence(3) + " " + passage + " " + sentence(2))
        rows.append((i, "\n".join(lines)))
    base = sentence(200).split()
    for i in range(n, n + 12):
        own = list(base)
        for _ in range(i - n):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows.append((i, " ".join(own)))
    rows += [(n + 20, rows[3][1]), (n + 21, rows[3][1]), (n + 22, rows[3][1].upper())]
    rows += [(n + 30, None), (n + 31, ""), (n + 32, " \n\t\n"), (n + 33, "one two"), (n + 34, "One  TWO\n"), (n + 35, "x" * 5000),
             (n + 36, "ab " * 3000), (n + 37, "é" * 99), (n + 38, "é" * 50), (n + 39, "\n\n"), (n + 40, "İK ß\x00\x1c 日本語")]
    rows.append((n + 50, "\n".join(r[1] for r in rows[:40] if r[1])))
    return rows


def frame(spark, rows, clash=("kept", "spans", "_id", "_text", "n_lines", "key", "score", "_doc", "_new", "_d", "line", "doc"), parts=4):
    """The rows with other columns whose names operators use themselves."""
    fields = "doc_id bigint, text string" + "".join(f", `{c}` string" for c in clash)
    return spark.createDataFrame([(*r, *["other"] * len(clash)) for r in rows], fields).repartition(parts)


def repeated_bytes(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        t = (text or "").encode()
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            w = t[p:p + length]
            if seen.setdefault(w, (doc_id, p)) < (doc_id, p):
                gone[p:p + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc_id] = (len(t), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def deduped_lines(rows, points=40, least=5):
    keys = {}
    key = lambda line: line.strip(SPACE).translate(UPPER)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            keys.setdefault(key(line), set()).add(doc_id)
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (
            len(key(x)) >= points and len(keys[key(x)]) >= least and doc_id != max(keys[key(x)]))]
        out[doc_id] = (len(lines), len(lines) - len(kept), "\n".join(kept) if text is not None else "")
    return out


def shingle_set(text, width=5):
    w = words((text or "").translate(UPPER))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def near_components(rows):
    """doc_id -> (n_shingles, component_id)."""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    places = {}
    for i in range(len(w) - 2):
        places.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
