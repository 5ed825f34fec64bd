"""URL rules, quality rules, license scans and decontamination."""

import re
from math import log

import pytest
import xxhash

import cases
from wattspan.llm import decontaminate, licenses, quality_rules, url_filters


def test_url_rules(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "https://notexample.org/en/1", "http://x.com/fr/",
            "http://x.com/de/a", "http://com/fr/", "x.org/", None, "", "http://org", "http://u@a.org/?q=/es/", "a://b://c.org/",
            "http://casino-win.example.net/", "http://x.com/FR/", "http://example.org/es", "http://my.casino.org/", "http://a.net/login?"]
    df = spark.createDataFrame([(i, u, "z", "z") for i, u in enumerate(urls)], "page_id bigint, url string, host string, rule string")
    rules = [(v, *re.match("([^/]*)(.*)", t).groups(), t) for v, t in url_filters.SITE_RULES]
    want = {}
    for i, u in enumerate(urls):
        m = re.search("://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(t), t, v) for v, h, p, t in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        other = "block" if any(re.search(p, (u or "").lower()) for v, p, _ in url_filters.PATTERN_RULES) else "allow"
        want[i] = (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else other)
    got = {r.page_id: tuple(r)[1:] for r in url_filters.judge_urls(df).collect()}
    assert got == want
    again = url_filters.judge_urls(df.union(df)).collect()
    assert len(again) == 2 * len(urls) and {r.page_id: tuple(r)[1:] for r in again} == want
    assert url_filters.judge_urls(df.limit(0)).count() == 0


def test_index_takes_the_rarest_token(spark):
    df = spark.createDataFrame([(f"http://a{i % 9}.com/fr/x",) for i in range(50)] + [("http://x.com/de/",)], "url string")
    urls = df.select("url", url_filters.tokens(df.url).alias("tokens"))
    index, _ = url_filters.rule_index(spark, urls)
    got = {r.site: r.token for r in index.filter("site IS NOT NULL").collect()}
    assert got == {"org/": "org", "example.org/es/": "es", "example.org/en/1": "en", "com/fr/": "fr", "com/de/": "de"}


def test_rules_without_a_token(spark):
    df = spark.createDataFrame([(1, "http://a.com/x99"), (2, "http://b.com/y"), (3, "://"), (4, None)], "page_id bigint, url string")
    rules = [("block", r"[0-9]{2}$", []), ("block", r"^://$", []), ("block", r"/y$", ["y"])]
    got = {r.page_id: r.verdict for r in url_filters.judge_urls(df, site_rules=[], pattern_rules=rules).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}


TOKENS = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")


def test_quality(spark):
    rows = [r for r in cases.documents() if r[0] != 100]
    rows += [(500 + i, " ".join(f"word{j}!! |" for j in range(i, i + 60))) for i in range(8)] + [(600, "from " * 80)]
    labels = spark.createDataFrame([(i, 1, "x") for i in range(40)] + [(3, 1, "x"), (501, 0, "x"), (None, 1, "x")],
                                   "doc_id bigint, quality int, text string")
    got = {r.doc_id: r for r in quality_rules.judge_quality(cases.frame(spark, rows), labels).collect()}
    assert len(got) == len(rows)

    def buckets(text):
        t = TOKENS.findall(text or "")
        x = lambda w, seed: xxhash.xxh64_intdigest(w.encode(), seed)
        return [x(w, 42) for w in t] + [x(b, x(a, 42)) for a, b in zip(t, t[1:])]

    number = lambda h: (h - (1 << 64) if h >> 63 else h) % quality_rules.BUCKETS
    own = {i: [number(h) for h in buckets(t)] for i, t in rows}
    counts, trusted = {}, {}
    for i, b in own.items():
        for x in b:
            counts[x] = counts.get(x, 0) + 1
            trusted[x] = trusted.get(x, 0) + (i < 40)
    n, t, smooth = sum(counts.values()), sum(trusted.values()), quality_rules.SMOOTHING
    ratio = {x: log((trusted[x] + smooth * c / n) / (t + smooth) / (c / n)) for x, c in counts.items()}
    for i, text in rows:
        base, r = cases.base_counts(text), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base, i
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        score = sum(ratio[x] for x in own[i]) / len(own[i]) if own[i] else 0.0
        assert r.base_failed == failed and abs(r.score - score) < 1e-9, i
        assert r.kept == (not failed and r.score >= quality_rules.LEAST_SCORE)
    assert got[600].base_failed and got[0].kept
    kept = quality_rules.keep_good(cases.frame(spark, rows), labels)
    assert kept.columns == cases.frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    rows = cases.documents(10)
    assert all(r.score == 0 for r in quality_rules.judge_quality(cases.frame(spark, rows), labels).collect())
    assert quality_rules.judge_quality(cases.frame(spark, []), labels).count() == 0


def test_automata():
    run = lambda markup, text: licenses.Automaton(markup, "x").run(text.split())[0]
    markup = "all rights [now and ever] reserved by <2> here"
    for text in ("all rights reserved by here", "all rights now and ever reserved by a b here and more",
                 "all rights reserved by here here"):
        assert run(markup, text)
    for text in ("all rights", "all rights now reserved by here", "all rights reserved by a b c here", "rights reserved by here"):
        assert not run(markup, text)
    with pytest.raises(ValueError):
        licenses.Automaton("[one] two three", "x")


def test_licenses(spark):
    rows = cases.documents(5) + [
        (200, "Released under the MIT License.\nMIT-license mit\xa0license"),
        (201, "# Licensed under the Apache\n# License, Version 2.0 (the License)"), (202, "GNU General Public License MIT LICENSE"),
        (203, "Permission is hereby granted, free of charge, to any person"), (204, "mit"), (205, "license")]
    got = {r.doc_id: r for r in licenses.scan_licenses(cases.frame(spark, rows)).collect()}
    for i, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(cases.UPPER))
        at = [(k, lab) for p, lab in licenses.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))), i
    assert got[200].labels == "mit,mit-notice" and got[200].n_base == 2 and got[201].labels == "apache,apache-2.0"
    assert got[202].labels == "gpl,mit" and got[202].score == 0 and 0 < got[203].score < 1 and got[203].labels == ""
    assert licenses.scan_licenses(cases.frame(spark, [])).count() == 0


def written(markup, optional, filler):
    """The text of a template: optional wording in or out, regions filled with words."""
    text = re.sub(r"<(\d+)>", lambda m: " ".join(filler[:int(m[1])]), markup)
    while "[" in text:
        text = re.sub(r"\[([^\[\]]*)\]", r"\1" if optional else "", text)
    return text


@pytest.mark.parametrize("optional", [True, False])
def test_whole_license_texts(spark, optional):
    texts = [t for t in licenses.TEMPLATES if t[1].endswith("-text")]
    assert len(texts) == 6
    rows, want = [], {}
    for k, (markup, label) in enumerate(texts):
        body = written(markup, optional, ["the", "authors", "or", "holders"])
        words = body.split()
        wrapped = "\n# ".join(" ".join(words[i:i + 9]).capitalize() for i in range(0, len(words), 9))
        # A mandatory word changed near the end: the text is another one.
        other = body.rsplit(" ", 2)
        rows += [(3 * k, "Some code\n# " + wrapped + ".\nmore"), (3 * k + 1, " ".join([other[0], "nothing", other[2]])),
                 (3 * k + 2, body[:len(body) // 2])]
        want[3 * k], want[3 * k + 1], want[3 * k + 2] = label, None, None
    got = {r.doc_id: r for r in licenses.scan_licenses(cases.frame(spark, rows)).collect()}
    for i, label in want.items():
        mine = [x for x in got[i].labels.split(",") if x.endswith("-text")]
        assert mine == ([label] if label else []), (i, got[i])
        assert got[i].score == 1 if label else got[i].score > 0


ITEM = "How many apples does Alice buy if she pays 12 dollars for 3 bags of 4 apples and gives Bob 12 of them"


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_decontamination(spark, limit):
    bench = spark.createDataFrame([(1, ITEM, "x"), (2, "short item", "x"), (3, None, "x"), (None, ITEM, "x")],
                                  "item_id bigint, text string, doc_id string")
    changed = ITEM.replace("12", "30").replace("Alice", "Carol").replace("apples", "apples")
    mixed = ITEM.replace("pays 12", "pays 30").replace("Alice", "Carol").replace("Bob 12", "Bob 77").replace("3 bags", "12 bags")
    rows = cases.documents(20) + [(300, "x y z " + ITEM + " and so on"), (301, "q\n" + changed), (302, mixed), (303, ITEM[:30]),
                                  (304, "how many apples does she buy"), (305, ITEM), (305, ITEM), (None, ITEM),
                                  (306, "X!! " + ITEM.upper())]
    docs = cases.frame(spark, rows)
    got = {(r.doc_id, r.item_id): (r.n_slots, r.n_changed) for r in decontaminate.hits(docs, bench, limit_bytes=limit).collect()}
    # 302 replaces one value by several; 306 has no window without a name left that suffices.
    assert {(300, 1), (301, 1), (305, 1)} <= set(got) <= {(300, 1), (301, 1), (302, 1), (305, 1), (306, 1)}
    assert got[300, 1][1] == 0 and got[301, 1][1] >= 3 and got[305, 1] == got[300, 1]
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {d for d, _ in got}


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_copies_in_other_case(spark, limit):
    item = ITEM + ". The Straße was wide and Every house had 3 doors"
    bench = spark.createDataFrame([(1, item), (2, ITEM)], "item_id bigint, text string")
    rows = [(306, "X!! " + ITEM.upper()), (307, item.upper()), (308, item.lower()), (309, item.title()), (310, "a b c")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.hits(cases.frame(spark, rows), bench, limit_bytes=limit).collect()}
    assert {(306, 2), (307, 1), (307, 2), (308, 1), (309, 1)} <= got and 310 not in {d for d, _ in got}


def test_values_of_other_length(spark):
    names = "Anna met old Bert near the mill while Carl sold red Dora fresh bread and Emil saw it"
    words = "we took the narrow path along the river until it reached the old mill"
    bench = spark.createDataFrame([(1, names), (2, words)], "item_id bigint, text string")
    longer = re.sub("([A-Z][a-z]+)", r"\1 Miller", names)
    rows = [(1, "x " + longer), (2, words.replace("river", "stream")), (3, words.replace("river", "very small stream")), (4, "a b")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.hits(cases.frame(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 2), (3, 2)}


def test_covered_places_of_long_items(spark):
    """Eight windows of five places, one of them across the 64th place, cover 40 of 66 places but too few of 67."""
    words = [f"{a}{b}x" for a in "bcdfghjkl" for b in "aeiouyzq"][:67]
    starts = [0, 8, 16, 24, 32, 40, 48, 61]
    kept = {s + k for s in starts for k in range(decontaminate.SHORT)}
    text = " ".join(w if i in kept else "other" + w for i, w in enumerate(words[:66]))
    bench = spark.createDataFrame([(1, " ".join(words[:66])), (2, " ".join(words))], "item_id bigint, text string")
    rows = [(1, text), (2, " ".join(words[:66]).upper()), (3, " ".join(words[60:66]))]
    got = {(r.doc_id, r.item_id): r.n_windows for r in decontaminate.hits(cases.frame(spark, rows), bench).collect()}
    assert got == {(1, 1): 8, (2, 1): 59, (2, 2): 59}


def test_groups_take_bounded_memory(spark, monkeypatch):
    """Places of windows are aggregates of fixed width, and the groups, which follow the documents, are not broadcast."""
    seen, write = [], decontaminate.scratch

    def scratch(df, name):
        seen.append(df)
        return write(df, name)

    monkeypatch.setattr(decontaminate, "scratch", scratch)
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    out = decontaminate.hits(cases.frame(spark, [(1, ITEM.upper()), (2, ITEM)]), bench)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*seen, out]]
    assert not any("collect_set" in p or "collect_list" in p for p in plans)
    semi = [line for p in plans for line in p.split("\n") if "LeftSemi" in line]
    assert semi and not any("Broadcast" in line for line in semi)
    assert {(r.doc_id, r.item_id) for r in out.collect()} == {(1, 1), (2, 1)}


def test_slots_must_agree(spark):
    item = "take 3 red and 3 blue and 3 green and 3 black and 3 white marbles out"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    agree, differ = item.replace("3", "8"), re.sub("3", lambda m, k=iter("45678"): next(k), item)
    got = decontaminate.hits(cases.frame(spark, [(1, agree), (2, differ)]), bench).collect()
    assert [r.doc_id for r in got] == [1]
    assert decontaminate.hits(cases.frame(spark, []), bench).count() == 0
    assert decontaminate.hits(cases.frame(spark, [(1, agree)]), bench.limit(0)).count() == 0
