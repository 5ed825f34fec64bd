"""Benchmark decontamination on templates.

Tokens are words, numbers and the signs of units. A token's template form depends
on the token alone: numbers become ``<num>``, units ``<unit>``, capitalised
words ``<name>``; other words are lower-cased, so a
passage in capitals keeps its windows between names. A window is
``WINDOW`` forms in a row, hashed; benchmark windows with fewer than
``LEAST_WORDS`` literal words say too little and are left out. Windows of
documents are joined to those of the benchmark by hash.

A question whose numbers or names were replaced keeps its windows. Matches are
grouped by document, item and distance between both places. There, each slot
(placeholder) of the item pairs with the document's token. The pairs must be
consistent: a value of the item always has the same counterpart. A group counts
when at least ``LEAST_WINDOWS`` windows match (all of a shorter item's) and at
least ``LEAST_CONSISTENT`` of its slot pairs are consistent.

Beside these windows of the text as it stands, a second search takes folded
tokens: a run of placeholders of one type is one slot, so a value may be longer
or shorter than the item's. It takes the tokens twice: without case (words in any
case are literals, numbers and units are slots), and with names as slots. Its windows have ``SHORT`` forms, of
which at least ``SHORT_WORDS`` are literal. They are grouped by one distance, by
near ones, and by distances of up to the item's length, since a literal may be
replaced by more words. A group counts when its windows cover
``LEAST_COVERED`` of the item, or when at least ``LEAST_SHORT`` lie at one or near
distances, and its slots are consistent. A pair that the first search finds
keeps that search's figures.

Nothing but built-in functions runs on the texts. The benchmark side is
broadcast when its counted rows are within the limit and shuffled otherwise.

Null and empty texts, and texts shorter than a window, have no matches; nor have
items without a window that counts. Rows that repeat an id are searched as one
document's texts. Null ids are kept as such and never removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspan.functions.columns import map_lookup, qcol
from wattspan.llm.frames import scratch, texts

WINDOW = 8
LEAST_WORDS = 4
LEAST_WINDOWS = 6
LEAST_CONSISTENT = 0.8
SHORT = 5
SHORT_WORDS = 3
LEAST_SHORT = 9
LEAST_COVERED = 0.6
NEAR = 8
BROADCAST_BYTES = 64 << 20
# Estimated bytes of a benchmark window in memory: a hash, two numbers and WINDOW strings.
ROW_BYTES = 1024

# The tokens, and the forms that are slots.
TOKEN = r"\p{L}+|[0-9]+(?:[.,][0-9]+)*|[%$€£°]"
UNITS = (
    "% $ € £ ° mm cm m km mg g kg ml l s min h hour hours minute minutes second seconds day days week weeks month months "
    "year years meter meters metre metres mile miles feet inch inches liter liters litre litres gram grams kilogram kilograms "
    "pound pounds dollar dollars euro euros cent cents").split()
NAME = r"^\p{Lu}\p{Ll}"
BETWEEN = r"[^\p{L}0-9%$€£°]+"

# The searches: windows of the text as it stands, and short windows of folded tokens, without case and with names as slots.
WHOLE, CASELESS, NAMED = 0, 1, 2
KINDS = {CASELESS: "caseless", NAMED: "named"}


def _is_number(token: Column) -> Column:
    """Tokens begin with a letter, a sign or an ASCII digit, so the order of bytes tells."""
    return (token >= "0") & (token < ":")


def _unit_or(token: Column, literal: Column) -> Column:
    return F.when(token.isin(*UNITS), "<unit>").otherwise(literal)


def form(token: Column) -> Column:
    """Template form of one token. Most begin with a small ASCII letter and need no regular expression."""
    plain = _unit_or(token, F.lower(token))
    return (
        F.when((token >= "a") & (token < "{"), plain).when(_is_number(token), "<num>")
        .when(F.rlike(token, F.lit(NAME)), "<name>").otherwise(plain)
    )


def caseless(text: Column) -> Column:
    """Upper case first: some letters have several lower-case forms or become two."""
    return F.lower(F.upper(text))


def _is_slot(hashed: Column) -> Column:
    return hashed.isin(*[F.xxhash64(F.lit(x)) for x in ("<num>", "<name>", "<unit>")])


def _neighbours(column: str, step: int) -> Column:
    """Hash of each element with the one ``step`` behind it; the last ones drop out."""
    size = F.greatest(F.size(column) - step, F.lit(0))
    return F.slice(F.transform(column, lambda x, i: F.xxhash64(x, F.get(column, i + step))), F.lit(1), size)


def _folded_windows(forms: str, at: str, fours: str) -> Column:
    """Hashes of windows of five folded tokens. Where none of them is a run, four are hashed already."""

    def hashed(a: Column, i: Column) -> Column:
        g = lambda k: F.get(forms, F.get(at, i + k))
        pairs = F.xxhash64(F.xxhash64(g(0), g(1)), F.xxhash64(g(2), g(3)))
        return F.when(F.get(at, i + 4) == a + 4, F.xxhash64(F.get(fours, a), F.get(forms, a + 4))).otherwise(F.xxhash64(pairs, g(4)))

    return F.slice(F.transform(at, hashed), F.lit(1), F.greatest(F.size(at) - (SHORT - 1), F.lit(0)))


def _starts(column: str) -> Column:
    """Places where a folded token begins: all but those of a slot behind one of its own type."""
    return F.array_compact(F.transform(
        column, lambda x, i: F.when(~_is_slot(x) | (i == 0) | (x != F.get(column, i - 1)), i)))


def windows(df: DataFrame) -> DataFrame:
    """``_id``, ``_tokens``, and for the text as it stands (``w``), without case (``c``) and with names (``n``) the hashed
    forms (``_w``, ``_l`` without case), the places where folded tokens begin (``_cat``, ``_nat``) and hashes of windows
    (``_w8``, ``_c5``, ``_n5``).

    The text is cut once. Pairs are hashed, then pairs of pairs, then what is left. Each step is a column of its own: a
    lambda evaluates whatever is not one anew for each element.
    """
    out = df.select("_id", F.regexp_extract_all(F.coalesce("_text", F.lit("")), F.lit(TOKEN), 0).alias("_tokens"))
    low = F.transform("_tokens", caseless)
    out = out.withColumns({
        "_w": F.transform("_tokens", lambda t: F.xxhash64(form(t))),
        "_l": F.transform(low, lambda t: F.xxhash64(F.when(_is_number(t), "<num>").otherwise(_unit_or(t, t))))})
    out = out.withColumns({
        "_w2": _neighbours("_w", 1), "_l2": _neighbours("_l", 1), "_cat": _starts("_l"), "_nat": _starts("_w")})
    out = out.withColumns({"_w4": _neighbours("_w2", 2), "_l4": _neighbours("_l2", 2)})
    return out.withColumns({
        "_w8": _neighbours("_w4", 4), "_c5": _folded_windows("_l", "_cat", "_l4"), "_n5": _folded_windows("_w", "_nat", "_w4")})


def _values(kind: Column, pos: Column) -> Column:
    """Tokens of the window; of folded ones the run's tokens in one string."""
    at = F.when(kind == CASELESS, F.col("_cat")).otherwise(F.col("_nat"))
    runs = F.transform(F.slice(at, pos + 1, SHORT), lambda a, k: F.array_join(
        F.slice("_tokens", a + 1, F.coalesce(F.get(at, pos + k + 1), F.size("_tokens")) - a), " "))
    return (
        F.when(kind == WHOLE, F.slice("_tokens", pos + 1, WINDOW))
        .when(kind == CASELESS, F.transform(runs, caseless)).otherwise(runs)
    )


def _exploded(df: DataFrame, id_alias: str, pos: str, forms: bool = False) -> DataFrame:
    """One row per window: id, ``kind``, place and ``h``, beside the arrays of the text."""
    folded = lambda column, at: F.transform(at, lambda i: F.get(column, i))
    sides = [(WHOLE, "_w8", F.col("_w")), (CASELESS, "_c5", folded("_l", "_cat")), (NAMED, "_n5", folded("_w", "_nat"))]
    each = F.explode(F.array(*[F.struct(
        F.lit(k).alias("kind"), F.col(h).alias("hashes"), *([f.alias("forms")] if forms else [])) for k, h, f in sides]))
    rows = windows(df).filter("_id IS NOT NULL").select(F.col("_id").alias(id_alias), "_tokens", "_cat", "_nat", each.alias("_s"))
    rows = rows.select(id_alias, "_tokens", "_cat", "_nat", F.col("_s.kind").alias("kind"),
                       *([F.col("_s.forms").alias("forms")] if forms else []), F.posexplode_outer("_s.hashes").alias(pos, "h"))
    return rows.filter("h IS NOT NULL")


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``h``, ``kind``, ``item``, ``ipos``, ``ivals`` (the window's tokens) and ``size``: the item's number of windows, of
    short ones its number of folded tokens."""
    rows = _exploded(texts(benchmark, item_col, text_col), "item", "ipos", forms=True)
    whole = F.col("kind") == WHOLE
    literal = F.size(F.filter(F.slice("forms", F.col("ipos") + 1, F.when(whole, WINDOW).otherwise(SHORT)), lambda x: ~_is_slot(x)))
    rows = rows.filter(literal >= F.when(whole, LEAST_WORDS).otherwise(SHORT_WORDS)).select(
        "h", "kind", "item", "ipos", _values(F.col("kind"), F.col("ipos")).alias("ivals"), F.size("forms").alias("n"))
    many = rows.filter(whole).groupBy(F.col("item").alias("_item")).agg(F.countDistinct("ipos").alias("many"))
    rows = rows.join(many, F.col("item") == F.col("_item"), "left").withColumn("size", F.when(whole, F.col("many")).otherwise(F.col("n")))
    return rows.drop("_item", "many", "n")


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Matching windows of all searches: ``doc``, ``pos``, ``dvals`` and the benchmark's columns."""
    side = scratch(benchmark_windows(benchmark, item_col, item_text), "benchmark").withColumnRenamed("kind", "_kind")
    rows = _exploded(texts(docs, id_col, text_col), "doc", "pos")
    values = _values(F.col("kind"), F.col("pos")).alias("dvals")
    # Kinds are compared beside the hash, so that the join's key is one number.
    found = (F.col("h") == F.col("_h")) & (F.col("kind") == F.col("_kind"))
    side = side.withColumnRenamed("h", "_h")
    if side.count() * ROW_BYTES <= limit_bytes:
        # Tokens are only referred to here; the window is cut out of matching rows.
        return rows.join(F.broadcast(side), found).select("doc", "kind", "pos", values, "item", "ipos", "ivals", "size")
    return rows.select("doc", "kind", "pos", "h", values).join(side, found).drop("h", "_h", "_kind")


def _slots(found: DataFrame, keys: list[str], form_of, value_of=lambda c: c) -> DataFrame:
    """Slots of the item below ``keys``, once each, with the values on both sides: ``slot``, ``i`` and ``d``."""
    pairs = found.select(*keys, "ipos", F.posexplode_outer(F.arrays_zip("ivals", "dvals")).alias("k", "v")).select(
        *keys, (F.col("ipos") + F.col("k")).alias("slot"), F.col("v.ivals").alias("i"), F.col("v.dvals").alias("d"))
    return pairs.filter(F.startswith(form_of(F.col("i")), F.lit("<"))).select(
        *keys, "slot", value_of(F.col("i")).alias("i"), value_of(F.col("d")).alias("d")).distinct()


def _consistent(pairs: DataFrame, counts: DataFrame, at: list[str]) -> DataFrame:
    """The groups of ``counts`` with ``n_slots`` and ``n_changed``, as far as their slots are consistent."""
    values = pairs.groupBy(*at, "i", "d").agg(F.count(F.lit(1)).alias("n"))
    # Of an item's value the most frequent counterpart is consistent.
    settled = values.groupBy(*at, "i").agg(
        F.sum("n").alias("slots"), F.max("n").alias("agree"),
        F.sum(F.when(F.col("i") != F.col("d"), F.col("n")).otherwise(0)).alias("changed"))
    slots = settled.groupBy(*at).agg(F.sum("slots").alias("n_slots"), F.sum("agree").alias("agree"),
                                     F.sum("changed").alias("n_changed"))
    judged = counts.join(slots, at, "left").fillna(0, ["n_slots", "agree", "n_changed"])
    return judged.filter(F.col("agree") >= F.lit(LEAST_CONSISTENT) * F.col("n_slots"))


def _places(start: Column) -> Column:
    """A short window as bits, in words of 64 places: ``word``, ``starts`` and ``covered``. At a word's end it reaches into the next."""
    word, bit = F.shiftright(start, 6), F.pmod(start, F.lit(64))
    shifted = lambda name, bits, by: F.call_function(name, F.lit(bits).cast("bigint"), by)
    own = F.struct(word.alias("word"), shifted("shiftleft", 1, bit).alias("starts"),
                   shifted("shiftleft", (1 << SHORT) - 1, bit).alias("covered"))
    next_one = F.struct((word + 1).alias("word"), F.lit(0).cast("bigint").alias("starts"),
                        shifted("shiftrightunsigned", (1 << SHORT) - 1, 64 - bit).alias("covered"))
    return F.when(bit > 64 - SHORT, F.array(own, next_one)).otherwise(F.array(own))


def _short_hits(found: DataFrame) -> DataFrame:
    """Good groups of short windows; ``n_windows`` counts these.

    Windows and slots are first summed up per distance, then dealt to the groups of that distance. Places are sets of
    bits, so that aggregates have buffers of fixed width, which Spark spills.
    """
    gap, size = F.col("gap"), F.col("size")
    name = map_lookup(KINDS, F.col("kind"))
    groups = [(0, gap), (1, F.floor(gap / NEAR)), (2, F.floor((gap + NEAR // 2) / NEAR)),
              (3, F.floor(gap / (2 * size))), (4, F.floor((gap + size) / (2 * size)))]
    each = F.explode(F.array(*[F.concat_ws(":", name, F.lit(k), b.cast("bigint")) for k, b in groups])).alias("at")
    found = found.withColumn("gap", F.col("pos") - F.col("ipos"))
    keys, at = ["doc", "item", "kind", "gap", "size"], ["doc", "item", "at"]
    bits = [F.bit_or("starts").alias("starts"), F.bit_or("covered").alias("covered")]
    words = found.select(*keys, F.inline(_places(F.col("ipos")))).groupBy(*keys, "word").agg(*bits)
    words = words.select("doc", "item", each, "word", "starts", "covered", "size").groupBy(*at, "word").agg(*bits, F.max("size").alias("size"))
    near = ~F.rlike(F.col("at"), F.lit(":[34]:"))
    counts = words.groupBy(*at).agg(F.sum(F.bit_count("starts")).alias("n_windows"), F.max("size").alias("size"),
                                    F.sum(F.bit_count("covered")).alias("covered"))
    counts = scratch(counts.filter(
        (near & (F.col("n_windows") >= LEAST_SHORT)) | (F.col("covered") >= F.lit(LEAST_COVERED) * F.col("size"))), "groups")
    pairs = _slots(found, keys, lambda c: form(F.substring_index(c, " ", 1)), lambda c: F.regexp_replace(c, BETWEEN, " "))
    # Only groups that count have their slots compared. Their number follows the documents, so they are never broadcast.
    pairs = pairs.select("doc", "item", each, "slot", "i", "d").join(counts.select(*at).hint("merge"), at, "left_semi").distinct()
    return _consistent(scratch(pairs, "grouped"), counts.select(*at, "n_windows"), at)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document and item found in it: ``n_windows`` (most at one distance, or of short windows in one group),
    ``n_slots`` and ``n_changed`` (slots there, and those with another value)."""
    found = scratch(matches(docs, benchmark, id_col, text_col, item_col, item_text, limit_bytes), "matches")
    at = ["doc", "item", "gap"]
    whole = found.filter(F.col("kind") == WHOLE).withColumn("gap", F.col("pos") - F.col("ipos"))
    counts = whole.groupBy(*at).agg(F.countDistinct("ipos").alias("n_windows"), F.max("size").alias("size"))
    counts = counts.filter(F.col("n_windows") >= F.least(F.lit(LEAST_WINDOWS), F.col("size")))
    good = _consistent(_slots(whole, at, form), counts, at)
    columns = ["doc", "item", "n_windows", "n_slots", "n_changed"]
    both = good.select(F.lit(1).alias("first"), *columns).union(
        _short_hits(found.filter(F.col("kind") != WHOLE)).select(F.lit(0).alias("first"), *columns))
    best = both.groupBy("doc", "item").agg(F.max(F.struct(
        "first", "n_windows", (-F.col("n_changed")).alias("kept"), "n_slots")).alias("b"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("b.n_windows"), F.col("b.n_slots"),
                       (-F.col("b.kept")).alias("n_changed"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows without those whose document holds an item."""
    found = hits(docs, benchmark, id_col, text_col, item_col, item_text).select(qcol(id_col)).distinct()
    return docs.join(found, [id_col], "left_anti")
