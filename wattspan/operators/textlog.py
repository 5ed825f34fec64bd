"""Intent tags, slots and context of logged messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wattspan.functions.columns import qcol, qcols

# Alternatives per intent, three lists each, in order of preference on ties.
INTENTS = {
    "prediction": [
        "predict|forecast|estimate|will be",
        "tomorrow|next|future|at [0-9]+am|at [0-9]+pm",
        "how much will|what will|cuánto será|qué será",
    ],
    "what-if": [
        "what if|if I|if we|suppose|scenario|cambio",
        "save|shift|modify|adjust|cambiar|ahorrar|reducir|reduzco",
        "would.*save|would.*reduce|can.*optimize|ahorraré",
    ],
    "analysis": [
        "why|reason|cause|caused|por qué|causa",
        "spike|peak|pattern",
        "analyze|analysis|trend|patrón",
    ],
    "explanation": [
        "explain|what is|how does|qué es|cómo funciona",
        "factors? affect|factors? influence|afecta",
        "definition|meaning|significado|define",
    ],
}
NO_INTENT = "general"

# Day words with their numbers, English first.
DAY_WORDS = [
    ("monday", 0), ("tuesday", 1), ("wednesday", 2), ("thursday", 3), ("friday", 4), ("saturday", 5), ("sunday", 6),
    ("lunes", 0), ("martes", 1), ("miércoles", 2), ("miercoles", 2), ("jueves", 3), ("viernes", 4),
    ("sábado", 5), ("sabado", 5), ("domingo", 6),
]
TOMORROW_WORDS = ["tomorrow", "mañana"]
TODAY_WORDS = ["today", "hoy"]
LOAD_WORDS = [
    ("light", "Light"), ("medium", "Medium"), ("maximum", "Maximum"), ("max", "Maximum"), ("high", "Maximum"),
    ("low", "Light"),
]
DEFAULT_SECONDS, DEFAULT_DAY, DEFAULT_LOAD = 36000, 0, "Medium"
# The other inputs of a prediction request.
DEFAULT_INPUTS = {
    "lagging_reactive_power": 23.45,
    "leading_reactive_power": 12.30,
    "co2": 0.05,
    "lagging_power_factor": 0.85,
    "leading_power_factor": 0.92,
}
TIME_PATTERN = r"([0-9]{1,2})(?::([0-9]{2}))?\s*(am|pm)?"


def whole_words(alternatives: str) -> str:
    """A pattern for any alternative between word borders, where letters with accents count as letters."""
    edge = r"[^\p{L}\p{N}_]"
    body = alternatives.replace(".*", r"[^\n]*")
    return f"(^|{edge})({body})({edge}|$)"


def tag_intent(df: DataFrame, text: str, name: str = "intent") -> DataFrame:
    """The intent with most matching lists; ties go to the first, no match is ``general``."""
    low = F.lower(qcol(text))
    scores = {i: sum((low.rlike(whole_words(p)).cast("int") for p in ps), F.lit(0)) for i, ps in INTENTS.items()}
    named = df.withColumns({f"_s{k}": s for k, s in enumerate(scores.values())})
    cols = [F.col(f"_s{k}") for k in range(len(scores))]
    best = F.greatest(*cols)
    pick = F.when(best == 0, NO_INTENT)
    for intent, c in zip(scores, cols):
        pick = pick.when(c == best, intent)
    return named.withColumn(name, pick).drop(*[f"_s{k}" for k in range(len(scores))])


def intent_counts(df: DataFrame, text: str) -> DataFrame:
    return tag_intent(df, text).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


def _first_word(low: Column, words: list[tuple[str, object]], default: object) -> Column:
    out = None
    for word, value in words:
        hit = F.contains(low, F.lit(word))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def extract_slots(df: DataFrame, text: str, today: dt.date, inputs: bool = False) -> DataFrame:
    """Adds ``nsm``, ``day_of_week``, ``load_type`` and ``week_status`` read from the message.

    ``today`` anchors "today" and "tomorrow".
    """
    low = F.lower(qcol(text))
    part = lambda i: F.regexp_extract(low, TIME_PATTERN, i)
    hour = part(1).try_cast("int")
    minute = F.coalesce(part(2).try_cast("int"), F.lit(0))
    half = part(3)
    clock = F.when((half == "pm") & (hour != 12), hour + 12).when((half == "am") & (hour == 12), 0).otherwise(hour)
    says = lambda words: F.greatest(*[F.contains(low, F.lit(w)) for w in words])
    day = (
        F.when(says(TOMORROW_WORDS), (today + dt.timedelta(days=1)).weekday())
        .when(says(TODAY_WORDS), today.weekday())
        .otherwise(_first_word(low, DAY_WORDS, DEFAULT_DAY))
    )
    out = df.withColumns(
        {
            "nsm": F.coalesce(clock * 3600 + minute * 60, F.lit(DEFAULT_SECONDS)),
            "day_of_week": day,
            "load_type": _first_word(low, LOAD_WORDS, DEFAULT_LOAD),
        }
    ).withColumn("week_status", F.when(F.col("day_of_week") < 5, "Weekday").otherwise("Weekend"))
    return out.withColumns({k: F.lit(v) for k, v in DEFAULT_INPUTS.items()}) if inputs else out


def last_turns(df: DataFrame, conversation: list[str], turn: str, n: int = 10) -> DataFrame:
    """The newest ``n`` turns per conversation; tasks keep only their own newest before the shuffle."""
    newest = W.partitionBy(*qcols(conversation)).orderBy(qcol(turn).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")
