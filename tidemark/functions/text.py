"""Column expressions on names, symbols, articles, prompts and model replies."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.market import map_values

# --- fixed values: prompts, reply markers, labels and confidences ---------------------------------------------

SENTIMENT_PROMPT = (
    "Instruction: What is the sentiment of this news? "
    "Please choose an answer from {{negative/neutral/positive}}.\n"
    "Input: {article_text}\n"
    "Answer: "
)
DIRECTION_PROMPT = (
    "Instruction: Based on the following news, predict if the stock price will go up, down, or stay stable. "
    "Answer with: up/down/stable.\n"
    "Company: {symbol}\n"
    "News: {article_text}\n"
    "Prediction: "
)
CHAT_PROMPT = (
    "[INST]<<SYS>>\n"
    "You are a seasoned stock market analyst. Your task is to list the positive developments and potential concerns for "
    "companies based on relevant news and basic financials from the past weeks, then provide an analysis and prediction for "
    "the companies' stock price movement for the upcoming week. Your answer format should be as follows:\n\n"
    "[Positive Developments]:\n1. ...\n\n"
    "[Potential Concerns]:\n1. ...\n\n"
    "[Prediction & Analysis]:\nPrediction: {{Up/Down}}\nAnalysis: ...\n"
    "\n<</SYS>>\n\n\n"
    "[Company Symbol]: {symbol}\n[Date]: {news_date}\n\n"
    "From the news articles below, analyze {symbol}'s stock outlook:\n\n"
    "{article_text}\n\n"
    "Based on the information above, analyze the positive developments and potential concerns for {symbol}. "
    "Then predict whether the stock price will go Up or Down tomorrow.\n"
    "[/INST]"
)
JSON_PROMPT = (
    "Analyze this financial news article for its likely impact on stock price.\n\n"
    "Article: {article_text}\n\n"
    "Respond with ONLY a valid JSON object (no markdown, no explanation):\n"
    '{{"sentiment": "positive" or "negative" or "neutral", "confidence": 0.0 to 1.0}}\n\n'
    "Rules:\n"
    '- "positive" = news likely to increase stock price (upgrades, beats, positive outlook)\n'
    '- "negative" = news likely to decrease stock price (downgrades, misses, negative outlook)\n'
    '- "neutral" = news unlikely to move stock price significantly\n'
    "- confidence should reflect how certain you are (0.5 = uncertain, 1.0 = very confident)"
)
SENTIMENT_MARKER, SENTIMENT_LABELS, SENTIMENT_DEFAULT = "Answer:", {"positive": 0.85, "negative": 0.85}, ("neutral", 0.7)
DIRECTION_MARKER, DIRECTION_LABELS, DIRECTION_DEFAULT = "Prediction:", {"up": 0.7, "down": 0.7}, ("stable", 0.6)
FAILED_SENTIMENT, FAILED_DIRECTION = ("neutral", 0.5), ("stable", 0.5)
CHAT_PATTERNS = {
    "Up": r"prediction[:\s]*(up|increase|rise|positive)",
    "Down": r"prediction[:\s]*(down|decrease|fall|negative|decline)",
}
CHAT_DEFAULT, CHAT_END = "Neutral", r".*\[/INST\]\s*"
SENTIMENT_TO_DIRECTION = {"positive": "up", "negative": "down", "neutral": "stable"}
ARTICLE_SEPARATOR = " /n "

# --------------------------------------------------------------------------------------------------------------

_EDGE_SPACE = r"^\s+|\s+$"


def strip(value: Column) -> Column:
    """Trim blanks, tabs and line ends (``trim`` alone takes blanks only)."""
    return F.regexp_replace(value, _EDGE_SPACE, "")


def clean_name(name: str) -> str:
    """Letters, digits and blanks only, lower case, blanks as underscores."""
    return re.sub(r"[^a-zA-Z0-9\s]", "", name).lower().replace(" ", "_")


def clean_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`clean_name` to every column; two names that become equal are an error."""
    names = [clean_name(name) for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"columns collide after cleaning: {twice}")
    return df.toDF(*names)


def ticker_form(symbol: Column) -> Column:
    """Share-class dot as a dash."""
    return F.replace(symbol, F.lit("."), F.lit("-"))


def is_plain_ticker(symbol: Column, longest: int = 5) -> Column:
    """Letters only and at most ``longest`` of them."""
    return symbol.rlike(rf"^\p{{L}}{{1,{longest}}}$")


def symbol_list(symbols: Column) -> Column:
    """Comma list to array without empty entries; a null list is an empty array."""
    return F.filter(F.split(F.coalesce(symbols, F.lit("")), ","), lambda s: s != "")


def join_symbols(symbols: Column) -> Column:
    """Array to comma list; null and empty give an empty text."""
    return F.coalesce(F.array_join(symbols, ","), F.lit(""))


def article_text(headline: Column, summary: Column | None = None) -> Column:
    """Text to score; a null headline gives null, a null summary an empty part."""
    text = F.concat(F.lit("Headline: "), headline)
    if summary is None:
        return text
    return F.concat(text, F.lit(" Summary: "), F.coalesce(summary, F.lit("")))


def render_prompt(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places of a template with columns, whole; ``{{`` and ``}}`` are literal braces."""
    parts: list[Column] = []
    for literal, name in re.findall(r"((?:\{\{|\}\}|[^{}])+)|\{(\w+)\}", template):
        if literal:
            parts.append(F.lit(literal.replace("{{", "{").replace("}}", "}")))
        else:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def after_last(text: Column, marker: str) -> Column:
    """Text behind the last ``marker``, trimmed, in lower case."""
    return F.lower(strip(F.substring_index(text, marker, -1)))


def reply_label(
    reply: Column,
    marker: str = SENTIMENT_MARKER,
    labels: Mapping[str, float] = SENTIMENT_LABELS,
    default: tuple[str, float] = SENTIMENT_DEFAULT,
    failed: tuple[str, float] = FAILED_SENTIMENT,
) -> Column:
    """Struct (label, confidence): the first label found behind the marker, a default, or the failure row for null."""
    answer = after_last(reply, marker)
    name = F.when(reply.isNull(), F.lit(failed[0]))
    score = F.when(reply.isNull(), F.lit(failed[1]))
    for label, confidence in labels.items():
        name = name.when(answer.contains(label), F.lit(label))
        score = score.when(answer.contains(label), F.lit(confidence))
    return F.struct(name.otherwise(default[0]).alias("label"), score.otherwise(default[1]).alias("confidence"))


def market_direction(sentiment: Column) -> Column:
    """Sentiment label as a direction."""
    return map_values(sentiment, SENTIMENT_TO_DIRECTION)


def chat_answer(reply: Column, end: str = CHAT_END) -> Column:
    """Reply without the echoed instruction."""
    return F.regexp_replace(reply, f"(?s){end}", "")


def pattern_label(
    text: Column, patterns: Mapping[str, str] = CHAT_PATTERNS, default: str = CHAT_DEFAULT
) -> Column:
    """First label whose pattern occurs in the text, ignoring case."""
    chain = None
    for label, pattern in patterns.items():
        found = text.rlike(f"(?i){pattern}")
        chain = F.when(found, F.lit(label)) if chain is None else chain.when(found, F.lit(label))
    return chain.otherwise(default)


def strip_fence(text: Column) -> Column:
    """Content of a Markdown fence at the start of the text, or the text itself."""
    trimmed = strip(text)
    inner = F.regexp_replace(F.get(F.split(trimmed, "```"), F.lit(1)), r"^json", "")
    return strip(F.when(trimmed.startswith("```"), inner).otherwise(trimmed))


def json_label(reply: Column, failed: tuple[str, float] = FAILED_SENTIMENT) -> Column:
    """Struct (label, confidence) of a ``{"sentiment": .., "confidence": ..}`` reply; the failure row if unreadable."""
    schema = T.StructType([T.StructField("sentiment", T.StringType()), T.StructField("confidence", T.DoubleType())])
    parsed = F.from_json(strip_fence(reply), schema)
    usable = parsed["sentiment"].isNotNull() & parsed["confidence"].isNotNull()
    return F.struct(
        F.when(usable, parsed["sentiment"]).otherwise(failed[0]).alias("label"),
        F.when(usable, parsed["confidence"]).otherwise(failed[1]).alias("confidence"),
    )


def occurrences(text: Column, term: str) -> Column:
    """Number of non-overlapping occurrences of a term."""
    removed = F.length(F.replace(text, F.lit(term)))
    return F.floor((F.length(text) - removed) / F.lit(len(term))).cast("long")


def lexicon_label(
    text: Column,
    positive: Sequence[str],
    negative: Sequence[str],
    margin: float = 0.05,
    failed: tuple[str, float] = FAILED_SENTIMENT,
) -> Column:
    """Native scorer: struct (label, confidence) from term counts over the whole text; null text is neutral/0.5."""
    p = sum((occurrences(text, term) for term in positive), F.lit(0).cast("long"))
    q = sum((occurrences(text, term) for term in negative), F.lit(0).cast("long"))
    scale = round((1 + margin) * 100)

    def judge(counts: Column) -> Column:
        p, q = counts["p"], counts["q"]
        label = F.when(p * 100 > q * scale, "positive").when(q * 100 > p * scale, "negative").otherwise("neutral")
        confidence = F.lit(0.5) + F.abs(p - q).cast("double") / (2 * (p + q + 1)).cast("double")
        return F.struct(
            F.when(text.isNull(), F.lit(failed[0])).otherwise(label).alias("label"),
            F.when(text.isNull(), F.lit(failed[1])).otherwise(confidence).alias("confidence"),
        )

    # The one-element array binds the counts, so a long text is searched once per term.
    return F.get(F.transform(F.array(F.struct(p.alias("p"), q.alias("q"))), judge), F.lit(0))


def parse_number(text: Column) -> Column:
    """Text to double; ``.`` and the empty text are missing, other unreadable texts give null as well."""
    return F.when(~text.isin(".", ""), text).try_cast("double")


def is_missing_number(text: Column) -> Column:
    return text.isNull() | text.isin(".", "")
