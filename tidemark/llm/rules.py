"""Quality rules: document statistics and a decision list learnt by sequential covering, in DataFrame functions only.

Statistics of a text are column expressions. The list is learnt from labelled rows: their statistics are put into bins at
quantiles, and one grouped count over the grow rows tells how every threshold of every statistic would split them. A rule grows
by the threshold with the largest information gain until it covers no good text, is pruned from the end on the prune rows, and
is kept while its precision there holds; then the rows it covers leave. What comes out is an ordered list of conjunctions of
thresholds, which ``expression`` turns into one conditional column.

Defined cases: a null text has no words, and its statistics are zero; a text without words is rejected for its length;
labels that are null, or whose id is not in the documents, teach nothing; without labels of both kinds the list is empty and only
the base rules decide; repeated rows keep one result row each; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, SPACES, texts_of, word_array
from tidemark.session import stage_table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Ratios that rules may test: the counted statistic and the one it is divided by.
RATIOS = {
    "symbol_share": ("n_symbols", "word_chars"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "mark_share": ("n_marks", "word_chars"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "word_length": ("word_chars", "n_words"),
    "line_words": ("n_words", "n_lines"),
}


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every row.

    Windows of 8 words are compared by 64-bit hashes, built from word hashes by doubling. Sorted, equal ones are neighbours; only
    a text that has any is sorted again with positions, and repeated windows in order of position cover min(8, distance to the
    next) words each.
    """
    return _statistics(texts_of(docs, id_column, text_column), "doc_id")


def _statistics(rows: DataFrame, own: str) -> DataFrame:
    """Column ``own`` and the counts of every row with a ``text``."""
    at = lambda column, i: F.get(column, i)
    # What is left without lower-case letters is short; most counts are taken from it.
    rows = rows.select(own, "text", F.regexp_replace("text", "[a-z]+", "").alias("rest"), word_array(F.col("text")).alias("words"))
    with_word = F.filter(F.split("text", "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0)
    rows = rows.select(
        own,
        (F.length("text") - _count_of(F.col("rest"), SPACE_CLASS[1:-1])).alias("word_chars"),
        _count_of(F.col("rest"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("rest"), "A-Z").alias("n_upper"),
        _count_of(F.col("rest"), "0-9").alias("n_digits"),
        _count_of(F.col("rest"), "!?").alias("n_marks"),
        with_word.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"),
    )
    lines, h1, n = F.col("lines"), F.col("h1"), F.size("h1")
    counts = ["word_chars", "n_symbols", "n_upper", "n_digits", "n_marks", "n_lines", "n_dup_lines", "n_words", "n_distinct"]
    rows = rows.select(
        own,
        *counts[:5],
        F.size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        n.alias("n_words"),
        F.size(F.array_distinct("h1")).alias("n_distinct"),
        F.transform("h1", lambda x, i: F.xxhash64(x, at(h1, i + 1))).alias("h2"),
    )
    rows = rows.select(own, *counts, F.transform("h2", lambda x, i: F.xxhash64(x, at(F.col("h2"), i + 2))).alias("h4"))
    windows = F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0))
    rows = rows.select(
        own, *counts,
        F.slice(F.transform("h4", lambda x, i: F.xxhash64(x, at(F.col("h4"), i + 4))), F.lit(1), windows).alias("h8"),
    )
    rows = rows.withColumn("repeats", F.size(F.array_distinct("h8")) < F.size("h8"))
    placed = F.sort_array(F.transform("h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.select(own, *counts, F.when(F.col("repeats"), placed).alias("placed"))
    near = lambda e, i: F.coalesce(e["h"] == at(F.col("placed"), i)["h"], F.lit(False))
    found = F.filter("placed", lambda e, i: near(e, i + 1) | near(e, i - 1))
    rows = rows.select(own, *counts, F.sort_array(F.transform(found, lambda e: e["i"])).alias("starts"))
    covered = F.aggregate(
        F.transform("starts", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(at(F.col("starts"), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    rows = rows.select(own, *counts, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    return rows.select(own, *[F.col(c).cast("long").alias(c) for c in [*counts, "n_repeat_words"]])


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def ratio(name: str) -> Column:
    """A tested ratio over the columns of ``statistics``; zero where its divisor is."""
    above, below = RATIOS[name]
    return F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    """``ratio >= cut`` or ``ratio < cut``."""

    name: str
    cut: float
    above: bool

    def column(self) -> Column:
        return (ratio(self.name) >= self.cut) if self.above else (ratio(self.name) < self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.cut:.4g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule) -> Column:
    covered = F.lit(True)
    for condition in rule:
        covered = covered & condition.column()
    return covered


def expression(rules: list[Rule]) -> Column:
    """False where a rule of the ordered list applies, else true."""
    if not rules:
        return F.lit(True)
    verdict = F.when(covers(rules[0]), F.lit(False))
    for rule in rules[1:]:
        verdict = verdict.when(covers(rule), F.lit(False))
    return verdict.otherwise(True)


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts a value reaches."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: value >= cut))


def _grow(rows: DataFrame, cuts: dict[str, list[float]], longest: int) -> Rule:
    """Adds the threshold with the largest gain until no good row is covered, nothing is gained or the rule is full."""
    rule: Rule = ()
    while len(rule) < longest:
        tests = F.array(*[F.struct(F.lit(name).alias("name"), _bin(ratio(name), own).alias("bin")) for name, own in cuts.items()])
        counted = (
            rows.where(covers(rule)).select("bad", F.explode(tests).alias("t")).groupBy("t.name", "t.bin")
            .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect()
        )
        table = {name: [[0, 0] for _ in range(len(own) + 1)] for name, own in cuts.items()}
        for r in counted:
            table[r["name"]][r["bin"]] = [r["bad"], r["good"]]
        if not counted:
            return rule
        bad, good = (sum(x[k] for x in next(iter(table.values()))) for k in (0, 1))
        if not good or not bad:
            return rule
        best, chosen = 1e-9, None
        for name, bins in table.items():
            low = [0, 0]
            for k, cut in enumerate(cuts[name]):
                low = [low[0] + bins[k][0], low[1] + bins[k][1]]
                for above, p, n in ((True, bad - low[0], good - low[1]), (False, low[0], low[1])):
                    gain = p * (log2(p / (p + n)) - log2(bad / (bad + good))) if p else 0.0
                    if gain > best:
                        best, chosen = gain, Condition(name, cut, above)
        if chosen is None:
            return rule
        rule = (*rule, chosen)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of the rule with the largest (bad - good) / (bad + good), and what it covers."""
    sums = []
    for k in range(1, len(rule) + 1):
        covered = covers(rule[:k])
        sums += [F.sum(F.when(covered, F.col("bad"))), F.sum(F.when(covered, 1 - F.col("bad")))]
    found = [x or 0 for x in rows.agg(*sums).first()]
    worth = [(found[2 * k], found[2 * k + 1]) for k in range(len(rule))]
    best = max(range(len(rule)), key=lambda k: (worth[k][0] - worth[k][1]) / max(1, sum(worth[k])))
    return rule[: best + 1], *worth[best]


def learn(
    stats: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    bins: int = 48,
    longest: int = 3,
    precision: float = 0.97,
) -> list[Rule]:
    """Ordered rules that tell rejected texts (label 0) from good ones (label 1), from rows that pass the base rules.

    Covering goes on until a grown rule has fewer than two rejected rows. A rule that fails on the prune rows is not taken;
    the rows that it covers are set aside, so that the next one is about others.
    """
    given = labels.select(labels[id_column].alias("doc_id"), labels[label_column].cast("int").alias("label"))
    rows = stats.where(~base_failed()).join(given.where(F.col("label").isin(0, 1)), "doc_id")
    prune = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    used = sorted({c for pair in RATIOS.values() for c in pair})
    rows = stage_table(rows.select(*used, (1 - F.col("label")).alias("bad"), prune.alias("prune")), "labelled")
    steps = [(k + 1) / (bins + 1) for k in range(bins)]
    # Half of the thresholds come from the rejected rows, so that rare kinds of them are told apart as well.
    marks = rows.groupBy("bad").agg(*[F.percentile_approx(ratio(name), steps, 10_000).alias(name) for name in RATIOS]).collect()
    cuts = {name: sorted({float(x) for r in marks for x in r[name] or ()}) for name in RATIOS}
    if len(marks) < 2:
        return []
    rules: list[Rule] = []
    failed: list[Rule] = []
    while True:
        left = rows.where(expression(rules))
        grow = left.where(~F.col("prune") & expression(failed))
        rule = _grow(grow, cuts, longest)
        if not rule or (grow.where(covers(rule)).agg(F.sum("bad")).first()[0] or 0) < 2:
            return rules
        pruned, bad, good = _prune(left.where(F.col("prune")), rule)
        if bad < 2 or bad < precision * (bad + good):
            failed.append(rule)
        else:
            rules.append(pruned)


def apply(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & expression(rules))


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_row`` (the whole row), ``doc_id`` and the statistics, staged: texts are read and counted once."""
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    rows = _statistics(docs.select(F.struct("*").alias("_row"), text.alias("text")), "_row")
    return stage_table(rows.withColumn("doc_id", F.col(f"_row.{id_column}")), "described")


def keep(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows behind :func:`described` that neither the base rules nor the list reject, unchanged."""
    return apply(rows, rules).where("kept").select("_row.*")


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, the statistics, ``base_failed`` and ``kept`` of every row."""
    stats = stage_table(statistics(docs, id_column, text_column), "text-statistics")
    return apply(stats, learn(stats, labels, id_column=id_column))
