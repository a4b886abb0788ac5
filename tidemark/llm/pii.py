"""Personal data: base patterns, and candidates that gradient-boosted trees judge, in DataFrame functions only.

Generators with high recall propose spans: values that are assigned to something, long mixed runs, groups of digits, words around
an at sign. Boosted trees score each from its format and from the characters around it. They are taught by what is known for
certain: spans that the base patterns confirm, and values that follow a telling word, are positive; the other candidates are
negative. The telling words and the base checks themselves are not features. A threshold per kind is calibrated on candidates
the trees were not taught on. The trees become conditional expressions over a row's own array of candidates, so scoring neither
shuffles nor leaves the row.

Positions are code points, ends exclusive. Defined cases: a null or empty text has no spans; rows are judged one by one, so
repeated rows give repeated results; with no candidates, or of one kind only, nothing is added to the base spans; an empty table
gives an empty table; other columns are ignored by ``find`` and kept by ``redact``; texts may be of any length and hold any number
of spans: the patterns never try a run of characters twice, arrays are worked through in slices, long texts are cut by pieces, and
an overlap is looked up by halving.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, texts_of
from tidemark.session import stage_table

#: Same matches as the plain patterns. Looking back keeps a search from starting again within a run that has failed, and runs
#: are possessive where nothing could be given back.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base kinds.
PROPOSED = {
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{16,}+",
    "number": r"(?<![0-9])[0-9](?:[\x20().-]?[0-9]){6,}+",
    "address": r"(?<![^\x20\x09-\x0D\"'<>(),;])[^\x20\x09-\x0D\"'<>(),;@]++@[^\x20\x09-\x0D\"'<>(),;@]++",
}
#: A text without this has no match of the kind.
_NEEDS = {"email": "@", "address": "@", "phone": "+"}
_TELLING = r"(?i)(?:token|secret|passw(?:or)?d|pwd|api.?key|access.?key|credential)"
_AROUND = 24
FEATURES = [
    "kind", "length", "digits", "upper", "lower", "marks", "hexadecimal", "changes", "groups", "plus", "points", "assigned", "quoted", "closed", "luhn",
]
#: Different candidates that a task of the fit gets at most, in the mean, and the precision a threshold must reach.
TASK_ROWS, PRECISION = 10_000, 0.95

Spans = Column
#: Items of an array that are worked through at once; characters of a piece of a long text, and from where a text is long.
_SLICE, _PIECE, _LONG = 64, 1024, 4096


def _bound(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct of the values, which are computed once however often it names them, inside lambdas too."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), use), F.lit(0))


def _in_slices(
    items: Column, first: Column, carry: Callable[[Column, Column], Column], make: Callable[[Column, Column], Column]
) -> Column:
    """Array of ``make(slice, state)`` for each slice of the items, where the state is ``carry`` folded over all items before it.

    Appending to an array copies it, so one fold over n items would take n^2 steps; here an append copies a slice, or one state
    per slice.
    """

    def sliced(x: Column) -> Column:
        part = lambda i: F.slice(x["items"], i * _SLICE + 1, F.lit(_SLICE))
        numbers = F.sequence(F.lit(0), F.ceil(F.size(x["items"]) / _SLICE).cast("int") - 1)
        start = F.struct(F.array().cast("array<int>").alias("all"), first.alias("at"))

        def add(done: Column, i: Column) -> Column:
            after = F.aggregate(part(i), done["at"], carry)
            return F.struct(F.concat(done["all"], F.array(done["at"])).alias("all"), after.alias("at"))

        states = F.aggregate(numbers, start, add, lambda done: done["all"])
        return F.transform(states, lambda state, i: make(part(i), state))

    def choose(x: Column) -> Column:
        return F.when(F.size(x["items"]) <= _SLICE, F.array(make(x["items"], first))).otherwise(sliced(x))

    return _bound({"items": items}, choose)


def _pieces(text: Column) -> Column:
    """A long text in pieces of ``_PIECE`` code points; no pieces of a short one."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    return F.when(F.length(text) > _LONG, cut).otherwise(F.array().cast("array<string>"))


def _cut(text: Column, pieces: Column, start: Column, length: Column) -> Column:
    """``length`` code points from ``start``; a substring of a long text alone would count from its beginning each time."""
    inside = F.pmod(start, F.lit(_PIECE))
    held = F.slice(pieces, F.floor(start / _PIECE).cast("int") + 1, F.floor((inside + length) / _PIECE).cast("int") + 1)
    near = F.substring(F.array_join(held, ""), inside + 1, length)
    return F.when(F.size(pieces) == 0, F.substring(text, start + 1, length)).otherwise(near)


def matches(text: Column, pattern: str) -> Spans:
    """Array of (s, e, t): where each leftmost match starts and ends, and its text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    none = F.array().cast("array<struct<s:int,e:int,t:string>>")

    def make(pairs: Column, before: Column) -> Column:
        def add(done: Column, both: Column) -> Column:
            start = F.coalesce(F.get(done, F.size(done) - 1)["e"], before) + both["gap"]
            span = F.struct(start.alias("s"), (start + F.length(both["t"])).alias("e"), both["t"].alias("t"))
            return F.concat(done, F.array(span))

        return F.aggregate(pairs, none, add)

    pairs = _bound(
        {"found": found, "between": between},
        lambda x: F.transform(x["found"], lambda t, i: F.struct(F.get(x["between"], i).alias("gap"), t.alias("t"))),
    )
    return F.flatten(_in_slices(pairs, F.lit(0), lambda at, both: at + both["gap"] + F.length(both["t"]), make))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check; doubled from the second digit from the right."""

    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 0, digit).when(double > 9, double - 9).otherwise(double)

    numbers = F.sequence(F.lit(0), F.length(digits) - 1)
    return (F.length(digits) > 0) & (F.aggregate(F.transform(numbers, value), F.lit(0), lambda a, b: a + b) % 10 == 0)


def _valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(t, "\\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(t))
        return n.between(16, 19) & F.when(n.between(16, 19), luhn(_digits(t)))
    if kind == "phone":
        return F.length(_digits(t)).between(8, 15)
    return F.lit(True)


def _where_needed(kind: str, text: Column, spans: Spans) -> Spans:
    needed = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else F.lit(True)
    if kind in ("ip", "card", "phone", "number", "secret"):
        needed = needed & F.col("has_digits")
    return F.when(needed, spans).otherwise(F.array().cast("array<struct<s:int,e:int,t:string>>"))


def _features(text: Column, pieces: Column, kind: str, x: Column) -> Column:
    """A candidate's place, features and the certain knowledge about it."""
    t = x["t"]
    before = _cut(text, pieces, F.greatest(x["s"] - _AROUND, F.lit(0)), F.least(x["s"], F.lit(_AROUND)))
    after = _cut(text, pieces, x["e"], F.lit(1))
    size = F.length(t).cast("double")
    count = lambda c: (size - F.length(F.regexp_replace(t, c, ""))) / size
    digits = F.length(_digits(t)).cast("double")
    flag = lambda c: c.cast("double")
    values = {
        "kind": F.lit(float(list(PROPOSED).index(kind))),
        "length": F.least(size, F.lit(100.0)),
        "digits": digits / size,
        "upper": count("[A-Z]+"),
        "lower": count("[a-z]+"),
        "marks": count("[A-Za-z0-9]+") * -1 + 1,
        "hexadecimal": flag(t.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "changes": F.least(F.size(F.regexp_extract_all(t, F.lit("[0-9]+"), F.lit(0))), F.lit(30)).cast("double"),
        "groups": F.least(digits, F.lit(40.0)),
        "plus": flag(F.endswith(before, F.lit("+"))),
        "points": F.least(F.length(F.regexp_replace(t, "[^.]+", "")), F.lit(10)).cast("double"),
        "assigned": flag(before.rlike("[=:]\\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$")),
        "closed": flag(after.rlike("[\"']")),
        "luhn": flag(F.when(digits.between(12, 19), luhn(_digits(t))).otherwise(False)),
    }
    return F.struct(
        F.lit(kind).alias("kind_name"), x["s"].alias("s"), x["e"].alias("e"),
        F.array(*[values[name] for name in FEATURES]).alias("f"),
        before.rlike(_TELLING + "\\W*$").alias("telling"),
    )


def _confirmed(kind: str, spans: Spans) -> Column:
    valid = F.filter(spans, lambda x: _valid(kind, x["t"]))
    return F.transform(valid, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def _proposals(text: Column, pieces: Column, kind: str, spans: Spans) -> Column:
    return F.transform(spans, lambda x: _features(text, pieces, kind, x))


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, base, candidates``: confirmed spans (kind, s, e) in order of kind and start, and proposed ones."""
    prepare(docs.sparkSession)
    return _found(texts_of(docs, id_column, text_column))


def _found(rows: DataFrame) -> DataFrame:
    """Adds ``base`` and ``candidates`` to rows with a ``text``."""
    own, text = rows.columns, F.col("text")
    rows = rows.withColumns({"has_digits": text.rlike("[0-9]"), "pieces": _pieces(text)})
    rows = rows.withColumns({f"m_{k}": _where_needed(k, text, matches(text, p)) for k, p in {**BASE, **PROPOSED}.items()})
    base = [_confirmed(kind, F.col(f"m_{kind}")) for kind in BASE]
    proposed = [_proposals(text, F.col("pieces"), kind, F.col(f"m_{kind}")) for kind in PROPOSED]
    rows = rows.select(*own, F.concat(*base).alias("base"), F.concat(*proposed).alias("candidates"))
    return rows


def _judged(base: Column, candidates: Column, use: Callable[[Column, Callable[[Column], Column]], Column]) -> Column:
    """``use(candidates, overlaps)``, where ``overlaps`` tells of a candidate whether it meets a base span.

    The spans of one kind are in order and apart, so only the last one that begins before a candidate ends can meet it.
    """

    def looked_up(spans: Column, x: Column) -> Column:
        def halve(at: Column, _: Column) -> Column:
            middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
            before = F.get(spans, middle)["s"] < x["e"]
            low = F.when((at["low"] < at["high"]) & before, middle + 1).otherwise(at["low"])
            high = F.when((at["low"] < at["high"]) & ~before, middle).otherwise(at["high"])
            return F.struct(low.alias("low"), high.alias("high"))

        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(spans) + 1)).cast("int") + 1)
        begun = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve, lambda at: at["low"])
        return F.coalesce(F.get(spans, begun - 1)["e"] > x["s"], F.lit(False))

    def choose(o: Column) -> Column:
        few = lambda x: F.exists(o["base"], lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))

        def many(x: Column) -> Column:
            found = F.lit(False)
            for kind in BASE:
                found = found | ((F.size(o[kind]) > 0) & looked_up(o[kind], x))
            return found

        return use(o["candidates"], lambda x: F.when(F.size(o["base"]) <= _SLICE, few(x)).otherwise(many(x)))

    def of_kind(kind: str) -> Column:
        return F.filter(base, lambda b: (b["kind"] == kind) & (F.size(base) > _SLICE))

    kinds = {kind: of_kind(kind) for kind in BASE}
    return _bound({"base": base, "candidates": candidates, **kinds}, choose)


@dataclass(frozen=True)
class Model:
    """Boosted trees as (weight, tree) with trees of (feature, threshold, left, right) or a leaf value; thresholds by kind."""

    trees: tuple
    thresholds: dict[str, float]

    def margin(self, features: Column) -> Column:
        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            feature, threshold, left, right = tree
            return F.when(F.get(features, F.lit(feature)) <= threshold, of(left)).otherwise(of(right))

        total = F.lit(0.0)
        for weight, tree in self.trees:
            total = total + F.lit(float(weight)) * of(tree)
        return total

    def accepts(self, x: Column) -> Column:
        needed = F.lit(float("inf"))
        for kind, threshold in self.thresholds.items():
            needed = F.when(x["kind_name"] == kind, F.lit(float(threshold))).otherwise(needed)
        return self.margin(x["f"]) >= needed


def _tree(lines: list[str]):
    """A tree from the lines of its printed form."""
    line = lines.pop(0)
    if leaf := re.search(r"Predict: (\S+)", line):
        return float(leaf[1])
    feature, threshold = re.search(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    left = _tree(lines)
    lines.pop(0)  # the Else of the same test
    return int(feature), float(threshold), left, _tree(lines)


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Trees and thresholds from all candidates of ``docs``: three in four different ones teach, the others test."""
    found = find(docs, id_column, text_column).where(F.size("candidates") > 0)

    def labelled(candidates: Column, overlaps: Callable[[Column], Column]) -> Column:
        label = lambda x: (x["telling"] | overlaps(x)).cast("double")
        return F.transform(candidates, lambda x: F.struct(x["kind_name"].alias("kind_name"), x["f"].alias("f"), label(x).alias("label")))

    # Labels come before the rows are opened: a row would otherwise take all base spans of its text along.
    rows = found.select(F.explode(_judged(F.col("base"), F.col("candidates"), labelled)).alias("x")).select("x.*")
    # Copies repeat candidates; the hash over the features keeps each kind of candidate once.
    rows = rows.groupBy("kind_name", "f").agg(F.max("label").alias("label")).withColumn("mark", F.xxhash64("kind_name", "f"))
    # Written in the order of the hash, in parts of bounded size: the fit meets the same rows in the same order in every run.
    rows = stage_table(rows, "all-candidates")
    tasks = max(2, -(-rows.count() // TASK_ROWS))
    rows = stage_table(rows.repartitionByRange(tasks, "mark").sortWithinPartitions("mark", "kind_name", "label"), "candidates")
    taught, tested = rows.where(F.pmod("mark", F.lit(4)) != 0), rows.where(F.pmod("mark", F.lit(4)) == 0)
    if taught.select("label").distinct().count() < 2:
        return Model((), {})
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        taught.select("label", *[F.get("f", F.lit(i)).alias(name) for i, name in enumerate(FEATURES)])
    )
    fitted = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, maxBins=32).fit(vectors)
    trees = tuple((w, _tree(t.toDebugString.strip().split("\n")[1:])) for w, t in zip(fitted.treeWeights, fitted.trees))
    model = Model(trees, {})
    cell = F.floor(model.margin(F.col("f")) * 20).alias("cell")
    counted = tested.groupBy("kind_name", cell).agg(F.sum("label"), F.count("*")).orderBy("kind_name", F.desc("cell")).collect()
    thresholds: dict[str, float] = {}
    right: dict[str, list[float]] = {}
    for kind, at, ones, n in counted:
        so_far = right.setdefault(kind, [0.0, 0.0])
        so_far[0] += ones
        so_far[1] += n
        if so_far[0] >= PRECISION * so_far[1] and so_far[0] >= 3:
            thresholds[kind] = at / 20
    return Model(trees, thresholds)


def with_spans(found: DataFrame, model: Model) -> DataFrame:
    """Adds ``spans``: the base spans and the accepted candidates that overlap none of them, as (kind, s, e)."""

    def free(candidates: Column, overlaps: Callable[[Column], Column]) -> Column:
        return F.filter(candidates, lambda x: ~overlaps(x) & model.accepts(x))

    added = _judged(F.col("base"), F.col("candidates"), free)
    plain = F.transform(added, lambda x: F.struct(x["kind_name"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return found.withColumn("spans", F.concat("base", plain) if model.thresholds else F.col("base"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; null texts stay null.

    Spans that touch or overlap are replaced together, by the kind of the first."""
    own = docs.columns
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    rows = with_spans(_found(rows), model)
    spans = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    text, pieces = F.col("text"), F.col("pieces")
    rows = rows.withColumns({"pieces": _pieces(text), "ordered": F.array_sort(spans), "size": F.length(text)})

    def make(part: Column, before: Column) -> Column:
        """The text up to the last span of a slice, from where the spans before it end."""
        start = F.struct(before.alias("at"), F.lit("").alias("out"))

        def add(done: Column, x: Column) -> Column:
            between = _cut(text, pieces, done["at"], F.greatest(x["s"] - done["at"], F.lit(0)))
            marked = F.when(x["s"] < done["at"], F.lit("")).otherwise(F.concat(F.lit("["), x["kind"], F.lit("]")))
            return F.struct(F.greatest(done["at"], x["e"]).alias("at"), F.concat(done["out"], between, marked).alias("out"))

        return F.aggregate(part, start, add, lambda done: done["out"])

    parts = _in_slices(F.col("ordered"), F.lit(0), lambda at, x: F.greatest(at, x["e"]), make)
    end = F.array_max(F.transform("ordered", lambda x: x["e"]))
    rest = _cut(text, pieces, end, F.col("size") - end)
    clean = F.when(F.size("ordered") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(text)
    rows = rows.withColumn("_clean", F.when(F.col("_row")[text_column].isNotNull(), clean))
    return rows.select(*[F.col("_clean").alias(c) if c == text_column else F.col("_row")[c].alias(c) for c in own])
