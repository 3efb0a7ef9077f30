"""Quality rules as a short-circuit cascade, in column expressions only.

A rule rejects a document by a few counts over its whole text. On a sample each
rule is timed and its rejections are counted; the rules then stand in the order of
rejections per cost, and one ``CASE`` applies them: a document pays for a rule only when all rules
before it let it pass. The order changes the cost, never the verdict, because
a document is kept when no rule rejects it.

Words are runs of anything but ASCII white space. Null texts have no words, so the word-count rule rejects them; empty
tables stay empty; documents of any length are measured whole. Repeated rows are judged one by one, other
columns pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.binding import let
from wattmill.llm.common import SPACES, text_or_empty
from wattmill.session import stage

WINDOW = 5
#: Rows of the sample on which rules are timed; it decides their order only.
SAMPLE_ROWS = 2000
#: Timed runs of each rule, and the seconds below which costs are not told apart.
RUNS, LEAST = 2, 0.005


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACES}]+", -1))


def word_chars(text: Column) -> Column:
    """Code points inside words."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[^{SPACES}]+", ""))).cast("long")


def symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def capitals(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACES}]"))


def repeated_lines(text: Column) -> Column:
    return let(worded_lines(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def repeated_words(found: Column) -> Column:
    """Words inside windows of five words that occur twice or more.

    Hashes of the windows tell documents without any repetition apart; only the
    others compare the windows themselves: sorted with their positions, a window is repeated
    when a neighbour is equal, and the covered words are counted from one repeated position to the next.
    """
    starts = F.sequence(F.lit(1), F.size(found) - (WINDOW - 1))

    def hashed(at: Column) -> Column:
        return F.xxhash64(*[F.get(found, at + (i - 1)) for i in range(WINDOW)])

    def written(at: Column) -> Column:
        return F.struct(F.array_join(F.slice(found, at, WINDOW), " ").alias("window"), at.alias("at"))

    def positions(ordered: Column) -> Column:
        def repeated(at: Column) -> Column:
            here = F.get(ordered, at - 1)["window"]
            before, after = F.get(ordered, at - 2)["window"], F.get(ordered, at)["window"]
            return F.coalesce(here == before, F.lit(False)) | F.coalesce(here == after, F.lit(False))

        return F.sort_array(F.transform(F.filter(starts, repeated), lambda at: F.get(ordered, at - 1)["at"]))

    def covered(places: Column) -> Column:
        return F.aggregate(
            places,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
            lambda acc, at: F.struct(at.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("total")),
            lambda acc: acc["total"],
        )

    exact = let(F.sort_array(F.transform(starts, written)), lambda ordered: let(positions(ordered), covered))
    unique = let(F.transform(starts, hashed), lambda keys: F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(F.size(found) <= WINDOW, 0).when(unique, 0).otherwise(exact).cast("long")


#: Each count over a text; the words are cut once and shared by the counts that need them.
COUNTS: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda text: let(words(text), lambda w: F.size(w).cast("long")),
    "word_chars": word_chars,
    "n_symbols": symbols,
    "n_capitals": capitals,
    "n_dup_lines": repeated_lines,
    "n_lines": lambda text: F.size(worded_lines(text)).cast("long"),
    "n_repeat_words": lambda text: let(words(text), repeated_words),
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the named counts in order."""

    name: str
    counts: tuple[str, ...]
    rejects: Callable[..., Column]


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
    Rule("symbols", ("n_symbols", "word_chars"), lambda s, c: 100 * s > 5 * c),
    Rule("capitals", ("n_capitals", "word_chars"), lambda u, c: 100 * u > 50 * c),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: (d > 0) & (100 * d > 30 * n)),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 20 * n)),
)


def measure(docs: DataFrame, text: str = "text", counts: Sequence[str] = tuple(COUNTS)) -> DataFrame:
    """``docs`` with ``counts``, the word counts among them; words are cut once for both counts that need them."""
    whole = text_or_empty(text)
    plain = [COUNTS[name](whole).alias(name) for name in counts if name not in ("n_words", "n_repeat_words")]
    both = let(words(whole), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    rest = [c for c in docs.columns if c not in counts]
    counted = docs.select(*rest, *plain, both.alias("_w"))
    return counted.select(*rest, *[F.col(f"_w.{n}").alias(n) if n in ("n_words", "n_repeat_words") else F.col(n) for n in counts])


def rejection(rule: Rule, text: Column | None = None, known: Sequence[str] = ()) -> Column:
    """Whether ``rule`` rejects, from the text or, for ``known`` counts or without a text, from measured columns."""
    return rule.rejects(*[F.col(c) if text is None or c in known else COUNTS[c](text) for c in rule.counts])


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    share: float


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on a sample of about ``rows`` documents.

    The cost is the shortest of :data:`RUNS` runs after one that compiles, less that of a job that only reads the texts.
    """
    total = docs.count()
    if not total:
        return [Estimate(r.name, 0.0, 0.0) for r in rules]
    drawn = docs.select(text_or_empty(text).alias("text")).sample(min(1.0, rows / total), seed=11)
    sample = stage(drawn.repartition(docs.sparkSession.sparkContext.defaultParallelism), "rule-sample")

    def timed(value: Column) -> tuple[float, float]:
        began = time.perf_counter()
        got = sample.agg(value).first()[0]
        return time.perf_counter() - began, got or 0.0

    shares = [F.avg(rejection(rule, F.col("text")).cast("double")) for rule in rules]
    nothing = F.avg(F.length("text").cast("double"))
    for value in [nothing, *shares]:  # the first run of each pays for its compilation
        timed(value)
    empty = min(timed(nothing)[0] for _ in range(RUNS))
    found = []
    for rule, share in zip(rules, shares, strict=True):
        runs = [timed(share) for _ in range(RUNS)]
        found.append(Estimate(rule.name, max(min(r[0] for r in runs) - empty, LEAST), runs[0][1]))
    return found


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """Rules by rejection per cost, best first; equal ones keep their order."""
    worth = {e.name: e.share / max(e.seconds, 1e-9) for e in estimates}
    return sorted(rules, key=lambda r: -worth[r.name])


def cascade(rules: Sequence[Rule], text: Column | None = None, known: Sequence[str] = ()) -> Column:
    """Name of the first rule that rejects, null when none does; later rules are not evaluated."""
    first = F.lit(None).cast("string")
    for i, rule in enumerate(rules):
        hit = rejection(rule, text, known)
        first = F.when(hit, rule.name) if i == 0 else first.when(hit, rule.name)
    return first


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns unchanged."""
    order = ordered(rules, estimate(docs, rules, text))
    return docs.where(cascade(order, text_or_empty(text)).isNull())
