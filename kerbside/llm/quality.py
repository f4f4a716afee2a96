"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated.

No rule decides alone. Each votes for good or bad or abstains; expectation-maximisation over
the counts of vote patterns estimates how often each rule votes what for good and for bad
documents, and a document is kept if its posterior probability of being good is at least one
half. The number of patterns is bounded by the rules, three to the power of their number, so
the estimation runs on the driver over all documents' counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import small_batches, text_bytes
from kerbside.session import store

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
            "n_lower", "n_marks", "n_stops", "n_distinct", "n_punctuation")
GOOD, BAD, ABSTAIN = 2, 0, 1
FALSE_ALARMS = 0.005   # share of good documents that a rule blames, at most
# Fixed bytes of the word contract and of the counts.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))


# One row per rule: name, when it votes bad, when it votes good; else it abstains. The counts of
# a text are divided by its words, filled lines or letters.
RULES = (
    ("length", "n_words < 20", "n_words >= 50"),
    ("mean_word", "per_word.chars NOT BETWEEN 2.5 AND 12", "per_word.chars BETWEEN 3.5 AND 9"),
    ("symbols", "per_word.symbols > 0.05", "per_word.symbols < 0.01"),
    ("symbol_share", "n_symbols > 0.01 * word_chars", "n_symbols < 0.002 * word_chars"),
    ("punctuation", "n_punctuation > 0.08 * word_chars", "n_punctuation < 0.06 * word_chars"),
    ("dup_lines", "n_dup_lines > 0.5 * n_lines", "n_dup_lines = 0"),
    ("repeats", "per_word.repeats > 0.25", "per_word.repeats < 0.1"),
    ("upper", "n_upper > 0.3 * (n_upper + n_lower)", "n_upper < 0.1 * (n_upper + n_lower)"),
    ("marks", "per_word.marks > 0.2", "per_word.marks < 0.05"),
    ("sentences", "per_word.stops < 0.005", "per_word.stops BETWEEN 0.02 AND 0.3"),
    ("variety", "n_words >= 30 AND per_word.distinct < 0.3", "per_word.distinct > 0.5"),
)
PER_WORD = {"chars": "word_chars", "symbols": "n_symbols", "repeats": "n_repeat_words", "marks": "n_marks",
            "stops": "n_stops", "distinct": "n_distinct"}


def counts(text: bytes) -> tuple[int, ...]:
    """The numbers of ``FEATURES`` for a whole text given as UTF-8."""
    words = text.split()
    n = len(words)
    lines: dict[bytes, int] = {}
    duplicates = filled = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            filled += 1
            if line in lines:
                duplicates += 1
            lines[line] = 1
    characters = len(text.decode("utf-8", "replace"))
    space = len(text) - len(text.translate(None, SPACES))
    return (n, characters - space, len(text) - len(text.translate(None, SYMBOLS)), duplicates, _repeated(words),
            filled, len(text) - len(text.translate(None, UPPER)), len(text) - len(text.translate(None, LOWER)),
            text.count(b"!") + text.count(b"?"), text.count(b"."), len(set(words)),
            len(text) - len(text.translate(None, PUNCTUATION)))


def _repeated(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    total, covered = 0, 0   # words before ``covered`` are counted or passed
    for i, window in enumerate(windows):
        if seen[window] > 1:
            total += i + 3 - max(covered, i)
            covered = i + 3
    return total


def _counts_of(texts):
    import pandas as pd

    return pd.DataFrame([counts(text) for text in texts], columns=list(FEATURES), dtype="int64")


def pattern() -> Column:
    """The votes of all rules as one number in base three."""
    total = "0L"
    for k, (_, bad, good) in enumerate(RULES):
        for share, count in PER_WORD.items():
            bad, good = (x.replace(f"per_word.{share}", f"{count} / greatest(n_words, 1)") for x in (bad, good))
        total += f" + {3 ** k} * (CASE WHEN {bad} THEN {BAD} WHEN {good} THEN {GOOD} ELSE {ABSTAIN} END)"
    return F.expr(total)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def estimate(patterns: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Posterior probability of good for each pattern, by expectation-maximisation."""
    import numpy as np

    if not patterns:
        return {}
    codes = np.array(sorted(patterns))
    weight = np.array([patterns[c] for c in codes], float)
    votes = np.stack([codes // 3 ** k % 3 for k in range(len(RULES))], 1)
    hot = np.eye(3)[votes]                                  # pattern x rule x vote
    # the start: rules rarely blame good documents, and a bad one is often blamed by few rules
    good = np.tile([0.005, 0.05, 0.945], (len(RULES), 1))
    bad = np.tile([0.15, 0.05, 0.80], (len(RULES), 1))
    prior = 0.8
    for _ in range(rounds):
        up = np.log(prior) + (hot * np.log(good)).sum((1, 2))
        down = np.log(1 - prior) + (hot * np.log(bad)).sum((1, 2))
        posterior = 1 / (1 + np.exp(np.clip(down - up, -700, 700)))
        g, b = weight * posterior, weight * (1 - posterior)
        before = prior
        # one vote of each kind more keeps every probability above zero
        prior = (g.sum() + 1) / (weight.sum() + 2)
        good = (np.einsum("p,prv->rv", g, hot) + 0.5) / (g.sum() + 1.5)
        # a rule is one that blames few good documents: that much is known of it beforehand
        good[:, BAD] = np.minimum(good[:, BAD], FALSE_ALARMS)
        bad = (np.einsum("p,prv->rv", b, hot) + 0.5) / (b.sum() + 1.5)
        if abs(prior - before) < 1e-9:
            break
    return dict(zip(codes.tolist(), posterior.tolist()))


def counted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with a struct ``__f`` of the counts of each whole text; null counts as empty.

    Declared nondeterministic, as a filter on the counts would else be moved below them with a copy
    of the function: texts would be counted again, in a second Python worker for each core.
    """
    of = F.pandas_udf(_counts_of, ", ".join(f"{name} long" for name in FEATURES), F.PandasUDFType.SCALAR)
    return small_batches(docs).withColumn("__f", of.asNondeterministic()(text_bytes(text_column)))


def verdicts(patterns: DataFrame) -> DataFrame:
    """(pattern, posterior) from a column ``pattern``; all rows count."""
    found = {r["pattern"]: r["n"] for r in patterns.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    return patterns.sparkSession.createDataFrame(list(estimate(found).items()), "pattern long, posterior double")


def assess(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, the counts, base_failed, posterior, kept.

    Null texts count as empty and fail the base rules, as all texts of under 50 words do.
    Repeated rows and ids give a row each, and each counts in the estimation. Other columns
    are not read. An empty table gives an empty one.
    """
    given = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    features = store(counted(given, "__text").select("__id", "__f.*"))
    voted = features.withColumn("pattern", pattern())
    # at most 3 ** len(RULES) patterns
    known = voted.join(F.broadcast(verdicts(voted)), "pattern")
    return known.withColumn("base_failed", base_failed()).select(
        F.col("__id").alias(id_column), *FEATURES, "base_failed", "posterior",
        (~F.col("base_failed") & (F.col("posterior") >= 0.5)).alias("kept"))


def keep_good(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The texts are counted twice, for
    the estimation and for the filter, rather than stored a second time."""
    votes = counted(docs.select(F.col(text_column).alias("__text")), "__text").select("__f.*").select(
        pattern().alias("pattern"))
    known = verdicts(votes).select(F.col("pattern").alias("__pattern"), F.col("posterior").alias("__posterior"))
    # the row is wrapped, as its columns may bear the names of counts
    flat = counted(docs, text_column).select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "__f.*")
    good = flat.withColumn("__pattern", pattern()).join(F.broadcast(known), "__pattern").where(
        ~base_failed() & (F.col("__posterior") >= 0.5))
    return good.select("__row.*")
