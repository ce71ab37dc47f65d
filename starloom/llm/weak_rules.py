"""Quality rules as weak supervision.

A rule looks at a few measures of a document and votes good or bad, or abstains. No rule decides:
expectation-maximisation over the votes of all documents estimates how often each rule that
votes is right on good and on bad documents (Dawid and Skene's model of unreliable raters, with
abstentions as missing), and the posterior probability of being good, given all votes cast, is
the verdict. One bad vote need not outweigh all good ones, and several weak ones add up.

Votes enter the estimate only as counts per pattern of votes. There are at most three to the
power of the number of rules of them, however many documents there are, so the counts of the
whole table are one grouping with map-side sums and the estimate a small loop over them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.arrays import bound_batches
from starloom.sinks.scratch import pin

SYMBOLS = b"#*$%&|<>"
#: Words of a window that may repeat.
WINDOW = 3
#: A document fails outright with fewer words, or if more than this per cent of them repeat.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Documents that are good with at least this probability are kept.
KEPT = 0.5

#: Rules at most: the patterns of votes must stay few (3 ** 10 = 59,049).
MOST_RULES = 10
#: Votes of either kind that every rule is given in advance, so no frequency is ever 0.
PRIOR = 1.0
ROUNDS, SETTLED = 1000, 1e-10
#: What is believed of a rule in advance: it votes bad on this share of the good documents, as
#: firmly as if that had been seen on ``TRUST`` times the table. Rules of unknown worth deserve
#: less (0.3): then a rule that often errs is found out, and a kind of junk that only one rule
#: sees may pass.
WRONG, TRUST = 0.005, 3.0

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_ended_lines",
    "n_lettered_words",
    "n_capital_words",
    "n_distinct_words",
)

_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_ENDS = (b".", b"!", b"?", b'"', b":", b";", b")", "…".encode(), "”".encode(), "»".encode(), "。".encode())


def repeated_words(words: Sequence[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words which the list holds twice or more."""
    windows = list(zip(*[words[k:] for k in range(size)]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total = last = 0  # words before ``last`` are counted
    for k, window in enumerate(windows):
        if counts[window] > 1:
            total += k + size - max(k, last)
            last = k + size
    return total


def measures(text: str | None) -> tuple[int, ...]:
    """The measures of one whole text, in the order of ``MEASURES``."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # at the six ASCII separators
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "surrogatepass")),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(line.rstrip().endswith(_ENDS) for line in lines),
        sum(_LETTER.search(w) is not None for w in words),
        sum(len(w) > 1 and w.isupper() for w in words),
        len(set(words)),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, measures)."""
    for batch in batches:
        found = [measures(text) for text in batch.column(1).to_pylist()]
        columns = zip(*found) if found else [[]] * len(MEASURES)
        arrays = [pa.array(list(c), pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *MEASURES])


@dataclass(frozen=True)
class Rule:
    """Votes good or bad where its condition holds, bad first; else, or on NULL, it abstains."""

    name: str
    good: Column
    bad: Column

    def vote(self) -> Column:
        """0 for abstaining, 1 for good, 2 for bad."""
        return F.when(self.bad, 2).when(self.good, 1).otherwise(0)


def standard_rules() -> list[Rule]:
    """Rules about length, words, symbols, lines and repetition."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole))

    length = share("word_chars", "n_words")
    symbols = share("n_symbols", "n_words")
    copied = share("n_dup_lines", "n_lines")
    repeated = share("n_repeat_words", "n_words")
    lettered = share("n_lettered_words", "n_words")
    capitals = share("n_capital_words", "n_lettered_words")
    ended = share("n_ended_lines", "n_lines")
    distinct = share("n_distinct_words", "n_words")
    words, lines = F.col("n_words"), F.col("n_lines")
    return [
        Rule("length", words >= 100, F.lit(False)),  # too few words fail outright
        Rule("word_length", length.between(3, 10), (length < 2) | (length > 15)),
        Rule("symbols", symbols <= 0.02, symbols > 0.1),
        Rule("copied_lines", (copied == 0) & (lines >= 2), copied > 0.5),
        Rule("repeated_words", repeated <= 0.1, repeated > 0.3),
        Rule("lettered_words", lettered >= 0.9, lettered < 0.8),
        Rule("capitals", capitals <= 0.1, capitals > 0.3),
        Rule("ended_lines", ended >= 0.6, (ended < 0.1) & (lines >= 3)),
        Rule("distinct_words", distinct >= 0.3, (distinct < 0.1) & (words <= 2000)),
    ]


@dataclass
class Raters:
    """What the votes say about the rules: the share of good documents, and per class (good, bad)
    and rule the share of good and of bad votes among those cast, at 1 and 2 of the last axis."""

    good: float
    rates: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of being good for rows of votes; a rule that abstains says nothing."""
        log = np.zeros(self.rates.shape)
        log[:, :, 1:] = np.log(self.rates[:, :, 1:])
        own = np.arange(votes.shape[1])
        sums = [np.log(p) + log[k, own, votes].sum(axis=1) for k, p in ((0, self.good), (1, 1 - self.good))]
        return 1 / (1 + np.exp(np.clip(sums[1] - sums[0], -700, 700)))


def estimate(
    votes: np.ndarray, counts: np.ndarray, wrong: float = WRONG, trust: float = TRUST
) -> Raters:
    """Expectation-maximisation from the start that documents with a bad vote are likely bad.

    ``votes`` are distinct patterns (0 abstain, 1 good, 2 bad), ``counts`` the documents of each.
    Bad documents are of many kinds, and each kind is caught by a rule or two only. Left alone,
    the two classes would therefore settle on the largest kind against all else. What sets them
    right is the belief, ``trust`` times as strong as the table, that a rule errs on the share
    ``wrong`` of the good documents.
    """
    good = np.where((votes == 2).any(axis=1), 0.25, 0.95)
    chosen = np.eye(3)[votes] * [0, 1, 1]  # pattern, rule, vote
    before = None
    for _ in range(ROUNDS):
        weights = np.stack([counts * good, counts * (1 - good)])
        tallies = np.einsum("kn,nrv->krv", weights, chosen) + [0, PRIOR, PRIOR]
        tallies[0] += trust * counts.sum() * np.array([0, 1 - wrong, wrong])
        rates = tallies / tallies.sum(axis=2, keepdims=True)
        share = float((weights[0].sum() + PRIOR) / (counts.sum() + 2 * PRIOR))
        raters = Raters(share, rates)
        if before is not None and np.abs(rates - before).max() < SETTLED:
            break
        before, good = rates, raters.posterior(votes)
    return raters


def unpacked(patterns: Sequence[int], rules: int) -> np.ndarray:
    """The votes of pattern numbers, one digit to the base 3 per rule."""
    numbers = np.asarray(patterns, np.int64)
    return (numbers[:, None] // 3 ** np.arange(rules)) % 3


def judge(
    docs: DataFrame,
    rules: Callable[[], Sequence[Rule]] = standard_rules,
    key: str = "doc_id",
    text: str = "text",
    trust: float = TRUST,
) -> tuple[DataFrame, Raters | None]:
    """One row per document: its id, ``MEASURES``, ``votes`` (one digit per rule: 0 abstains,
    1 good, 2 bad), ``quality`` (posterior probability of being good), ``base_failed`` and
    ``kept``; and what was learnt about the rules, None for an empty table.

    ``base_failed`` documents (fewer than 50 words, or over half of them in repeated windows)
    are never kept, but vote like all others. Null and empty texts have no words, so they fail;
    their measures are 0. Equal texts come out alike, whatever their ids, which may be null or
    repeated. An empty table gives no rows. Other columns are not looked at.
    """
    bound_batches(docs.sparkSession)
    asked = list(rules())
    if len(asked) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`"))
    kinds = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    votes = [rule.vote() for rule in asked]
    pattern = sum((v * 3**k for k, v in enumerate(votes)), F.lit(0)).cast("int")
    measured = pin(rows.mapInArrow(_measured, kinds).withColumn("pattern", pattern), "measures")
    # At most 3 ** MOST_RULES rows.
    found = sorted((r[0], r[1]) for r in measured.groupBy("pattern").count().collect())
    raters, known = None, []
    if found:
        patterns = [p for p, _ in found]
        table = unpacked(patterns, len(asked))
        raters = estimate(table, np.array([c for _, c in found], float), trust=trust)
        digits = ["".join(map(str, row)) for row in table.tolist()]
        known = list(zip(patterns, digits, raters.posterior(table).tolist()))
    verdicts = docs.sparkSession.createDataFrame(known, "_pattern int, votes string, quality double")
    judged = measured.join(F.broadcast(verdicts), F.col("pattern") == F.col("_pattern"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        judged.select(
            F.col("doc_id").alias(key), *MEASURES, "votes", "quality",
            failed.alias("base_failed"), (~failed & (F.col("quality") >= KEPT)).alias("kept"),
        ),
        raters,
    )
