"""Quality rules with weak supervision; DataFrame functions only.

Each rule votes good or bad on a document, or abstains. Expectation
maximisation estimates how common good documents and the bad ones of each
rule are, and how each rule votes on them, from the votes alone, and a document is kept if it is good with a posterior
probability of a half or more, rather than if it passes every rule.

The votes of all documents are counted by pattern: three outcomes for each
rule, so at most 3 ** 6 rows whatever the corpus; the estimate runs on those.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_POSTERIOR = 0.5
ROUNDS = 25
# Where the estimate begins: share of good documents, and how often a rule
# that votes is right on good and on bad documents. The rules are extreme, so
# a bad vote on a good document is rare, but most rules miss a bad document.
START_GOOD, START_RIGHT_GOOD, START_RIGHT_BAD = 0.6, 0.999, 0.3
# So much of a rule's bad votes falls on bad documents with these, and never less is taken to.
START_PRECISION = 1 - START_GOOD * (1 - START_RIGHT_GOOD) / (
    START_GOOD * (1 - START_RIGHT_GOOD) + (1 - START_GOOD) * START_RIGHT_BAD)
# The estimate ends when no posterior of good moves by more.
SETTLED = 1e-6
# Of the SQL only, which knows one kind of bad documents: so many times the
# documents are added as at the start, or else the commonest kind of junk
# would become the only one. The operator has no such prior; both give the
# same verdicts on the tables here.
PRIOR = 20

# Votes in SQL, valid in Spark and other engines: name, good if, bad if. All
# are over whole numbers; a rule abstains where neither holds. One rule for
# each signal: two that read the same characters would count one fault twice.
RULES = (
    ("symbols", "100 * n_symbols <= n_words", "5 * n_symbols > n_words"),
    ("repetition", "10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    ("duplicate_lines", "20 * n_dup_lines <= n_word_lines", "2 * n_dup_lines > n_word_lines"),
    ("vocabulary", "4 * n_distinct >= n_words", "20 * n_distinct < n_words"),
    ("capitals", "5 * n_upper <= word_chars", "2 * n_upper > word_chars"),
    ("exclamations", "50 * n_exclaims <= n_words", "5 * n_exclaims > n_words"),
)

_SPACES = " \t\n\x0b\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_word_lines", "n_upper",
          "n_exclaims", "n_distinct")


def signals(df: DataFrame, text: str) -> DataFrame:
    """Add the counts that the rules read, as longs. Each step's arrays are columns, so they are made once.

    Windows are compared by 64-bit hash, within a text only.
    """
    words = F.filter(F.split(text, f"[{_SPACES}]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{_SPACES}]"))
    df = df.withColumn("_w", words).withColumn("_l", lines)
    windows = F.when(F.size("_w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))) \
        .otherwise(F.expr("cast(array() as array<bigint>)"))
    df = df.withColumn("_h", windows)
    # Only a text that holds a window twice has its windows sorted.
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get("_s", k)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    # A repeated window covers three words, less those that the next one covers.
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x)
    counts = {
        "n_words": F.size("_w"), "word_chars": F.char_length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)), "n_word_lines": F.size("_l"),
        "n_upper": F.regexp_count(text, F.lit("[A-Z]")), "n_exclaims": F.regexp_count(text, F.lit("!")),
        "n_distinct": F.size(F.array_distinct("_w"))}
    return df.withColumns({k: v.cast("long") for k, v in counts.items()}).drop("_w", "_l", "_h", "_s", "_p")


def votes() -> Column:
    """The pattern of votes as a number: a digit to base 3 for each rule (0 bad, 1 none, 2 good)."""
    return F.expr(" + ".join(
        f"{3 ** k} * CASE WHEN n_words = 0 THEN 1 WHEN {bad} THEN 0 WHEN {good} THEN 2 ELSE 1 END"
        for k, (_, good, bad) in enumerate(RULES))).cast("int")


def estimate(patterns: dict[int, int], rounds: int = ROUNDS) -> dict[int, float]:
    """Posterior probability of good for each vote pattern: ``fit``'s kind 0."""
    return {p: float(q) for p, q in zip(patterns, fit(patterns, rounds)[0][:, 0])}


def fit(patterns: dict[int, int], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expectation maximisation over kinds of documents: good ones, and for each rule the bad ones it catches.

    ``patterns``: documents by pattern. Result: the posterior of each pattern
    and kind (0: good, k + 1: bad by rule k), the shares of the kinds, and how
    often each rule votes bad on each kind. All are estimated from the
    documents; for shares, and rules on good documents and on their own kind,
    with one document more that is as at the start. Rounds go on, ``rounds`` at least, until no posterior of good moves.

    With a kind for each rule, a common kind of junk takes nothing from a rare
    one, so no prior has to hold them apart. Votes alone can't tell a kind with
    one bad vote from an error on good documents: a rule's bad votes are taken
    to be as precise as at the start, at least. A kind is known by its own rule's
    bad vote; other rules' abstentions are no evidence. No rule falls below
    chance: a bad vote is at least as likely on bad documents as on good ones,
    so it never speaks for good.
    """
    size = len(RULES)
    if not patterns:
        return np.zeros((0, size + 1)), np.zeros(size + 1), np.zeros((size + 1, size))
    digit = np.array([[p // 3 ** k % 3 for k in range(size)] for p in patterns])
    n = np.array(list(patterns.values()), dtype=float)
    own = np.vstack([np.zeros(size, dtype=bool), np.eye(size, dtype=bool)])
    # Kind, pattern, rule: whether the rule votes bad, and whether its vote counts.
    bad = np.broadcast_to(digit == 0, (size + 1, *digit.shape))
    voted = (digit != 1) | own[:, None, :]
    start_share = np.r_[START_GOOD, np.full(size, (1 - START_GOOD) / size)]
    start_rate = np.where(own, START_RIGHT_GOOD, START_RIGHT_BAD)
    start_rate[0] = 1 - START_RIGHT_GOOD
    known = own | (np.arange(size + 1) == 0)[:, None]
    share, rate, q = start_share, start_rate, np.full((len(n), size + 1), np.inf)
    done = 0
    while True:
        vote = np.where(bad, rate[:, None, :], 1 - rate[:, None, :])
        joint = (share[:, None] * np.where(voted, vote, 1.0).prod(axis=2)).T
        last, q = q, joint / joint.sum(axis=1, keepdims=True)
        done += 1
        if done > rounds and np.abs(q[:, 0] - last[:, 0]).max() < SETTLED:
            return q, share, rate
        weight = (n[:, None] * q).T
        share = (weight.sum(axis=1) + start_share) / (n.sum() + 1)
        votes_bad = (weight[:, :, None] * (bad & voted)).sum(axis=1)
        votes = (weight[:, :, None] * voted).sum(axis=1)
        rate = np.where(known, (votes_bad + start_rate) / (votes + 1),
                        np.where(votes > 0, votes_bad / np.where(votes > 0, votes, 1), start_rate))
        # Bad votes on good documents, by the least precision.
        wrong = (1 - START_PRECISION) * n @ (digit == 0) / np.maximum(votes[0], 1)
        rate[0] = np.minimum(rate[0], wrong)
        rate = np.maximum(rate, rate[0])


def judge(docs: DataFrame, carry: list[str], text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Counts, votes and verdict of every document.

    Result: struct ``row`` of the carried columns, the counts of ``COUNTS``
    (longs), ``votes``, ``p_good``, ``base_failed`` and ``kept``. Texts are
    read once: counts and carried columns are stored, the vote patterns
    counted from there.

    - null or empty text, or no words: no words; fails the base rule
    - equal texts and repeated rows: a row each, with equal verdicts
    - very long texts: whole; sorting apart, the work is linear
    - empty table: no rows
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.struct(*carry).alias("row"), text.alias("_text"))
    counted = signals(plain, "_text").drop("_text").withColumn("votes", votes())
    scored = stored(counted, "quality")
    found = {r.votes: r["count"] for r in scored.groupBy("votes").count().collect()}    # at most 3 ** 6 rows
    rows = ", ".join(f"({p}, {q!r}D)" for p, q in estimate(found, rounds).items()) or "(-1, 0D)"
    verdicts = docs.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(votes, p_good)")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (scored.join(F.broadcast(verdicts), "votes").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= MIN_POSTERIOR)))


def clean(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept; all columns as they were."""
    return judge(docs, docs.columns, text_col).where("kept").select("row.*")
