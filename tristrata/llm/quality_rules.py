"""Quality rules combined by weak supervision.

Each rule looks at a document's measures and votes good or bad, or abstains. Nobody says which rules
are right: expectation-maximisation over the votes of all documents estimates how often each rule
is right about good and about bad documents, and the posterior probability of being good, instead of
passing every rule, decides. Documents meet as vote patterns, counted in Spark: at most
``3 ** rules`` of them, however many documents there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tristrata.llm.grams import slices
from tristrata.llm.shared import free_name, ship, staged

# Symbols, and limits of the hard rule that precedes the votes.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
WINDOW = 3
THRESHOLD = 0.5
# A word from its first letter on.
ALPHABETIC = re.compile(rb"[A-Za-z\x80-\xff][^\x20\t-\r]*")
# A word of letters (any byte beyond ASCII counts as one) with at most one mark behind it.
PLAIN = re.compile(rb"(?<![^\x20\t-\r])[A-Za-z\x80-\xff]+[.,;:!?]?(?![^\x20\t-\r])")

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_alphabetic",
    "n_ascii_letters",
    "n_capitals",
    "n_stops",
    "n_plain",
)
REPORTED = MEASURES[:5]

_UPPER = slice(0x41, 0x5B)
_LOWER = slice(0x61, 0x7B)


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """How many words stand in windows that are found more than once; words are compared as they are."""
    size = len(words) - window + 1
    if size < 2:
        return 0
    known: dict[bytes, int] = {}
    numbers = np.fromiter(map(known.setdefault, words, count()), np.int64, len(words))
    keys = numbers[:size]
    for j in range(1, window):
        if keys.max() >= (1 << 62) // len(words):
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(words) + numbers[j : j + size]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    found = np.zeros(size, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for j in range(window):
        covered[j : j + size] |= found
    return int(covered.sum())


def measures(text: bytes) -> tuple[int, ...]:
    """``MEASURES`` of one text in UTF-8. Words are parted by the bytes 0x20 and 0x09 to 0x0D, as
    ``bytes.split`` does."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    blanks = counts[0x20] + counts[0x09:0x0E].sum()
    inner = counts[0x80:0xC0].sum()  # bytes within a longer character
    lines = [line for line in text.split(b"\n") if line.strip()]
    ascii_letters = counts[_UPPER].sum() + counts[_LOWER].sum()
    return (
        len(words),
        int(len(text) - blanks - inner),
        int(counts[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(ALPHABETIC.findall(text)),
        int(ascii_letters),
        int(counts[_UPPER].sum()),
        int(counts[list(b".?!")].sum()),
        len(PLAIN.findall(text)),
    )


@dataclass(frozen=True)
class Rule:
    """Votes bad or good where its condition on the measures holds, and abstains where neither
    does or there is nothing to judge by."""

    name: str
    bad: str
    good: str


# Limits as in published heuristics for web text; between them a rule abstains.
RULES = (
    Rule("length", "n_words < 50 or n_words > 100000", "n_words between 100 and 50000"),
    Rule(
        "word_length",
        "word_chars < 3 * n_words or word_chars > 10 * n_words",
        "n_words > 0 and word_chars between 4 * n_words and 8 * n_words",
    ),
    Rule("symbols", "10 * n_symbols > n_words", "n_words > 0 and 100 * n_symbols <= n_words"),
    Rule("lines", "10 * n_dup_lines > 3 * n_lines", "n_lines > 1 and n_dup_lines = 0"),
    Rule("repeats", "5 * n_repeat_words > n_words", "n_words > 2 and 20 * n_repeat_words <= n_words"),
    Rule("letters", "10 * n_alphabetic < 8 * n_words", "n_words > 0 and 100 * n_alphabetic >= 95 * n_words"),
    Rule(
        "capitals",
        "10 * n_capitals > 3 * n_ascii_letters",
        "n_ascii_letters > 0 and 10 * n_capitals <= n_ascii_letters",
    ),
    Rule(
        "stops",
        "n_words > 100 * (n_stops + 1) or 2 * n_stops > n_words",
        "n_stops > 0 and n_words between 4 * n_stops and 40 * n_stops",
    ),
    Rule("plain", "5 * n_plain < 3 * n_words", "n_words > 0 and 4 * n_plain >= 3 * n_words"),
)
BAD, ABSTAIN, GOOD = "b", "-", "g"


@dataclass(frozen=True)
class Model:
    """The logarithm of the odds for good, and what a rule's vote adds to it."""

    base: float
    bad: tuple[float, ...]
    good: tuple[float, ...]

    def quality(self, votes: Column) -> Column:
        odds = F.lit(self.base)
        for i, (bad, good) in enumerate(zip(self.bad, self.good), 1):
            vote = F.substring(votes, i, 1)
            odds = odds + F.when(vote == BAD, bad).when(vote == GOOD, good).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-odds))


def vote(rules: Sequence[Rule] = RULES, names: dict[str, str] = {}) -> Column:
    """One letter per rule. ``names`` gives measures that the frame has under another name."""

    def condition(text: str) -> Column:
        return F.expr(re.sub(r"[a-z]\w+", lambda m: names.get(m[0], m[0]), text))

    return F.concat(
        *[F.when(condition(r.bad), BAD).when(condition(r.good), GOOD).otherwise(ABSTAIN) for r in rules]
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def fit_patterns(
    patterns: Sequence[str],
    documents: Sequence[int],
    bad_share: float = 0.2,
    caught: float = 0.3,
    cleared: float = 0.95,
    prior: float = 10.0,
    rounds: int = 500,
) -> Model:
    """Expectation-maximisation over vote patterns and the documents that have each.

    A rule has two accuracies, over the bad and over the good documents that it votes on; abstaining
    says nothing. There are many ways to be bad and a rule knows one of them, so rules start
    out as tests that seldom fault a good document (``cleared``) and miss most bad ones (``caught``); these are
    worth ``prior`` documents, so that rules mean something without any. One that does
    no better than chance (its accuracies add up to 1 or less) is worth nothing. Patterns are taken
    in order, so runs agree.
    """
    order = sorted(range(len(patterns)), key=patterns.__getitem__)
    width = len(patterns[0]) if patterns else len(RULES)
    votes = np.array([list(patterns[i]) for i in order], dtype="<U1").reshape(len(order), width)
    weight = np.array([documents[i] for i in order], float)
    is_bad, is_good = (votes == BAD).astype(float), (votes == GOOD).astype(float)
    on_bad, on_good, share = np.full(width, caught), np.full(width, cleared), bad_share
    for _ in range(rounds):
        bad, good = _evidence(on_bad, on_good)
        odds = np.log((1 - share) / share) + is_bad @ bad + is_good @ good
        p_good = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        as_good, as_bad = weight * p_good, weight * (1 - p_good)
        before = np.concatenate([on_bad, on_good, [share]])
        on_bad = (prior * caught + as_bad @ is_bad) / (prior + as_bad @ (is_bad + is_good))
        on_good = (prior * cleared + as_good @ is_good) / (prior + as_good @ (is_bad + is_good))
        share = (prior * bad_share + as_bad.sum()) / (prior + weight.sum())
        if np.abs(np.concatenate([on_bad, on_good, [share]]) - before).max() < 1e-10:
            break
    bad, good = _evidence(on_bad, on_good)
    return Model(float(np.log((1 - share) / share)), tuple(bad.tolist()), tuple(good.tolist()))


def _evidence(on_bad: np.ndarray, on_good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a bad and a good vote add to the logarithm of the odds for good."""
    useful = on_bad + on_good > 1
    bad = np.where(useful, np.log((1 - on_good) / on_bad), 0.0)
    good = np.where(useful, np.log(on_good / (1 - on_bad)), 0.0)
    return bad, good


def _with_measures(rows: DataFrame, position: int, names: Sequence[str]) -> DataFrame:
    """Columns ``names`` with the measures of the text at ``position`` behind the columns of ``rows``."""
    ship(rows.sparkSession)
    schema = StructType([*rows.schema.fields, *[StructField(n, LongType()) for n in names]])
    columns = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.rename_columns([str(i) for i in range(batch.num_columns)])
            for part in slices(batch, str(position)):
                texts = part.column(position).cast(pa.large_binary())
                found = [measures(t.as_py() or b"") for t in texts]
                more = [pa.array(c, pa.int64()) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=columns)

    return rows.mapInArrow(run, schema)


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures and ``votes`` of every document, staged."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = _with_measures(rows, 1, MEASURES).select("doc_id", *MEASURES, vote().alias("votes"))
    return staged(found)


def fit(found: DataFrame) -> Model:
    """The rules' accuracies from the votes of all documents."""
    rows = found.groupBy("votes").agg(F.count(F.lit(1)).alias("documents")).collect()
    return fit_patterns([r.votes for r in rows], [r.documents for r in rows])


def _good(model: Model, votes: Column, n_words: Column, n_repeat_words: Column) -> Column:
    return ~base_failed(n_words, n_repeat_words) & (model.quality(votes) >= THRESHOLD)


def judged(found: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, quality, votes``.

    ``quality`` is the posterior probability of being good. Null and empty texts have no words
    and fail the hard rule, as do all with fewer than 50 words. Repeated rows get equal results; a
    null doc_id stays null; a quality of exactly one half is kept. An empty table gives no rows.
    """
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    kept = _good(model, F.col("votes"), F.col("n_words"), F.col("n_repeat_words"))
    return found.select(
        "doc_id", *REPORTED, failed.alias("base_failed"), kept.alias("kept"),
        model.quality(F.col("votes")).alias("quality"), "votes",
    )


def rated(docs: DataFrame) -> DataFrame:
    """Measure, fit and judge all documents; see ``judged``. Texts of any length are measured whole and
    are read once; a long one is alone in its batch. Other columns of ``docs`` play no part."""
    found = measured(docs)
    return judged(found, fit(found))


def without_poor(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are kept, with all their columns, whatever those are called."""
    names = {m: free_name(docs, f"_{m}") for m in MEASURES}
    found = _with_measures(docs, docs.columns.index("text"), list(names.values()))
    votes = vote(names=names)
    good = _good(model, votes, F.col(names["n_words"]), F.col(names["n_repeat_words"]))
    return found.where(good).drop(*names.values())
