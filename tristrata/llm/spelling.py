"""Grouping spelling variants of words.

The words of a corpus are counted, and each is compared with all words that could be one edit
away. One inserted, deleted or replaced character moves a word's vector of letter counts by a
squared distance of at most two and its length by at most one. So words are put into blocks by length
and by how many of its characters fall into each of a few classes of letters, blocks that one edit can lead to
are multiplied as matrices of letter counts (a Gram matrix gives all squared distances at once),
pairs at a distance of at most two are kept, and those are compared character by character.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import LOWER
from tristrata.llm.shared import ship, staged

# Letters, shortest word, fewest occurrences, one run in so many loses a
# character, and how many times as frequent a form is.
FIRST_ACCENTED, LAST_ACCENTED = 0xC0, 0xFF
LEAST_LENGTH, LEAST_COUNT, SPARED, TIMES = 6, 5, 199, 5
# Blocks: classes of letters, and how many words or bytes of a block meet in one product.
CLASSES = 6
BLOCK_WORDS, BLOCK_BYTES = 2048, 1 << 21
OWN, SAME, OTHER = 0, 1, 2
# Words that a task counts before it hands them on; runs of a text that are counted at a time.
OPEN_WORDS, RUNS_AT_ONCE = 200_000, 1 << 18

_LETTERS = [*range(0x61, 0x7B), *range(FIRST_ACCENTED, LAST_ACCENTED + 1)]
_TO_LOWER = LOWER.tobytes()


def _kept(doc_id: int | None, spared: int) -> Callable[[str], str]:
    """A function from a lower-cased run to what is kept of it in the document."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def keep(run: str) -> str:
        drawn = zlib.crc32(run.encode(), start)
        if drawn % spared:
            return run
        at = drawn % len(run)
        return run[:at] + run[at + 1 :]

    return keep


def occurrences(
    docs: DataFrame, least_length: int = LEAST_LENGTH, spared: int = SPARED
) -> DataFrame:
    """``word, n`` of all words of at least ``least_length`` characters in all texts.

    A run of letters is found from its first to its last one, so shorter ones need not be listed. Counts are
    summed per document, then per task, then in Spark.
    """
    ship(docs.sparkSession)
    runs = re.compile(f"[a-z{chr(FIRST_ACCENTED)}-{chr(LAST_ACCENTED)}]{{{least_length},}}")

    def pieces(text: bytes) -> Iterator[Counter]:
        found = (m.group() for m in runs.finditer(text.translate(_TO_LOWER).decode("utf-8", "replace")))
        while part := list(islice(found, RUNS_AT_ONCE)):
            yield Counter(part)

    def handed(counts: dict[str, int]) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc_id, text in zip(batch.column("doc_id"), texts):
                keep = _kept(doc_id.as_py(), spared)
                for part in pieces(text.as_py()):
                    for letters, times in part.items():
                        word = keep(letters)
                        if len(word) >= least_length:
                            counts[word] = counts.get(word, 0) + times
                    if len(counts) >= OPEN_WORDS:
                        yield handed(counts)
                        counts = {}
        yield handed(counts)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).where("text is not null")
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def letter_classes(classes: int = CLASSES) -> list[str]:
    """All letters, dealt in turn."""
    return ["".join(map(chr, _LETTERS[i::classes])) for i in range(classes)]


def moves(classes: int = CLASSES) -> list[list[int]]:
    """How one edit can change the numbers of characters per class, of two opposite ways one, and
    first none: an inserted character, or one that takes the place of one of another class."""
    out = [[0] * classes]
    for i in range(classes):
        out.append([int(i == j) for j in range(classes)])
    for a, b in combinations(range(classes), 2):
        out.append([int(a == j) - int(b == j) for j in range(classes)])
    return out


def _in_blocks(words: DataFrame, classes: int) -> DataFrame:
    sizes = [F.length("word") - F.length(F.translate("word", c, "")) for c in letter_classes(classes)]
    return words.select("word", "n", F.array(*sizes).alias("block"))


def _routes(placed: DataFrame, classes: int, block_words: int, block_bytes: int) -> DataFrame:
    """Where the words of each block are compared: ``block, routes``, a route being ``home, role,
    parts, partners``.

    The words of block ``home`` (its own) meet those of all blocks that one edit leads to from there, the
    block itself included; both sides are dealt into parts of bounded size. Only numbers of words
    per block meet here.
    """
    blocks = placed.groupBy("block").agg(F.count(F.lit(1)).alias("own"))
    back = F.array(
        *[
            F.struct(
                F.array(*[F.col("block")[i] - step for i, step in enumerate(move)]).alias("home"),
                F.lit(SAME if k == 0 else OTHER).alias("role"),
            )
            for k, move in enumerate(moves(classes))
        ]
    )
    led = blocks.select("block", "own", F.inline(back))
    met = led.groupBy("home").agg(F.sum("own").alias("met")).where("met > 1")
    # What a part may hold falls with the words' length.
    length = F.aggregate("home", F.lit(0), lambda a, b: a + b)
    room = F.greatest(F.least(F.lit(block_words), F.floor(block_bytes / length)), F.lit(1))
    homes = blocks.select(F.col("block").alias("home"), "own").join(met, "home").select(
        "home",
        F.ceil(F.col("own") / room).cast("int").alias("parts"),
        F.ceil(F.col("met") / room).cast("int").alias("partners"),
    )
    route = F.struct("home", "role", "parts", "partners")
    own = homes.select(F.col("home").alias("block"), "home", F.lit(OWN).alias("role"), "parts", "partners")
    every = own.unionByName(led.join(homes, "home").select(*own.columns))
    return every.groupBy("block").agg(F.collect_list(route).alias("routes"))


def _units(words: DataFrame, classes: int, block_words: int, block_bytes: int) -> DataFrame:
    """Each word in every unit of work that it belongs to: ``home, i, j, role, word, n``. Unit i, j
    compares part i of the block ``home`` with part j of what one edit leads to from it."""
    placed = _in_blocks(words, classes)
    sent = placed.join(_routes(placed, classes, block_words, block_bytes), "block").select(
        "word", "n", F.inline("routes")
    )
    mine = F.col("role") == OWN
    part = F.pmod(F.xxhash64("word"), F.when(mine, F.col("parts")).otherwise(F.col("partners"))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.when(mine, F.col("partners")).otherwise(F.col("parts")) - 1))
    met = sent.select("home", "role", "word", "n", part.alias("part"), every.alias("with"))
    return met.select(
        F.concat_ws(",", "home").alias("home"),
        F.when(mine, F.col("part")).otherwise(F.col("with")).alias("i"),
        F.when(mine, F.col("with")).otherwise(F.col("part")).alias("j"),
        "role",
        "word",
        "n",
    )


def _letters(words: list[bytes], width: int) -> np.ndarray:
    """The characters as one row of bytes a word, zeros behind its last one."""
    return np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)


def _counts(letters: np.ndarray, present: np.ndarray, kind: type) -> np.ndarray:
    return np.stack([(letters == c).sum(axis=1) for c in present], axis=1).astype(kind)


def _one_edit(short: np.ndarray, long: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether words (a row each, of equal length) are one edit away from their partners: with one
    character replaced or, where the partner is ``longer`` by one, inserted."""
    length = short.shape[1]
    head = short == long[:, :length]
    replaced = head.sum(axis=1) == length - 1
    tail = (short == long[:, 1 : length + 1])[:, ::-1]
    alike = [np.where(x.all(axis=1), length, x.argmin(axis=1)) for x in (head, tail)]
    return np.where(longer, alike[0] + alike[1] >= length, replaced)


def near_pairs(own: list[bytes], other: list[bytes], at_once: int = BLOCK_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (number in ``own``, number in ``other``) of words one edit apart. The words, a byte a
    character, are of one length in ``own``, and of that or the next one in ``other``."""
    length = len(own[0])
    a, b = _letters(own, length), _letters(other, length + 1)
    longer = b[:, length] > 0
    present = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    present = present[present > 0]
    # Whole numbers up to the square of the length must be exact.
    kind = np.float32 if length < 2000 else np.float64
    ca, cb = _counts(a, present, kind), _counts(b, present, kind)
    one = np.ones(1, kind)
    # Two more columns turn the products into squared distances.
    left = np.column_stack([-2 * ca, (ca * ca).sum(axis=1), np.broadcast_to(one, len(a))])
    right = np.column_stack([cb, np.broadcast_to(one, len(b)), (cb * cb).sum(axis=1)])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(b), at_once):
        gram = left @ right[start : start + at_once].T
        mine, theirs = np.nonzero(gram <= 2)
        theirs += start
        step = max((1 << 24) // length, 1)
        for k in range(0, len(mine), step):
            i, j = mine[k : k + step], theirs[k : k + step]
            hit = _one_edit(a[i], b[j], longer[j])
            found.append((i[hit], j[hit]))
    none = np.empty(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in (zip(*found) if found else ((), ())))


def _best(words: list[bytes], n: np.ndarray, mine: np.ndarray, theirs: np.ndarray, count: int):
    """Of ``count`` words each one's number of near words and the first of these by falling n, then
    by code points."""
    rank = np.empty(len(words), np.int64)
    order = np.lexsort((np.array(words), -n))
    rank[order] = np.arange(len(words))
    first = np.full(count, len(words))
    np.minimum.at(first, mine, rank[theirs])
    n_near = np.bincount(mine, minlength=count)
    with_any = np.flatnonzero(n_near)
    return with_any, n_near[with_any], order[first[with_any]]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n_near, best_n, best`` of the words of each unit that have a near word there."""
    out: list[tuple] = []

    def handed() -> pa.RecordBatch:
        words, counts, n, best = (list(x) for x in zip(*out)) if out else ([], [], [], [])
        out.clear()
        text = [[w.decode("latin-1") for w in column] for column in (words, best)]
        columns = [pa.array(text[0], pa.string()), pa.array(counts, pa.int64()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(text[1], pa.string())], names=["word", "n_near", "best_n", "best"]
        )

    def compare(parts: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(parts)
        role, n = table.column("role").to_numpy(), table.column("n").to_numpy()
        words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
        own, other = np.flatnonzero(role == OWN), np.flatnonzero(role != OWN)
        if not len(own) or not len(other):
            return
        sides = [[words[k] for k in side] for side in (own, other)]
        i, j = near_pairs(*sides)
        # Words of the own block are on both sides, so each of them is seen to here.
        away = role[other][j] == OTHER
        for mine, theirs, x, y in ((0, 1, i, j), (1, 0, j[away], i[away])):
            near, n_near, best = _best(sides[theirs], n[(own, other)[theirs]], x, y, len(sides[mine]))
            best_n = n[(own, other)[theirs]][best]
            out.extend(
                (sides[mine][w], c, m, sides[theirs][k])
                for w, c, m, k in zip(near.tolist(), n_near.tolist(), best_n.tolist(), best.tolist())
            )

    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c) for c in ("home", "i", "j")]
        moved = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            moved |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            found = tuple(c[a].as_py() for c in columns)
            if found != key:
                if held:
                    compare(held)
                    if len(out) >= 1 << 15:
                        yield handed()
                key, held = found, []
            held.append(batch.slice(a, b - a))
    if held:
        compare(held)
    yield handed()


def near_words(
    words: DataFrame, classes: int = CLASSES, block_words: int = BLOCK_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Of the words of ``word, n`` that have near ones: ``word, n_near, best`` (its ``n, word``), the
    most frequent near word, of equal ones the first by code points.

    Words are letters up to U+00FF, each once. A word crosses the network once per block that
    it is compared with, whose number is fixed; pairs never leave their task, only each word's count and best.
    """
    units = _units(words, classes, block_words, block_bytes)
    keys = ["home", "i", "j"]
    # The work is computation, so it goes to all tasks, however few bytes it has.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(tasks, *keys).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(_compared, "word string, n_near bigint, best_n bigint, best string")
    first = F.min(F.struct(F.negate("best_n").alias("back"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", F.struct(F.negate("first.back").alias("n"), "first.word").alias("best")
    )


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words of ``word, form`` that have a form, staged: where forms lead to in the
    end. Each round doubles how far a word sees, so a chain of any length takes few rounds."""
    links = staged(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = staged(links.join(ahead, "root", "left"))
        if seen.where("next is not null").isEmpty():
            return links
        links = seen.select("word", F.coalesce("next", "root").alias("root"))


def grouped(words: DataFrame, times: int = TIMES, **blocks: int) -> DataFrame:
    """One row per word of ``word, n``: ``word, form, root, n, n_near, form_n``, the form being the most
    frequent near word where that is ``times`` as frequent. A form is more frequent than
    its word, so forms never lead back."""
    words = staged(words)
    near = near_words(words, **blocks)
    best = F.when(F.col("best.n") >= times * F.col("n"), F.col("best"))
    forms = staged(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            best["word"].alias("form"),
            best["n"].alias("form_n"),
        )
    )
    ends = rooted(forms)
    return forms.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    spared: int = SPARED,
    times: int = TIMES,
    **blocks: int,
) -> DataFrame:
    """The words of all texts with their forms and roots; see ``grouped``.

    Null and empty texts have no words; a null doc_id draws as an empty text would. Rows that
    are repeated count as often as they are there. Ties between near words go to the first by code points. An
    empty table, or one without a frequent long word, gives no rows. Texts and runs of any length
    are read whole, a long text's runs some at a time. Other columns of ``docs`` play no part.
    """
    words = occurrences(docs, least_length, spared).where(F.col("n") >= least_count)
    return grouped(words, times, **blocks)
