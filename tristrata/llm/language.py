"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of
what followed them. A byte that followed a context d distinct bytes n times in all has
the probability count / (n + d); another one costs an escape, d / (n + d), and
is looked up in the context that is one byte shorter, down to equal shares of 256 bytes. The
statistics are frozen after training, so the code length of a text under a language is
exact and a sum over positions. Each language has sorted arrays of its own: the contexts and
successors that its training texts have, all of them, whatever the other languages have. Where
the trees together are too large for one model they are dealt into parts, and a tree that is too large
by itself into shards by its longest contexts: a text's code length is the sum of what the shards say.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import Texts, slices, texts_of
from tristrata.llm.shared import numbered, ship, staged

FOLDS, HELD_OUT = 4, 2
ORDER = 3
UNKNOWN = "und"
# A part of the model takes further languages up to so many distinct (language, context, byte) counts.
PART_COUNTS = 4_000_000
# A language with more of them is dealt into shards of about so many. A shard also has the counts of all
# shorter contexts; there are at most 2 ** 24 of these.
SHARD_COUNTS = 8_000_000
_FLUSH = 1 << 20
_ASCII_LETTERS = np.zeros(256, bool)
_ASCII_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def shifted(data: np.ndarray, bounds: np.ndarray, by: int) -> np.ndarray:
    """Each byte's ``by``-th predecessor in its text, zero before the start."""
    out = np.zeros_like(data)
    out[by:] = data[: len(data) - by] if by < len(data) else 0
    for k in range(by):
        at = bounds[:-1] + k
        out[at[at < bounds[1:]]] = 0
    return out


def _packed(texts: Texts) -> np.ndarray:
    """The three bytes before a byte and the byte itself."""
    out = texts.data.astype(np.uint32)
    for k in range(1, ORDER + 1):
        out |= shifted(texts.data, texts.bounds, k).astype(np.uint32) << np.uint32(8 * k)
    return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list, list]] = {}

    def flush():
        for lang, (keys, counts) in held.items():
            found, n = _merged(keys, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n, pa.int64())],
                names=["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for part in slices(batch):
            texts = texts_of(part.column("text"))
            grams = _packed(texts)
            langs = part.column("lang").dictionary_encode()
            numbers = np.repeat(langs.indices.to_numpy(), np.diff(texts.bounds))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                found, n = np.unique(grams[numbers == i], return_counts=True)
                keys, counts = held.setdefault(lang, ([], []))
                keys.append(found)
                counts.append(n)
                if sum(map(len, keys)) > _FLUSH:
                    merged = _merged(keys, counts)
                    held[lang] = ([merged[0]], [merged[1]])
            if sum(len(k) for keys, _ in held.values() for k in keys) > 4 * _FLUSH:
                yield from flush()
    yield from flush()


@dataclass
class Tree:
    """One language. ``grams[k]`` are the sorted contexts of k bytes, each with a byte that followed,
    and ``logs[k]`` their log probabilities; ``contexts[k]`` are the sorted contexts alone and
    ``escapes[k]`` what another byte costs there. A shard answers for the longest contexts from
    ``start`` up to ``stop`` only."""

    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]
    start: int = 0
    stop: int = 1 << 8 * ORDER

    def log_shares(self, grams: np.ndarray) -> np.ndarray:
        """Of each sorted gram the log probability of its last byte after the others; zero for
        those that another shard answers for."""
        found = np.zeros(len(grams))
        a, b = np.searchsorted(grams, np.array([self.start, self.stop], np.uint64) << np.uint64(8))
        found[a:b] = self._log_shares(grams[a:b])
        return found

    def _log_shares(self, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), -8.0)
        for k in range(ORDER + 1):
            if not len(self.grams[k]):
                continue  # a shard without contexts of its own
            here = grams & _ending(k)
            place, known = _places(here >> np.uint32(8), self.contexts[k])
            out[known] += self.escapes[k][place[known]]
            place, known = _places(here, self.grams[k])
            out[known] = self.logs[k][place[known]]
        return out


@dataclass
class Model:
    langs: list[str]
    trees: list[Tree]

    @property
    def is_shard(self) -> bool:
        return any(t.stop - t.start < 1 << 8 * ORDER for t in self.trees)

    def code_lengths(self, texts: Texts) -> np.ndarray:
        """Bits of each text under each language."""
        grams, place = np.unique(_packed(texts), return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
        out = np.empty((len(texts), len(self.langs)))
        for i, tree in enumerate(self.trees):
            out[:, i] = np.bincount(owner, -tree.log_shares(grams)[place], len(texts))
        return out


def _ending(order: int) -> np.uint32:
    """Masks a gram's last byte and the ``order`` bytes before it."""
    return np.uint32((1 << 8 * (order + 1)) - 1)


def _places(wanted: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``among``, which is not empty, and which ones are really there."""
    place = np.minimum(np.searchsorted(among, wanted), len(among) - 1)
    return place, among[place] == wanted


def _tree(gram: np.ndarray, n: np.ndarray) -> Tree:
    tree = Tree([], [], [], [])
    for order in range(ORDER + 1):
        _grow(tree, gram, n, order)
    return tree


def _grow(tree: Tree, gram: np.ndarray, n: np.ndarray, order: int) -> None:
    """Add the contexts of the next length."""
    here, count = _merged([gram & _ending(order)], [n])
    context, place = np.unique(here >> np.uint32(8), return_inverse=True)
    kinds = np.bincount(place, minlength=len(context))
    all_ = np.bincount(place, count, len(context)) + kinds
    tree.grams.append(here)
    tree.logs.append(np.log2(count / all_[place]).astype(np.float32))
    tree.contexts.append(context)
    tree.escapes.append(np.log2(kinds / all_).astype(np.float32))


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """Lay out the trees; ``lang`` numbers into ``langs``, ``gram`` has three bytes and the one that
    followed. Every language has a gram."""
    order = np.argsort(lang, kind="stable")
    gram, n = gram[order].astype(np.uint32), n[order]
    bounds = np.searchsorted(lang[order], np.arange(len(langs) + 1))
    return Model(langs, [_tree(gram[a:b], n[a:b]) for a, b in zip(bounds, bounds[1:])])


def fit(docs: DataFrame) -> list[Broadcast] | None:
    """Train on all documents outside the held-out fold that have a text and a language;
    without any there is no model. All counts of all languages are kept: parts of the model, some
    languages or a shard of one each, are built and broadcast one after another; their size is
    bounded by ``PART_COUNTS`` and ``SHARD_COUNTS``, whatever the size of the table."""
    ship(docs.sparkSession)
    rows = docs.where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    grams = rows.mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
    counts = staged(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    parts: list[list[str]] = []
    shards: list[Broadcast] = []
    room = 0
    for lang, size in sorted(map(tuple, counts.groupBy("lang").count().collect())):
        if size > SHARD_COUNTS:
            shards += _shards(counts, lang, size)
            continue
        if size > room:
            parts.append([])
            room = PART_COUNTS
        parts[-1].append(lang)
        room -= size
    return [_part(counts, langs) for langs in parts] + shards or None


def _part(counts: DataFrame, langs: list[str]) -> Broadcast:
    found = counts.where(F.col("lang").isin(langs)).toArrow().combine_chunks()
    names = found.column("lang").combine_chunks().dictionary_encode()
    number = np.array([langs.index(x) for x in names.dictionary.to_pylist()])
    model = build(
        langs, number[names.indices.to_numpy()], found.column("gram").to_numpy(), found.column("n").to_numpy()
    )
    return counts.sparkSession.sparkContext.broadcast(model)


def _grams(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = rows.select("gram", "n").toArrow()
    return found.column("gram").to_numpy().astype(np.uint32), found.column("n").to_numpy()


def _shards(counts: DataFrame, lang: str, size: int) -> Iterator[Broadcast]:
    """One language's tree in shards with about equal numbers of counts."""
    own = counts.where(F.col("lang") == lang)
    # At most 2 ** 24 rows: two bytes of context and the one that followed.
    short = F.col("gram").bitwiseAND(F.lit(int(_ending(ORDER - 1))))
    low = _grams(own.groupBy(short.alias("gram")).agg(F.sum("n").alias("n")))
    context, number = F.shiftright("gram", 8), -(-size // SHARD_COUNTS)
    cuts = own.agg(F.percentile_approx(context, [i / number for i in range(1, number)])).first()[0]
    bounds = sorted({0, *cuts, 1 << 8 * ORDER})
    for start, stop in zip(bounds, bounds[1:]):
        tree = Tree([], [], [], [], start, stop)
        for order in range(ORDER):
            _grow(tree, *low, order)
        _grow(tree, *_grams(own.where((context >= start) & (context < stop))), ORDER)
        yield counts.sparkSession.sparkContext.broadcast(Model([lang], [tree]))


def _has_letter(texts: Texts) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_ASCII_LETTERS[texts.data])])
    found = sums[texts.bounds[1:]] > sums[texts.bounds[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, texts.piece(i).decode()))
    return found


def _judged(part: Broadcast):
    """``best, lang, odds`` of each text under one part of the model: the least code length, its
    language, and the sum of the languages' probabilities, the best one's being one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = part.value
        for batch in batches:
            for piece in slices(batch):
                texts = texts_of(piece.column("text"))
                bits = model.code_lengths(texts)
                best = bits.argmin(axis=1)
                least = bits.min(axis=1, keepdims=True)
                odds = np.exp2(np.maximum(least - bits, -1000)).sum(axis=1)
                known = _has_letter(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("row_no"),
                        pa.array(known),
                        pa.array(least[:, 0]),
                        pa.array(np.array(model.langs, object)[best], pa.string()),
                        pa.array(odds),
                    ],
                    names=["doc_id", "row_no", "known", "best", "lang", "odds"],
                )

    return run


def identified(docs: DataFrame, model: list[Broadcast] | None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``score`` is the share of the predicted language when the languages' probabilities of the
    text are brought to a sum of one; ties go to the first language in code point order.
    A null text and one without a letter are ``und`` with score 0, and so is every
    text without a model; an empty table gives none and no rows. Texts of any length are read whole.
    Repeated rows get equal results; other columns play no part. A model of one part, as with most
    tables, is one pass; otherwise each part is a pass, and what they say of a row meets by its number.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if not model:
        judged = rows.select("doc_id", F.lit(False).alias("known"), F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("odds"))
    else:
        rows = numbered(rows, "row_no") if len(model) > 1 else rows.withColumn("row_no", F.lit(0).cast("bigint"))
        schema = "doc_id bigint, row_no bigint, known boolean, best double, lang string, odds double"
        passes = [rows.mapInArrow(_judged(part), schema) for part in model]
        judged = passes[0] if len(model) == 1 else _met(_summed(passes, [part.value for part in model]))
    return judged.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.when(F.col("known"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("known"), 1 / F.col("odds")).otherwise(0.0).alias("score"),
    )


def _summed(passes: list[DataFrame], parts: list[Model]) -> list[DataFrame]:
    """The passes, with those of shards brought together: a language's code length is their sum."""
    sharded = [p for p, m in zip(passes, parts) if m.is_shard]
    whole = [p for p, m in zip(passes, parts) if not m.is_shard]
    if not sharded:
        return whole
    every = reduce(DataFrame.unionByName, sharded).groupBy("row_no", "lang")
    first = [F.first(c).alias(c) for c in ("doc_id", "known")]
    return [*whole, every.agg(*first, F.sum("best").alias("best"), F.lit(1.0).alias("odds"))]


def _met(passes: list[DataFrame]) -> DataFrame:
    """What all parts together say of each row."""
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    said = F.sort_array(F.collect_list(F.struct("best", "lang", "odds"))).alias("said")
    rows = every.groupBy("row_no").agg(F.first("doc_id").alias("doc_id"), F.first("known").alias("known"), said)
    first = F.col("said")[0]
    odds = F.aggregate(
        "said",
        F.lit(0.0),
        lambda sum_, x: sum_ + x["odds"] * F.pow(F.lit(2.0), F.greatest(first["best"] - x["best"], F.lit(-1000.0))),
    )
    return rows.select("doc_id", "known", first["lang"].alias("lang"), odds.alias("odds"))
