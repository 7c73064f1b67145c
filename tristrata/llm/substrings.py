"""Removal of word passages that an earlier document has, with repeated-phrase automata.

Every window of ``WINDOW`` words has an anchor: of its phrases of ``PHRASE`` words the one with
the least hash, the first on ties. Equal windows have equal anchors, and neighbouring windows
mostly share theirs, so anchors are a fifth of the windows. The texts are dealt into buckets once,
and each step reads a bucket and what other buckets sent it:

1. propose: buckets name their distinct anchors; anchors that two documents have come back;
2. confirm: windows with such an anchor are named with the first document that has them;
3. send: the first document's bucket sends its confirmed windows, joined to passages of text,
   to the buckets that have them too;
4. locate: a bucket compiles the passages' anchor phrases into its shard of the automaton,
   streams its documents through it, and extends each hit to whole windows, word by word.

A bucket names an anchor or a window once, however many of its documents have it: one that
is in all documents makes as many rows as there are buckets, and no task gets more. What
is removed is decided on words, not on hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import inner_runs, slices, texts_of, word_runs, words_of
from tristrata.llm.shared import ship

WINDOW = 13
PHRASE = 4
_SPAN = WINDOW - PHRASE + 1
# The text that a bucket is to hold: what a Python worker has as one group.
BUCKET_BYTES = 10 << 20
_LAST_ID = (1 << 63) - 1
_PAIRS_AT_ONCE = 1 << 18


def _anchors(phrases: np.ndarray, windows: int) -> np.ndarray:
    """The anchor's place of each window that starts at word 0, 1, ...; places never go back."""
    least, place, reach = phrases, np.arange(len(phrases)), 1
    while reach < _SPAN:
        # The least of twice as many phrases, or of as many as are missing.
        step = min(reach, _SPAN - reach)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        place = np.where(later, place[step:], place[:-step])
        reach += step
    return place[:windows]


def _once(places: np.ndarray) -> np.ndarray:
    """Where a sequence that never goes back takes a new value."""
    return np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])) if len(places) else places


def _windows(part: pa.RecordBatch):
    """Of a slice of documents: words, their texts' ids, window starts, windows' anchor places
    and phrase hashes."""
    texts = texts_of(part.column("text"))
    words = words_of(texts)
    ids = part.column("doc_id").to_numpy()
    if len(words.hash) < WINDOW:
        none = np.empty(0, np.int64)
        return words, ids, none, none, np.empty(0, np.uint64)
    phrases = word_runs(words.hash, PHRASE)
    starts = np.flatnonzero(inner_runs(words.text, WINDOW))
    return words, ids, starts, _anchors(phrases, len(words.hash) - WINDOW + 1)[starts], phrases


def _parts(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from slices(batch)


def _reduced(
    hashes: np.ndarray, docs: np.ndarray, many: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, each with its least document and whether it has a second one; ``many``
    marks those that are known to have one."""
    order = np.lexsort((docs, hashes))
    hashes, docs = hashes[order], docs[order]
    if not len(hashes):
        return hashes, docs, np.empty(0, bool)
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    last = np.append(first[1:], len(hashes)) - 1
    second = docs[first] != docs[last]
    if many is not None:
        second |= np.logical_or.reduceat(many[order], first)
    return hashes[first], docs[first], second


def _gathered(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    return _reduced(*(np.concatenate(x) for x in zip(*found)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _flags(bucket: int, many: np.ndarray) -> pa.Array:
    """A bucket's number and whether it has a second document, in one column."""
    return pa.array((bucket * 2 + many).astype(np.int32), pa.int32())


def _propose(key: tuple, table: pa.Table) -> pa.Table:
    found = []
    for part in _parts(table):
        words, ids, _, anchors, phrases = _windows(part)
        places = anchors[_once(anchors)]
        found.append(_reduced(phrases[places], ids[words.text[places]]))
    hashes, _, many = _gathered(found)
    return pa.table({"hash": _signed(hashes), "origin": _flags(key[0].as_py(), many)})


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that two documents have go back to every bucket that named them."""
    held = list(batches)
    if not held:
        return
    hashes = np.concatenate([b.column("hash").to_numpy() for b in held])
    origin = np.concatenate([b.column("origin").to_numpy() for b in held])
    _, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = (count > 1) | (np.bincount(place, origin & 1) > 0)
    back = twice[place]
    yield pa.RecordBatch.from_arrays(
        [pa.array(hashes[back]), pa.array(origin[back] >> 1)], names=["hash", "bucket"]
    )


def _among(found: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``wanted``, and which ones are really there."""
    place = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
    return place, wanted[place] == found


def _under_anchors(part: pa.RecordBatch, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and texts' ids of the windows with a wanted anchor."""
    words, ids, starts, anchors, phrases = _windows(part)
    first = _once(anchors)
    _, known = _among(phrases[anchors[first]], wanted)
    starts = starts[np.repeat(known, np.diff(np.append(first, len(anchors))))]
    runs = word_runs(words.hash, WINDOW) if len(starts) else np.empty(0, np.uint64)
    return runs[starts], ids[words.text[starts]]


def _name_windows(key: tuple, table: pa.Table, sent: pa.Table) -> pa.Table:
    anchors = np.unique(sent.column("hash").to_numpy().view(np.uint64))
    found = []
    for part in _parts(table) if len(anchors) else ():
        found.append(_reduced(*_under_anchors(part, anchors)))
    hashes, docs, many = _gathered(found)
    origin = _flags(key[0].as_py(), many) if len(key) and key[0].is_valid else pa.array([], pa.int32())
    return pa.table({"hash": _signed(hashes), "doc": pa.array(docs, pa.int64()), "origin": origin})


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bucket of a window's first document hears which buckets have the window too."""
    held = list(batches)
    if not held:
        return
    hashes = np.concatenate([b.column("hash").to_numpy() for b in held])
    docs = np.concatenate([b.column("doc").to_numpy() for b in held])
    origin = np.concatenate([b.column("origin").to_numpy() for b in held])
    order = np.lexsort((docs, hashes))
    hashes, docs, origin = hashes[order], docs[order], origin[order]
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    home = np.maximum.accumulate(np.where(first, np.arange(len(hashes)), 0))
    # The home bucket itself is told where it has the window twice.
    told = ~first | (origin & 1 == 1)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array((origin[home] >> 1)[told]),
            pa.array(hashes[told]),
            pa.array((origin >> 1)[told]),
        ],
        names=["bucket", "hash", "target"],
    )


def _passages(key: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
    """The asked windows' text, neighbouring windows for one target joined."""
    out: dict[str, list] = {"bucket": [], "doc_id": [], "passage": []}
    hashes = asked.column("hash").to_numpy().view(np.uint64)
    target = asked.column("target").to_numpy()
    order = np.lexsort((target, hashes))
    hashes, target = hashes[order], target[order]
    names, at = np.unique(hashes, return_index=True)
    stop = np.append(at[1:], len(hashes))
    # The least document that has each window here: the first one of all.
    owner = np.full(len(names), _LAST_ID)
    held = []
    for part in _parts(table) if len(names) else ():
        texts = texts_of(part.column("text"))
        words = words_of(texts)
        starts = np.flatnonzero(inner_runs(words.text, WINDOW))
        place, known = _among(word_runs(words.hash, WINDOW)[starts], names)
        place, starts = place[known], starts[known]
        docs = part.column("doc_id").to_numpy()[words.text[starts]]
        np.minimum.at(owner, place, docs)
        if len(place):
            # Only what is needed of the words: their hashes' tables take eight bytes a letter.
            kept = [x.astype(np.int32) for x in (words.start, words.end, words.text)]
            held.append((part, texts, kept, starts.astype(np.int32), place, docs))
    taken = np.zeros(len(names), bool)
    for part, texts, (word_start, word_end, word_text), starts, place, docs in held:
        fits = (docs == owner[place]) & ~taken[place]
        fresh, once = np.unique(place[fits], return_index=True)
        starts = starts[fits][once]
        taken[fresh] = True
        count = stop[fresh] - at[fresh]
        # One entry per window and target, by target and place.
        window = np.repeat(starts, count)
        goal = target[np.repeat(at[fresh], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        sort = np.lexsort((window, goal))
        window, goal = window[sort], goal[sort]
        text = word_text[window]
        if not len(window):
            continue
        cut = np.flatnonzero((goal[1:] != goal[:-1]) | (text[1:] != text[:-1]) | (window[1:] != window[:-1] + 1)) + 1
        data = texts.data
        numbers = part.column("doc_id").to_numpy()
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(window)]):
            piece = data[word_start[window[a]] : word_end[window[b - 1] + WINDOW - 1]].tobytes()
            out["bucket"].append(goal[a])
            out["doc_id"].append(numbers[text[a]])
            out["passage"].append(b" ".join(piece.split()))
    return pa.table(
        {
            "bucket": pa.array(np.array(out["bucket"], np.int32)),
            "doc_id": pa.array(np.array(out["doc_id"], np.int64)),
            "passage": pa.array(out["passage"], pa.binary()),
        }
    )


class PhraseAutomaton:
    """Anchor phrases of passages in an Aho-Corasick automaton.

    Words that passages have are written as three letters from three alphabets, so that a
    phrase matches at word borders only.
    """

    def __init__(self, passages: list[bytes], docs: np.ndarray):
        split = [p.split() for p in passages]
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws), 1)}
        base = max(int(np.ceil(len(self.number) ** (1 / 3))) + 1, 2)
        letter = lambda n, k: chr(0x100 + k * base + n)
        self.written = [""] + [
            letter(n // base**2, 0) + letter(n // base % base, 1) + letter(n % base, 2)
            for n in self.number.values()
        ]
        # Passages one after another, with room between them that equals no word.
        lengths = np.array([len(ws) for ws in split], np.int64)
        flat = np.array([self.number[w] for ws in split for w in ws], np.int64)
        passage = np.repeat(np.arange(len(split)), lengths)
        at = np.arange(len(flat)) + _SPAN * (passage + 1)
        self.words = np.full(len(flat) + _SPAN * (len(split) + 1) + WINDOW, -2, np.int64)
        self.words[at] = flat
        self.owner = np.full(len(self.words), _LAST_ID)
        self.owner[at] = docs[passage]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.bounds, self.places = np.zeros(1, np.int64), np.empty(0, np.int64)
        if not len(flat):
            return
        # The phrases of the passages' windows, found as everywhere else.
        hashes = words_of(texts_of(pa.array([p.decode() for p in passages]))).hash
        starts = np.flatnonzero(inner_runs(passage, WINDOW))
        anchors = np.unique(_anchors(word_runs(hashes, PHRASE), len(flat) - WINDOW + 1)[starts])
        phrases = flat[anchors[:, None] + np.arange(PHRASE)]
        distinct, group = np.unique(phrases, axis=0, return_inverse=True)
        for i, numbers in enumerate(distinct.tolist()):
            self.automaton.add_word("".join([self.written[n] for n in numbers]), i)
        self.automaton.make_automaton()
        order = np.argsort(group, kind="stable")
        self.bounds = np.searchsorted(group[order], np.arange(len(distinct) + 1))
        self.places = at[anchors[order]]

    def covered(self, words: list[bytes], doc: int) -> np.ndarray:
        """Which words of a document lie in a window that a passage of an earlier document has."""
        mask = np.zeros(len(words) + 1, np.int64)
        if len(words) < WINDOW or not len(self.places):
            return mask[:-1] > 0
        own = np.full(len(words) + 2 * _SPAN + WINDOW, -1, np.int64)
        numbers = own[_SPAN : _SPAN + len(words)]
        numbers[:] = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        # A window has words of passages only: what parts shorter runs of them needs no search.
        known = np.concatenate([[False], numbers > 0, [False]])
        turns = np.flatnonzero(known[1:] != known[:-1])
        hits = []
        for start, stop in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if stop - start >= WINDOW:
                text = "".join(map(self.written.__getitem__, numbers[start:stop].tolist()))
                hits += [(start + (end + 1) // 3 - PHRASE, i) for end, i in self.automaton.iter(text)]
        if not hits:
            return mask[:-1] > 0
        place, pattern = np.array(hits).T
        count = self.bounds[pattern + 1] - self.bounds[pattern]
        total = np.concatenate([[0], np.cumsum(count)])
        # Pairs of a hit and a place of its phrase, so many at a time.
        row = 0
        while row < len(hits):
            to = max(int(np.searchsorted(total, total[row] + _PAIRS_AT_ONCE, "right")) - 1, row + 1)
            n = count[row:to]
            mine = np.repeat(place[row:to], n)
            theirs = self.places[
                np.repeat(self.bounds[pattern[row:to]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ]
            earlier = self.owner[theirs] < doc
            mine, theirs = mine[earlier], theirs[earlier]
            for a in range(0, len(mine), _PAIRS_AT_ONCE):
                m, t = mine[a : a + _PAIRS_AT_ONCE], theirs[a : a + _PAIRS_AT_ONCE]
                reach = np.arange(1 - _SPAN, WINDOW)
                same = own[m[:, None] + _SPAN + reach] == self.words[t[:, None] + reach]
                sums = np.concatenate([np.zeros((len(m), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
                whole = sums[:, WINDOW:] - sums[:, :-WINDOW] == WINDOW
                hit, shift = np.nonzero(whole)
                start = np.unique(m[hit] + shift + 1 - _SPAN)
                np.add.at(mask, start, 1)
                np.add.at(mask, start + WINDOW, -1)
            row = to
        return np.cumsum(mask[:-1]) > 0


def _locate(keep_text: bool):
    def run(key: tuple, table: pa.Table, sent: pa.Table) -> pa.Table:
        automaton = PhraseAutomaton(sent.column("passage").to_pylist(), sent.column("doc_id").to_numpy())
        removed, total, digest, kept_texts = [], [], [], []
        ids = table.column("doc_id").to_numpy()
        for doc, text in zip(ids.tolist(), table.column("text")):
            words = (text.as_py() or "").encode().split()
            gone = automaton.covered(words, doc)
            count = int(gone.sum())
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if count else words)
            total.append(len(words))
            removed.append(count)
            digest.append(hashlib.sha256(kept).hexdigest())
            if keep_text:
                kept_texts.append(kept.decode())
        columns = {
            "doc_id": pa.array(ids, pa.int64(), mask=table.column("nameless").to_numpy()),
            "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digest, pa.string()),
        }
        if keep_text:
            columns["kept_text"] = pa.array(kept_texts, pa.string())
        return pa.table(columns)

    return run


def _buckets(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(-(-size // BUCKET_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def without_repeats(docs: DataFrame, buckets: int | None = None, keep_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``, with ``keep_text`` also ``kept_text``.

    A word goes when a window of 13 words that covers it also starts in a document with a
    smaller doc_id. Null and empty texts have no words, and texts of fewer words than a window
    keep all. Rows of equal doc_id do not count as earlier than each other; a null doc_id is
    as late as the largest that there can be. An empty table gives no rows. Other columns play no part. ``buckets`` should give about 10 MB of text to
    each; by default they are counted from the texts' bytes, at least as many as shuffle partitions.
    """
    ship(docs.sparkSession)
    n = buckets or _buckets(docs)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("doc_id"),
        F.col("doc_id").cast("bigint").isNull().alias("nameless"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Dealt by row, not by doc_id, which may repeat.
    dealt = rows.select("doc_id", "nameless", "text", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("bucket"))
    home = dealt.groupBy("bucket")

    anchors = home.applyInArrow(_propose, "hash bigint, origin int")
    known = anchors.repartition(n, "hash").mapInArrow(_recurring, "hash bigint, bucket int")
    windows = home.cogroup(known.groupBy("bucket")).applyInArrow(_name_windows, "hash bigint, doc bigint, origin int")
    asked = windows.repartition(n, "hash").mapInArrow(_confirm, "bucket int, hash bigint, target int")
    passages = home.cogroup(asked.groupBy("bucket")).applyInArrow(_passages, "bucket int, doc_id bigint, passage binary")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if keep_text:
        schema += ", kept_text string"
    return home.cogroup(passages.groupBy("bucket")).applyInArrow(_locate(keep_text), schema)
