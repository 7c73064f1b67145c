"""Byte-pair encoding through a trie of words that share prefixes, and decoding.

The encoding of a prefix is the encoding of a shorter prefix and one more token, its
last token. A token can be the last one when it ends the prefix and its neighbour before
it, the last token of the shorter prefix, is one that it would not be merged with
or across. Exactly one token meets this, so a walk down a trie of words finds the last
token of each node once for all words that share it, and a word's encoding is read
from its end. The words are sorted, which makes the walk from one to the next a
depth-first traversal with the path as its only memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import slices
from tristrata.llm.shared import ship

# Fixed value: how byte-level BPE splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Words whose encodings a worker keeps; beyond that it starts a new trie.
KEPT_WORDS = 300_000
_NEVER = 1 << 60
# The more text at a time, the more prefixes its new words share.
_BYTES_AT_ONCE = 8 << 20


def _byte_letters() -> dict[str, int]:
    """The vocabulary file writes a byte as one letter: printable ones as themselves, the rest
    as the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Vocabulary, merges and special tokens of a tokenizer file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        as_bytes = {word: bytes(letters[c] for c in word) for word in vocab}
        self.ids = {as_bytes[word]: i for word, i in vocab.items()}
        self.tokens = {i: as_bytes[word] for word, i in vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_of: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            pair = vocab[a], vocab[b]
            self.rank[pair] = rank
            self.made_of[vocab[a + b]] = (*pair, rank)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: text.encode() for text, i in self.special.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.tokens}
        # All beginnings of tokens: what is none can't become a token by more bytes.
        self.begun = {word[:n] for word in self.ids for n in range(1, len(word) + 1)}
        self.split = regex.compile(PATTERN).findall
        cuts = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(cuts)})").split if cuts else lambda text: [text]
        self.words: dict[str, bytes] = {}
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        self.meeting: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at a token's edge while it is built up from bytes: each piece with the rank
        of the merge that takes it up."""
        out, until = [], _NEVER
        while True:
            out.append((token, until))
            if token not in self.made_of:
                return out[::-1]
            parts = self.made_of[token]
            token, until = parts[side], parts[2]

    def _meet(self, a: int, b: int) -> bool:
        """Whether a and b stay two tokens side by side. Merges happen by rank, equal ranks from
        the left, so a merge across the border happens when its rank comes before those that
        take up the two pieces at the border."""
        left = self.right_edge.get(a) or self.right_edge.setdefault(a, self._edge(a, 1))
        right = self.left_edge.get(b) or self.left_edge.setdefault(b, self._edge(b, 0))
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.rank.get((x, y), _NEVER)
            if across < x_until and across <= y_until and across < _NEVER:
                return False
            if x_until == y_until == _NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _encode_sorted(self, words: list[bytes]) -> Iterator[bytes]:
        """The packed ids of words in byte order."""
        token_of, begun, fits, packed = self.ids.get, self.begun, self.meeting.get, self.packed
        # For each prefix on the path: its last token, where that begins, and the first
        # place at which a token that reaches the prefix's end or beyond can begin.
        last, cut, low = [-1], [0], [0]
        before = b""
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], cut[shared + 1 :], low[shared + 1 :]
            first = low[shared]
            for end in range(shared + 1, len(word) + 1):
                while word[first:end] not in begun:
                    first += 1
                for start in range(first, end):
                    token = token_of(word[start:end])
                    if token is None:
                        continue
                    if not start:
                        break
                    pair = last[start] << 32 | token
                    meet = fits(pair)
                    if meet is None:
                        meet = self.meeting[pair] = self._meet(last[start], token)
                    if meet:
                        break
                last.append(token)
                cut.append(start)
                low.append(first)
            out, at = [], len(word)
            while at:
                out.append(packed[last[at]])
                at = cut[at]
            yield b"".join(out[::-1])
            before = word

    def _learn(self, words: set[str]) -> None:
        if len(self.words) + len(words) > KEPT_WORDS:
            self.words.clear()
        if len(self.meeting) > 4 * KEPT_WORDS:
            self.meeting.clear()
        ordered = sorted(words)  # code points and UTF-8 bytes have the same order
        self.words.update(zip(ordered, self._encode_sorted([w.encode() for w in ordered])))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        # Special tokens stand between the words of what lies between them.
        split = [
            [self.split(part) if i % 2 == 0 else [part] for i, part in enumerate(self.cut(text))]
            for text in texts
        ]
        words: set[str] = set()
        for parts in split:
            for part in parts[::2]:
                words.update(part)
        fresh = words.difference(self.words)
        self._learn(fresh if len(self.words) + len(fresh) <= KEPT_WORDS else words)
        word, special = self.words.__getitem__, {t: self.packed[i] for t, i in self.special.items()}.__getitem__
        return [
            b"".join([b"".join(map(special if i % 2 else word, part)) for i, part in enumerate(parts)])
            for parts in split
        ]

    def decode(self, packed: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(content: str) -> Encoder:
    """A worker reads a tokenizer once."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(content)
    return _ENCODERS[key]


def encoded(docs: DataFrame, tokenizer: str | Path, keep_tokens: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, with
    ``keep_tokens`` also ``ids`` and ``decoded``.

    ``tokenizer`` is a byte-level BPE file on the driver. Null texts count as empty and have no
    tokens. Special tokens are found in the text first. Repeated rows get equal results;
    other columns play no part. There is no shuffle: each worker keeps a trie of its own. Texts of any
    length are encoded whole, a long one alone in its batch. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_tokens:
        schema += ", ids array<bigint>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value)
        for batch in batches:
            for part in slices(batch, most=_BYTES_AT_ONCE):
                texts = [t or "" for t in part.column("text").to_pylist()]
                packed = bpe.encode_all(texts)
                decoded = [bpe.decode(p) for p in packed]
                columns = [
                    part.column("doc_id"),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_tokens:
                    columns += [
                        pa.array([np.frombuffer(p, "<u4").astype(np.int64) for p in packed], pa.list_(pa.int64())),
                        pa.array(decoded, pa.string()),
                    ]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema)
