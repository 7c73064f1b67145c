"""Fill-in-the-middle rewriting of documents.

A text is a run of units: a run of ASCII letters, or any other single character. One match of
``(unit)*`` over the whole text, by a regular expression library that retains every repetition
of a group, gives the ends of all units at once: their number and, by index, the offsets where the
middle begins and ends. Nothing is shuffled; a row's result depends on its text and doc_id alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import slices
from tristrata.llm.shared import ship

# Possessive: what is matched is never given back, so a match takes one pass.
UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
# The marks before prefix, suffix and middle, the forms, and the draw's seed.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = "1"
# Of a hundred documents so many stay plain, and of a hundred others so many are spm.
PLAIN_SHARE, SPM_SHARE = 10, 20

SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
Parts = tuple[int, str, int | None, int | None, str]


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """Four numbers below 2 ** 32, the same in every run; a null id counts as an empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def rewrite(
    doc_id: int | None,
    text: str,
    plain_share: int = PLAIN_SHARE,
    spm_share: int = SPM_SHARE,
    seed: str = SEED,
) -> Parts:
    """Units, form, characters of prefix and middle, and output of one text."""
    ends = [0, *UNITS.fullmatch(text).ends(1)]
    first, second, third, fourth = draws(doc_id, seed)
    if not text or third % 100 >= 100 - plain_share or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return len(ends) - 1, PLAIN, None, None, text
    at, to = sorted((ends[first % len(ends)], ends[second % len(ends)]))
    prefix, middle, suffix = text[:at], text[at:to], text[to:]
    if fourth % 100 < spm_share:
        return len(ends) - 1, SPM, at, to - at, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return len(ends) - 1, PSM, at, to - at, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transformed(
    docs: DataFrame, plain_share: int = PLAIN_SHARE, spm_share: int = SPM_SHARE, seed: str = SEED
) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` counts units, the two lengths code points; they are null where the form is plain. A null
    text counts as empty and stays plain, as does a text that holds one of the marks. A null doc_id
    draws as an empty text would. Rows with equal doc_id and text get equal results, however
    often they are repeated, and there are no ties; an empty table gives no rows. Texts of any length are
    cut whole, a long one alone in its batch; its ends take about as much memory as 20 times the text.
    Other columns of ``docs`` play no part.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id").to_pylist()
                texts = part.column("text").to_pylist()
                rows = [(i, *rewrite(i, t or "", plain_share, spm_share, seed)) for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], names=NAMES
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, SCHEMA)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def restored(output: Column, form: Column) -> Column:
    """The text that ``transformed`` made an output of. No piece of it holds a mark, and a mark
    cannot overlap what stands beside it, so each mark is found where it was put."""
    last = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    before = F.split_part(output, F.lit(MIDDLE), F.lit(1))

    def between(first: str, then: str) -> tuple[Column, Column]:
        head = F.split_part(before, F.lit(then), F.lit(1))
        return F.substring(head, len(first) + 1, 2**31 - 1), F.split_part(before, F.lit(then), F.lit(2))

    prefix, suffix = between(PREFIX, SUFFIX)
    suffix_first, prefix_then = between(SUFFIX, PREFIX)
    return (
        F.when(form == PSM, F.concat(prefix, last, suffix))
        .when(form == SPM, F.concat(prefix_then, last, suffix_first))
        .otherwise(output)
    )


def digests(rows: DataFrame) -> DataFrame:
    """The rows of ``transformed`` with digests of the output and of the text rebuilt from it."""
    return rows.select(
        *NAMES[:-1],
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
