"""Token counts of sections: a text is encoded once, its tokens are dealt to the sections they lie in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsettle.llm.tokens import worker_encoder


def line_sections(text: str) -> np.ndarray:
    """First characters of a text's lines; a line holds the line feed that ends it."""
    at = np.frombuffer(text.encode("utf-32-le"), "<u4")
    starts = np.concatenate(([0], (at == 10).nonzero()[0] + 1))
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(text) else starts


def attribute(first: np.ndarray, end: np.ndarray, starts: np.ndarray, total: int, rule: str) -> np.ndarray:
    """Tokens per section, by an interval join of two sorted lists.

    A token inside one section counts there. One that crosses a boundary counts by ``rule``:
    ``start``: where its first character lies; ``overlap``: in the section that holds most of
    its characters, the earlier one where two hold as many. A token without characters counts
    where it stands.
    """
    counts = np.zeros(len(starts), np.int64)
    if not len(first):
        return counts
    own = np.maximum(np.searchsorted(starts, first, "right") - 1, 0)
    until = np.maximum(np.searchsorted(starts, np.maximum(end - 1, first), "right") - 1, own)
    if rule == "overlap":
        bounds = np.append(starts, total)
        for k in (until > own).nonzero()[0]:
            at = np.arange(own[k], until[k] + 1)
            held = np.minimum(bounds[at + 1], end[k]) - np.maximum(bounds[at], first[k])
            own[k] = at[int(np.argmax(held))]
    return np.bincount(own, minlength=len(starts))


def section_tokens(
    documents: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sections: Callable[[str], np.ndarray] = line_sections,
    rule: str = "overlap",
) -> DataFrame:
    """``id, section, first_char, n_chars, n_tokens``, one row per section of every input row.

    ``sections`` gives the sorted first characters of a text's sections, 0 among them; a section
    ends where the next begins. ``rule`` deals tokens that cross a boundary (see ``attribute``).
    Counts add up to the tokens of the whole text. A null text is an empty one; an empty text
    has one section without tokens. Rows are independent: repeated rows and null ids give rows
    of their own. Other columns are not read.
    """
    if rule not in ("start", "overlap"):
        raise ValueError(f"unknown rule {rule}")
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):  # spans of some texts at a time
                part = batch.slice(begin, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                cells = []
                for text in texts:
                    first, end = encoder.offsets(text)
                    starts = sections(text)
                    chars = np.diff(np.append(starts, len(text)))
                    cells.append((starts, chars, attribute(first, end, starts, len(text), rule)))
                sizes = [len(c[0]) for c in cells]
                at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                numbers = np.concatenate([np.arange(n) for n in sizes])
                columns = [np.concatenate([c[k] for c in cells]).astype(np.int64) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array(numbers), *map(pa.array, columns)],
                    ["id", "section", "first_char", "n_chars", "n_tokens"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, section long, first_char long, n_chars long, n_tokens long")
