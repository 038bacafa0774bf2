"""Words of text columns, found on whole byte buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from filmloom.llm.common import slices


def lowered_classes() -> np.ndarray:
    """Byte to byte: A-Z become a-z, all else stays."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def byte_chunks(
    batches: Iterator[pa.RecordBatch], text: str, classes: np.ndarray, size: int, cut: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, text ends and bytes mapped by ``classes``, about ``size`` bytes at a time; null counts as empty.

    A text above twice that size comes alone in several chunks, cut behind a byte of class ``cut`` (if it has one).
    """
    mapping = classes.tobytes()
    for part in slices(batches, text, size):
        column = part.column(text)
        if part.num_rows == 1 and len(whole := column[0].as_buffer() or b"") > 2 * size:
            data, start, edge = whole.to_pybytes().translate(mapping), 0, bytes([cut])
            while start < len(data):
                end = len(data)
                if end - start > size:
                    end = data.rfind(edge, start, start + size) + 1 or data.find(edge, start) + 1 or end
                yield part, np.array([end - start]), np.frombuffer(data, np.uint8, end - start, start)
                start = end
            continue
        column = column.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        values = column.buffers()[2]
        data = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]] if values is not None else np.zeros(0, np.uint8)
        yield part, ends[1:] - ends[0], classes[data]


def words_of(data: np.ndarray, is_word: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Start byte, text and dictionary-coded bytes of every word; no word passes the end of its text."""
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    inner = ends[:-1][ends[:-1] < len(data)]
    opens[inner] |= is_word[inner]
    starts = np.flatnonzero(opens)
    letters = data[is_word]
    offsets = np.append(np.cumsum(is_word, dtype=np.int32)[starts].astype(np.int64) - 1, len(letters))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())]
    )
    return starts, np.searchsorted(ends, starts, side="right"), words.dictionary_encode()
