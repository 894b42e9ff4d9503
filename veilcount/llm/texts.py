"""Words of whole texts, and Arrow batches of texts, for the operators that run in Python workers."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes outside `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z become a blank; all others stay.
_PLAIN = bytes(
    code + 32 if 65 <= code <= 90 else code if code >= 128 or 48 <= code <= 57 or 97 <= code <= 122 else 32
    for code in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of digits, small ASCII letters and non-ASCII characters, A-Z lower-cased; null has none."""
    return text.translate(_PLAIN).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (20, 09 to 0D), A-Z lower-cased; null has none."""
    return text.lower().split() if text else []  # bytes.lower and bytes.split know ASCII only


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def small_batches(batches, rows: int = 512):
    """Slices of few rows, so that what a worker derives from them at once stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_batches(batches, name: str, most: int, rows: int = 4096):
    """Slices of few rows and, but for single long texts, few bytes of the column `name`."""
    for batch in small_batches(batches, rows):
        widths = pc.binary_length(batch.column(batch.schema.get_field_index(name))).fill_null(0)
        start, held = 0, 0
        for at, width in enumerate(widths.to_pylist()):
            held += width
            if held >= most:
                yield batch.slice(start, at + 1 - start)
                start, held = at + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
