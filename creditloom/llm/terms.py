"""Terms of a batch of texts with Arrow kernels: lower-cased, split, as dictionary indices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def encoded_terms(column: pa.Array, separators: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each term's dictionary index, the offsets of each text's terms, and the dictionary.

    Only A-Z are lower-cased. Terms are what lies between runs that match the regular
    expression ``separators``. A null text has no terms.
    """
    if column.null_count:
        column = column.fill_null("")
    lists = pc.split_pattern_regex(pc.ascii_lower(column), separators)
    at = lists.offsets.to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(pc.list_flatten(lists))
    codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    at = at - at[0]
    if empty >= 0:  # a text that begins or ends with a separator, or has no term
        filled = codes != empty
        sums = np.zeros(len(codes) + 1, dtype=np.int64)
        np.cumsum(filled, out=sums[1:])
        codes, at = codes[filled], sums[at]
    return codes, at, words
