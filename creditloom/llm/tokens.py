"""Token ids of whole texts with the tokenizers library, each distinct word encoded once.

The byte-level split rule of the vocabulary always begins a new piece before a space
that a non-space follows, after a line break that a non-space follows, and between a
letter and a punctuation mark. So a text may be cut there and its parts encoded apart.
The parts of a batch are made distinct first; only those not met before are encoded,
many to a call, and told apart again by the byte lengths of their tokens. A word of
letters alone is one piece of the split rule, so such parts skip that rule: they are
given as the byte-level alphabet spells them. Texts in which a cut would be doubtful
(runs of white space, or a string that the vocabulary takes out ahead of the split) are
encoded whole.
"""

from __future__ import annotations

import os
from itertools import pairwise, repeat
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from creditloom.llm.words import utf8

if TYPE_CHECKING:
    from tokenizers import Tokenizer

GROUP = 200
LONG_PART = 64
PART_BYTES = 100
ASCII_SPACE = np.asarray([k < 0x80 and chr(k).isspace() for k in range(256)])
ASCII_LETTER = np.asarray([k < 0x80 and chr(k).isalpha() for k in range(256)])
ASCII_MARK = np.asarray([0x20 < k < 0x7F and not chr(k).isalnum() for k in range(256)])
# U+00C0 to U+017F and U+0400 to U+047F are letters but for the signs of multiplication and division
LETTER_LEAD = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5, 0xD0, 0xD1])
# first bytes of the white space beyond ASCII
SPACE_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
# bytes of text to encode at once: the more, the fewer words are looked up
TEXT_BYTES = 6_000_000


def vocabulary_path(path: str | None = None) -> str:
    """The given vocabulary file, or the installed public one that is the default."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def doubtful(part: bytes) -> bool:
    """Does the part begin with white space other than one space before a non-space?"""
    text = part[:8].decode("utf-8", "ignore")
    return text[:1].isspace() and (len(text) == 1 or text[0] != " " or text[1].isspace())


def doubtful_parts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``doubtful`` for all parts (none is empty): two bytes tell, unless they may begin other white space."""
    size, first = np.diff(at), data[at[:-1]]
    second = data[np.minimum(at[:-1] + 1, len(data) - 1)]
    bad = ASCII_SPACE[first] & ((first != 0x20) | (size == 1) | ASCII_SPACE[second])
    for k in np.flatnonzero(SPACE_LEAD[first] | ((first == 0x20) & (size > 1) & SPACE_LEAD[second])).tolist():
        bad[k] = doubtful(data[at[k] : at[k] + 8][: size[k]].tobytes())
    return bad


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the two-byte letters that are told from their bytes alone."""
    out = ASCII_LETTER[data]
    lead = np.flatnonzero(LETTER_LEAD[data[:-1]])
    second = data[lead + 1]
    sign = (data[lead] == 0xC3) & ((second == 0x97) | (second == 0xB7))
    lead = lead[(second >= 0x80) & (second < 0xC0) & ~sign]
    out[lead] = out[lead + 1] = True
    return out


def part_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """First bytes of the parts: those of texts, spaces, bytes after a line break and marks after a letter."""
    first = np.zeros(len(data) + 1, dtype=bool)
    np.equal(data, 0x20, out=first[:-1])
    first[1:] |= data == 0x0A
    first[1:-1] |= letter_bytes(data)[:-1] & ASCII_MARK[data[1:]]
    first[at] = True
    return np.flatnonzero(first[:-1])


def byte_alphabet() -> np.ndarray:
    """The character (as a code point) by which byte-level vocabularies spell each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.arange(256, dtype=np.uint32)
    others = np.setdiff1d(np.arange(256), plain)
    out[others] = 256 + np.arange(len(others))
    return out


def each(parts: pa.Array) -> list[bytes]:
    """The parts one by one; several times faster than ``to_pylist``."""
    return parts.to_numpy(zero_copy_only=False).tolist()


def shared_coder(path: str) -> TokenCoder:
    """The Python worker's coder for a vocabulary file: its words outlive a task."""
    import tokenizers

    coders = vars(tokenizers).setdefault("_kept_coders", {})
    if path not in coders:
        coders[path] = TokenCoder(path)
    return coders[path]


class TokenCoder:
    """Encodes Arrow string columns.

    Parts met before are kept with their ids: ``keep`` of them at most, with ``PART_BYTES``
    for each on average (or one batch's). Beyond that the more frequent half stays, without
    those longer than ``LONG_PART`` bytes.
    """

    def __init__(self, path: str, keep: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = np.asarray([len(self.tokenizer.id_to_token(k) or "") for k in range(size)], dtype=np.int64)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet, self.keep = byte_alphabet(), keep
        # the numbers of known parts; by number, their ids, whether they are doubtful, and how often they were met
        self.known, self.codes = {}, pa.array([], pa.large_binary())
        self.bad, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)
        self.held = 0  # bytes of known parts

    def _learn(self, parts: pa.Array) -> None:
        """Encodes new parts and keeps their ids behind the others."""
        data, at = utf8(parts)
        size, letter = np.diff(at), letter_bytes(data)
        spaced = data[at[:-1]] == 0x20
        letter[at[:-1][spaced & (size > 1)]] = True
        word = np.logical_and.reduceat(letter, at[:-1])
        kinds = [np.flatnonzero(word), np.flatnonzero(spaced & ~word), np.flatnonzero(~spaced & ~word)]
        others = [each(parts.take(pa.array(kind))) for kind in kinds[1:]]
        codes = [self._word_codes(data[np.repeat(word, size)], size[word]), self._codes(others[0], GROUP), self._codes(others[1], 1)]
        self.codes = pa.concat_arrays([self.codes, pa.concat_arrays(codes).take(pa.array(np.argsort(np.concatenate(kinds))))])
        bad = np.zeros(len(parts), dtype=bool)
        if not word.all():
            bad[~word] = doubtful_parts(*utf8(parts.filter(pa.array(~word))))
        self.bad = np.concatenate([self.bad, bad])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), np.int64)])
        self.known.update(zip(each(parts), range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.held += len(data)

    def _word_codes(self, data: np.ndarray, size: np.ndarray) -> pa.Array:
        """The ids of words of letters, whose bytes lie end to end: so many as one text, in the byte-level alphabet."""
        ends = np.cumsum(size)
        spelled = np.full(len(data) + len(size), 0x20, dtype="<u4")
        after = ends + np.arange(len(ends))
        put = np.ones(len(spelled), dtype=bool)
        put[after] = False
        spelled[put] = self.alphabet[data]
        cuts = [0, *(after[GROUP - 1 : -1 : GROUP] + 1).tolist(), len(spelled)]
        texts = [spelled[a:b].tobytes().decode("utf-32-le") for a, b in pairwise(cuts)]
        return self._told_apart(self.words, texts, ends)

    def _codes(self, parts: list[bytes], together: int) -> pa.Array:
        """The ids of other parts, so many as one text."""
        texts = [b"".join(parts[k : k + together]).decode("utf-8", "replace") for k in range(0, len(parts), together)]
        ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        return self._told_apart(self.tokenizer, texts, ends)

    def _told_apart(self, tokenizer: Tokenizer, texts: list[str], ends: np.ndarray) -> pa.Array:
        """The ids of each part of the texts, as bytes of 32-bit integers; ``ends``: where the parts' bytes end."""
        ids = [np.zeros(0, np.uint32)]
        # the library's encodings are many times larger than the ids
        for k in range(0, len(texts), GROUP):
            ids += [np.asarray(code.ids, dtype=np.uint32) for code in tokenizer.encode_batch_fast(texts[k : k + GROUP], add_special_tokens=False)]
        ids = np.concatenate(ids)
        cuts = np.append(0, 4 * np.searchsorted(np.cumsum(self.width[ids]), ends, side="right"))
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])

    def _forget(self) -> None:
        """Leaves the more frequent half of the parts, without long ones."""
        parts = list(self.known)
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        short = np.flatnonzero(size <= LONG_PART)
        kept = short[np.argsort(-self.uses[short], kind="stable")[: self.keep // 2]]
        self.known = {parts[k]: n for n, k in enumerate(kept.tolist())}
        self.codes, self.bad, self.uses = self.codes.take(pa.array(kept)), self.bad[kept], self.uses[kept] // 2
        self.held = int(size[kept].sum())

    def _holding_added(self, column: pa.Array, data: np.ndarray) -> np.ndarray:
        """Does the text hold a string that the vocabulary takes out ahead of its split rule?"""
        out, raw = np.zeros(len(column), dtype=bool), data.tobytes()
        for text in self.added:
            if text.encode() in raw:
                out |= pc.fill_null(pc.match_substring(column, text), False).to_numpy(zero_copy_only=False)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and the offsets of each text's ids. A null is empty."""
        data, at = utf8(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        starts = part_starts(data, at)
        bounds = np.append(starts, len(data)).astype(np.int32)
        parts = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        number = np.fromiter(map(self.known.get, each(coded.dictionary), repeat(-1)), dtype=np.int64, count=len(coded.dictionary))
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn(coded.dictionary.take(pa.array(new)))
        index, at = number[coded.indices.to_numpy()], np.searchsorted(starts, at)
        _, sums, raw = self.codes.take(pa.array(index)).buffers()
        ids, sums = np.frombuffer(raw, dtype=np.uint32), np.frombuffer(sums, dtype=np.int64)[: len(index) + 1] // 4
        ids, ends = ids[: sums[-1]], sums[at]

        again = self._holding_added(column, data)
        if self.bad.any():
            again |= np.diff(np.append(0, np.cumsum(self.bad[index]))[at]) > 0
        self.uses += np.bincount(index, minlength=len(self.uses))
        if len(self.known) > self.keep or self.held + self.codes.nbytes > PART_BYTES * self.keep:
            self._forget()
        if not again.any():
            return ids, ends
        whole = np.flatnonzero(again)
        out = [ids[ends[k] : ends[k + 1]] for k in range(len(column))]
        for k, code in zip(whole, self.tokenizer.encode_batch_fast(column.take(pa.array(whole)).to_pylist(), add_special_tokens=False), strict=True):
            out[k] = np.asarray(code.ids, dtype=np.uint32)
        return np.concatenate(out), np.concatenate([[0], np.cumsum([len(x) for x in out])])

    def encode_ending(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with the id ``end`` after each text."""
        ids, at = self.encode(column)
        out = np.full(len(ids) + len(at) - 1, end, dtype=np.uint32)
        put = np.ones(len(out), dtype=bool)
        shifted = at + np.arange(len(at))
        put[shifted[1:] - 1] = False
        out[put] = ids
        return out, shifted
