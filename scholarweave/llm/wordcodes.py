"""Token ids of whole texts, put together from the ids of their words.

In the word tokenizers used here no token crosses ASCII white space: the normaliser
works on single characters and their combining marks, the pre-tokenizer drops white
space, and special strings hold none. The ids of a text are therefore the ids of its
words in order. Natural text repeats its words, so each task encodes a word once and
keeps it in a bounded cache; the rest is gathering arrays.

To have fewer different words, letters A to Z are made small first, as the normaliser will
do, and punctuation is set apart from what stands before it, where the pre-tokenizer will
part them. Texts in which this might change anything, with combining marks or what could
begin a special string, stay as they are.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from scholarweave.llm import texts

CACHED_WORDS = 150_000  # of each of two generations
LONGEST_CACHED = 64  # characters


_AS_THEY_ARE = r"<\||\pM"
APART = r"([a-z0-9À-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~])"

# Words that are one pre-token, or one for each digit, and that no normaliser changes.
_ONE_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[!-&(-/:-@\[-`{-~]+")
_DIGITS = re.compile(r"[0-9]+")


def pre_tokens(batch_texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words with the same ids as the texts, and the number of words of each text."""
    simple = pc.replace_substring_regex(pc.ascii_lower(batch_texts), APART, r"\1 \2")
    return texts.word_lists(pc.if_else(pc.match_substring_regex(batch_texts, _AS_THEY_ARE), batch_texts, simple))


class RecentWords:
    """A bounded cache: when the young generation is full, it replaces the old one."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], size: int = CACHED_WORDS) -> None:
        self._encode, self._size = encode, size
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def __call__(self, words: list[str]) -> list[bytes]:
        young, old = self._young, self._old
        found = [young.get(w) or old.get(w) for w in words]
        missing = [i for i, code in enumerate(found) if code is None]
        for i, code in zip(missing, self._encode([words[i] for i in missing])):
            found[i] = code
        for word, code in zip(words, found):
            if len(word) <= LONGEST_CACHED:
                young[word] = code
        if len(young) > self._size:
            self._old, self._young = young, {}
        return found


class WordEncoder:
    """Encodes arrays of texts. ``encode`` turns words into little-endian uint32 ids."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], size: int = CACHED_WORDS) -> None:
        self._words = RecentWords(encode, size)

    def __call__(self, batch_texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        words, n_words = pre_tokens(batch_texts)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(n_words), np.int64)
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        parts = self._words(coded.dictionary.to_pylist())
        lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts)) // 4
        ids = np.frombuffer(b"".join(parts), np.uint32)
        sizes = lengths[which]
        doc = np.repeat(np.arange(len(n_words)), n_words)
        out = texts.gather(ids, texts.starts_of(lengths)[:-1][which], sizes)
        return out, np.bincount(doc, sizes, len(n_words)).astype(np.int64)


@cache
def library(path: str):
    """The tokenizer of a file, without truncation and padding, single-threaded in a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_alphabet() -> dict[int, str]:
    """How a byte-level tokenizer spells the characters of _ONE_PIECE words."""
    from tokenizers.pre_tokenizers import ByteLevel

    spell = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: spell.pre_tokenize_str(chr(c))[0][0] for c in (*range(33, 127), *range(0xDF, 0x100))}


def pieces_of(word: str) -> list[str] | None:
    """The pre-tokens of a plain word; None for others."""
    if _ONE_PIECE.fullmatch(word):
        return [word]
    return list(word) if _DIGITS.fullmatch(word) else None


def library_words(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of words by the library: its model for plain words, all of it for others."""
    tokenizer = library(path)
    model, alphabet = tokenizer.model, byte_alphabet()

    def encode(words: list[str]) -> list[list[int]]:
        ids: list[list[int] | None] = []
        for word in words:
            pieces = pieces_of(word)
            if pieces is None:
                ids.append(None)
            else:
                ids.append([t.id for piece in pieces for t in model.tokenize(piece.translate(alphabet))])
        rest = [i for i, found in enumerate(ids) if found is None]
        for i, found in zip(rest, tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            ids[i] = found.ids
        return ids

    return encode


@cache
def library_encoder(path: str) -> WordEncoder:
    """One encoder per worker process, so that its cache outlives a task."""
    encode = library_words(path)
    return WordEncoder(lambda words: [np.array(ids, np.uint32).tobytes() for ids in encode(words)])


def encoded_slices(
    batches: Iterator[pa.RecordBatch], encoder: WordEncoder, end_id: int | None = None
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids, starts with the total last) for slices of the batches; ids as uint32."""
    for batch in batches:
        for part in texts.slices(batch):
            ids, counts = encoder(part.column("text"))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            yield part, ids, texts.starts_of(counts)


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").data)
