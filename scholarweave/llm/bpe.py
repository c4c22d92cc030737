"""Byte-pair encoding without merge loops, and decoding by an offset table.

Encoder. In a vocabulary where every merge makes one token, a sequence of tokens is the
result of merging exactly if each pair of neighbours could stand side by side, and this
can be read from the merges: undo the later of the two merges again and again, and see
whether the touching halves would have merged earlier. So the encoder walks through the
word with the longest token at each place, found by one Aho-Corasick pass, checks it
against the token before it (answers are kept in a pair-compatibility table), takes the
next shorter token where the pair does not fit, and steps back where none does. Places
from which there was no way on are marked, so each is tried once and the time is linear
in the word's length.

Decoder. The bytes of all tokens lie in one buffer with a table of offsets; decoding ids
is one gather of ranges.

Defined results: null texts are empty; an empty text has no ids and decodes to the empty
string. Special strings inside a text become their ids. Repeated rows give repeated
results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from scholarweave.llm import texts, wordcodes

PAIRS_KEPT = 300_000
_FINAL = 0x10000  # added to a word's last character: it is a symbol of its own there


class Merges:
    """The vocabulary of a tokenizer file as tokens, merges and pair compatibility."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocabulary, merges = model["vocab"], model["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank: dict[int, int] = {}  # of tokens made by merging
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(pairs):
            whole = vocabulary[left + right]
            if whole in self.rank:
                raise ValueError(f"two merges make {left + right!r}")
            self.rank[whole] = rank
            self.halves[whole] = vocabulary[left], vocabulary[right]
            self.made[vocabulary[left], vocabulary[right]] = rank
        self.size: dict[int, int] = {}
        self.tokens = ahocorasick.Automaton()
        for token, number in vocabulary.items():
            symbols = self.symbols(token)
            self.size[number] = len(symbols)
            self.tokens.add_word(symbols, number)
        self.tokens.make_automaton()
        self._fits: dict[int, bool] = {}  # by both numbers in one

    def symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + _FINAL)
        return token

    def fits(self, left: int, right: int) -> bool:
        """Whether merging can leave ``left`` and ``right`` next to each other."""
        pair = left << 32 | right
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) >= PAIRS_KEPT:
                self._fits.clear()
            known = self._fits[pair] = self._compare(left, right)
        return known

    def _compare(self, left: int, right: int) -> bool:
        # Go back in time. ``limit`` is the rank of the step undone last: what touches
        # at that time must not merge before it.
        limit = len(self.rank)
        while True:
            merged = self.made.get((left, right))
            if merged is not None and merged < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            # The later merge is undone. Of equal merges the leftmost is made first: a
            # merge across the boundary waits for an equal one in the left token, but
            # comes before an equal one in the right token.
            if a > b:
                limit, left = a, self.halves[left][1]
            else:
                limit, right = b + 1, self.halves[right][0]

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-token, given in the vocabulary's alphabet."""
        if not word:
            return []
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + _FINAL)
        at: list[list[int]] = [[] for _ in word]
        for end, number in self.tokens.iter(word):
            at[end - self.size[number] + 1].append(number)  # shorter ones first
        # For each token on the way: which of the candidates at its place it is.
        chosen: list[int] = []
        tried: list[int] = []
        dead = bytearray(len(word) + 1)
        place, candidate = 0, len(at[0]) - 1
        while place < len(word):
            while candidate >= 0:
                token = at[place][candidate]
                if not dead[place + self.size[token]] and (not chosen or self.fits(chosen[-1], token)):
                    break
                candidate -= 1
            if candidate >= 0:
                chosen.append(token)
                tried.append(candidate)
                place += self.size[token]
                candidate = len(at[place]) - 1 if place < len(word) else -1
            elif chosen:
                dead[place] = 1
                place -= self.size[chosen.pop()]
                candidate = tried.pop() - 1
            else:
                raise ValueError(f"no tokens for {word!r}")
        return chosen


class Encoder:
    """Splits words as the tokenizer file says and encodes their pieces by ``Merges``."""

    def __init__(self, path: str) -> None:
        self.merges = Merges(path)
        tokenizer = wordcodes.library(path)
        self._normal, self._pieces = tokenizer.normalizer, tokenizer.pre_tokenizer
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self._added = added
        self._special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._known: dict[str, list[int]] = {}
        self._alphabet = wordcodes.byte_alphabet()

    def encode(self, text: str) -> list[int]:
        ids, end = [], 0
        for found in self._special.finditer(text) if self._special else ():
            ids += self._plain(text[end : found.start()])
            ids.append(self._added[found.group()])
            end = found.end()
        return ids + self._plain(text[end:])

    def _plain(self, text: str) -> list[int]:
        ids: list[int] = []
        if not text:
            return ids
        pieces = wordcodes.pieces_of(text)
        if pieces is not None:  # a shorter way to the same pieces
            pieces = [p.translate(self._alphabet) for p in pieces]
        else:
            if self._normal is not None:
                text = self._normal.normalize_str(text)
            pieces = [p for p, _ in self._pieces.pre_tokenize_str(text)]
        for piece in pieces:
            known = self._known.get(piece)
            if known is None:
                known = self.merges.encode(piece)
                if len(piece) <= wordcodes.LONGEST_CACHED:
                    if len(self._known) >= wordcodes.CACHED_WORDS:
                        self._known.clear()
                    self._known[piece] = known
            ids += known
        return ids

    def encode_words(self, words: list[str]) -> list[bytes]:
        return [np.asarray(self.encode(w), np.uint32).tobytes() for w in words]


class Decoder:
    """Token bytes in one buffer with offsets. Without a decoder in the file, a space joins tokens."""

    def __init__(self, path: str) -> None:
        tokenizer = wordcodes.library(path)
        if tokenizer.decoder is not None:
            raise ValueError("only files without a decoder of their own are read")
        named = tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(named.values()) + 1)
        for token, number in named.items():
            tokens[number] = token.encode() + b" "
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._starts = texts.starts_of(self._sizes)[:-1]

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, each with a space behind it, and where each one begins."""
        sizes = self._sizes[ids]
        return texts.gather(self._bytes, self._starts[ids], sizes), texts.starts_of(sizes)


@cache
def _worker(path: str) -> tuple[wordcodes.WordEncoder, Decoder]:
    return wordcodes.WordEncoder(Encoder(path).encode_words), Decoder(path)


def encode_documents(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, starts in wordcodes.encoded_slices(batches, _worker(path)[0]):
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    return texts.id_and_text(df, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) from arrays of ids; a null array is empty."""
    texts.with_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _worker(path)[1]
        for batch in batches:
            lists = batch.column("ids")
            counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
            raw, starts = decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            out = [bytes(x).decode() for x in _documents(raw, starts, texts.starts_of(counts))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    chosen = df.selectExpr(f"CAST(`{key}` AS BIGINT) AS doc_id", f"CAST(`{ids}` AS ARRAY<INT>) AS ids")
    return chosen.mapInArrow(run, "doc_id long, text string")


def _documents(raw: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
    """Decoded bytes of each document, without the space behind its last token."""
    view = memoryview(np.ascontiguousarray(raw))
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield view[starts[a] : starts[b] - 1] if b > a else view[:0]


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts encoded, then decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decode = _worker(path)
        for part, ids, bounds in wordcodes.encoded_slices(batches, encoder):
            raw, starts = decode(ids)
            view = memoryview(ids.astype("<u4"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "n_tokens": pa.array(np.diff(bounds)),
                "ids_sha256": [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in _documents(raw, starts, bounds)],
            })

    return texts.id_and_text(df, key, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
