"""Scoring texts with a hashed maximum-entropy language model.

The probability of a token is that of its class given the tokens before it, times that of
the token within its class. Classes come from the endings of words; they are the leaves
of a tree of two levels, so that the class softmax is factored into one over GROUPS groups
and one over the GROUPS classes of the right group. Both are log-linear in hashed features
of the history: the classes and words one, two and three places back (skips) and the pair
of words before (n-grams). The class frequencies are their prior. Within a class a token
has its smoothed relative frequency in the training texts, with one place for all unknown
tokens, so that the whole is a probability distribution over known tokens and "unknown".

Training is by distributed gradient updates. The texts are cut into chunks that are dealt
out over rounds; in each round every task goes on from the same weights with gradient
steps over its own chunks, and the changes are averaged, each weight by how many tokens
have touched it. Every training token is used once in each epoch.

Counts of tokens are exact and cover the corpus: chunks list their distinct words, the
lists are added up by word in a shuffle, and each chunk gets the totals of its own words
back. Nothing but class totals and model weights, both of fixed size, goes through the
driver.

Defined results: a null text is empty and has the end token only. Documents without doc_id
are training texts. Rows with the same doc_id are separate texts. An empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from scholarweave.llm import texts
from scholarweave.workspace import materialise, scratch_path

FOLDS, HELD_OUT = 5, 1
GROUPS = 16
CLASSES = GROUPS * GROUPS
ENDING = 3
CHUNK_BYTES = 8 << 20
ROUNDS = 4
EPOCHS = 1
BATCH = 16384
RATE = 0.5
DAMPING = 4.0
BLOCK = 64  # features whose weights travel together

# Buckets of each feature: the classes 1, 2 and 3 places back, the words 1 and 2 places
# back, and the pair of both. Together 4,096, so that the rows of both tables have numbers
# of 16 bits, which are sorted in linear time.
BUCKETS = (CLASSES + 1, CLASSES + 1, CLASSES + 1, 1024, 768, 1533)
FEATURES = sum(BUCKETS)

_CHUNK = (
    "chunk long, round int, doc_ids array<long>, doc_sizes array<long>, tokens binary, "
    "words array<string>, n_train array<long>, classes array<int>, hashes binary"
)


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def chunks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each run of documents: their tokens, and their distinct words.

    Tokens are numbers of words of the chunk; the empty word is the end token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = task << 32
        for batch in batches:
            for part in texts.slices(batch, limit=CHUNK_BYTES):
                words, sizes = texts.word_lists(pc.ascii_lower(part.column("text")))
                coded = words.dictionary_encode()
                names = pa.concat_arrays([coded.dictionary, pa.array([""], coded.dictionary.type)])
                end = len(names) - 1
                tokens = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(sizes), end)
                sizes = sizes + 1
                docs = part.column("doc_id").to_pylist()
                learned = np.repeat([not held_out(d) for d in docs], sizes)
                listed = names.to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "chunk": [number], "round": pa.array([(task + number) % ROUNDS], pa.int32()),
                    "doc_ids": [docs], "doc_sizes": [sizes.tolist()],
                    "tokens": [tokens.astype("<i4").tobytes()], "words": [listed],
                    "n_train": [np.bincount(tokens[learned], minlength=len(listed)).tolist()],
                    "classes": pa.array([_classes(names).tolist()], pa.list_(pa.int32())),
                    "hashes": [np.fromiter(map(xxhash.xxh32_intdigest, listed), "<u4", len(listed)).tobytes()],
                })
                number += 1

    return texts.id_and_text(df, key, text).mapInArrow(run, _CHUNK)


def _classes(words: pa.Array) -> np.ndarray:
    """Class of each word by its ending; the end token has class 0 to itself."""
    endings = pc.utf8_slice_codeunits(words, -ENDING).dictionary_encode()
    codes = [1 + xxhash.xxh32_intdigest(e) % (CLASSES - 1) if e else 0 for e in endings.dictionary.to_pylist()]
    return np.array(codes, np.int32)[endings.indices.to_numpy(zero_copy_only=False)]


@dataclass
class Totals:
    """Tokens and distinct tokens of the training texts, in all and by class."""

    tokens: np.ndarray
    distinct: np.ndarray

    def prior(self) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of groups, and of the classes within each."""
        by_class = np.log(self.tokens + 0.5).reshape(GROUPS, GROUPS).astype(np.float32)
        group = np.log(np.exp(by_class.astype(np.float64)).sum(axis=1))
        return (group - np.log(np.exp(group).sum())).astype(np.float32), (by_class - group[:, None]).astype(np.float32)


def count_words(stored: DataFrame) -> tuple[DataFrame, Totals]:
    """(chunk, place, c): how often each word of each chunk occurs in training, and the totals."""
    listed = stored.select("chunk", F.posexplode(F.arrays_zip("words", "n_train", "classes")).alias("place", "w")).select(
        "chunk", "place", F.col("w.words").alias("word"), F.col("w.n_train").alias("n"), F.col("w.classes").alias("class")
    )
    totals = listed.groupBy("word").agg(
        F.sum("n").alias("c"), F.min("class").alias("class"), F.min("chunk").alias("first")
    )
    once = F.when((F.col("chunk") == F.col("first")) & (F.col("c") > 0), F.col("class"))
    counts = materialise(
        listed.select("chunk", "place", "word").join(totals, "word").select("chunk", "place", "c", once.alias("class")),
        "word-counts",
    )
    # Only in the first chunk that has it does a known word still have its class.
    named = counts.where(F.col("class").isNotNull())
    by_class = named.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    found = Totals(np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64))
    for row in by_class.collect():
        found.tokens[row["class"]], found.distinct[row["class"]] = row.n, row.v
    return counts.select("chunk", "place", "c"), found


@dataclass
class Weights:
    group: np.ndarray  # [feature, group]
    leaf: np.ndarray  # [feature * GROUPS + group, class of the group]

    @staticmethod
    def zero() -> Weights:
        return Weights(np.zeros((FEATURES, GROUPS), np.float32), np.zeros((FEATURES * GROUPS, GROUPS), np.float32))

    def copy(self) -> Weights:
        return Weights(self.group.copy(), self.leaf.copy())


def history(cls: np.ndarray, word: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """[token, feature]: the bucket of each feature, from the tokens before in the same text."""
    place = np.arange(len(cls)) - np.repeat(texts.starts_of(sizes)[:-1], sizes)

    def back(values: np.ndarray, steps: int, before) -> np.ndarray:
        moved = np.roll(values, steps)
        moved[place < steps] = before
        return moved

    words = [back(word, n, 0).astype(np.uint64) for n in (1, 2)]
    mix = np.uint64(0x9E3779B97F4A7C15)
    hashed = [w * mix >> np.uint64(40) for w in (words[0], words[1] + np.uint64(1), words[0] * mix + words[1])]
    columns = [back(cls, n, CLASSES) for n in (1, 2, 3)]
    columns += [(h % np.uint64(b)).astype(np.int32) for h, b in zip(hashed, BUCKETS[3:])]
    return np.stack([c + base for c, base in zip(columns, texts.starts_of(np.array(BUCKETS))[:-1])], axis=1).astype(np.int32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def class_logs(w: Weights, prior, found: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of all groups, and of all classes of the right group."""
    group = cls // GROUPS
    first = np.repeat(prior[0][None, :], len(cls), axis=0)
    second = prior[1][group]
    part = np.empty_like(first)
    for column in found.T:
        first += np.take(w.group, column, axis=0, out=part, mode="clip")
        second += np.take(w.leaf, column * GROUPS + group, axis=0, out=part, mode="clip")
    return _log_softmax(first), _log_softmax(second)


def _move(table: np.ndarray, touched: np.ndarray, rows: np.ndarray, error: np.ndarray, rate: float) -> None:
    """Move rows of a table along the mean error of the tokens that use them; ``rows`` is sorted."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    n = np.diff(np.append(starts, len(rows))).astype(np.float32)
    rows = rows[starts]
    table[rows] += np.add.reduceat(error, starts, axis=0) * (rate / (n + DAMPING))[:, None]
    touched[rows] += n


def learn(w: Weights, prior, found: np.ndarray, cls: np.ndarray, touched: Weights, rate: float) -> None:
    """Gradient steps over the tokens of a chunk, in batches."""
    for at in range(0, len(cls), BATCH):
        part, y = found[at : at + BATCH], cls[at : at + BATCH]
        first, second = (np.exp(x) for x in class_logs(w, prior, part, y))
        n, group = np.arange(len(y)), y // GROUPS
        first, second = -first, -second
        first[n, group] += 1
        second[n, y % GROUPS] += 1
        for column in part.T:
            rows = column * GROUPS + group  # sorted by feature first, so it serves both tables
            order = np.argsort(rows.astype(np.uint16), kind="stable")
            rows = rows[order]
            _move(w.group, touched.group[:, 0], rows // GROUPS, np.take(first, order, axis=0), rate)
            _move(w.leaf, touched.leaf[:, 0], rows, np.take(second, order, axis=0), rate)


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, classes, word hashes, sizes of the texts) of a chunk's tokens."""
    tokens = np.frombuffer(row["tokens"], "<i4")
    classes = np.array(row["classes"], np.int32)
    return tokens, classes[tokens], np.frombuffer(row["hashes"], "<u4")[tokens], np.array(row["doc_sizes"], np.int64)


def _round(stored: DataFrame, w: Weights, prior, rate: float) -> None:
    """One round of updates of ``w`` in place."""
    shared = stored.sparkSession.sparkContext.broadcast((w, prior))
    blocks = range(0, FEATURES, BLOCK)
    kind = "block int, change binary, touched binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, prior = shared.value
        own, touched = start.copy(), Weights.zero()
        for batch in batches:
            for row in batch.to_pylist():
                _, cls, word, sizes = _tokens(row)
                learned = np.repeat([not held_out(d) for d in row["doc_ids"]], sizes)
                learn(own, prior, history(cls, word, sizes)[learned], cls[learned], touched, rate)
        for b in blocks if touched.group.any() else ():
            some, leaves = slice(b, b + BLOCK), slice(b * GROUPS, (b + BLOCK) * GROUPS)
            change = [own.group[some] - start.group[some], own.leaf[leaves] - start.leaf[leaves]]
            weight = [touched.group[some, 0], touched.leaf[leaves, 0]]
            yield pa.RecordBatch.from_pylist([{
                "block": b, "change": b"".join(c.astype("<f2").tobytes() for c in change),
                "touched": b"".join(c.astype("<f4").tobytes() for c in weight),
            }], pa.schema([("block", pa.int32()), ("change", pa.binary()), ("touched", pa.binary())]))

    def add(group: pa.Table) -> pa.Table:
        total = weight = np.float64(0)
        for change, touched in zip(group["change"], group["touched"]):
            n = np.frombuffer(touched.as_py(), "<f4").astype(np.float64)
            total = total + np.frombuffer(change.as_py(), "<f2").reshape(len(n), GROUPS) * n[:, None]
            weight = weight + n
        mean = (total / np.maximum(weight, 1)[:, None]).astype("<f4")
        return pa.table({"block": group["block"][:1], "change": pa.array([mean.tobytes()], pa.binary())})

    columns = stored.select("doc_ids", "doc_sizes", "tokens", "classes", "hashes")
    changes = columns.mapInArrow(work, kind).groupBy("block").applyInArrow(add, "block int, change binary")
    for row in changes.collect():  # the weights, of fixed size
        mean = np.frombuffer(row.change, "<f4").reshape(-1, GROUPS)
        n = min(BLOCK, FEATURES - row.block)
        w.group[row.block : row.block + n] += mean[:n]
        w.leaf[row.block * GROUPS : (row.block + n) * GROUPS] += mean[n:]
    shared.unpersist()


def train(stored: DataFrame, totals: Totals, epochs: int = EPOCHS, rate: float = RATE) -> Weights:
    """Weights after ``epochs`` passes over the stored chunks, ROUNDS rounds each."""
    w, prior = Weights.zero(), totals.prior()
    for step in range(epochs * ROUNDS):
        _round(stored.where(F.col("round") == step % ROUNDS), w, prior, rate / (1 + step / ROUNDS))
    return w


def score_chunk(row: dict, counts: np.ndarray, totals: Totals, w: Weights) -> dict[str, np.ndarray]:
    """Scores of the texts of a chunk; ``counts`` are those of its words."""
    tokens, cls, word, sizes = _tokens(row)
    n, v = int(totals.tokens.sum()), int(totals.distinct.sum())
    classes = np.array(row["classes"], np.int32)
    base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
    within = np.log10((counts + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1))[classes])
    found, prior = history(cls, word, sizes), totals.prior()
    log = within[tokens]
    for at in range(0, len(tokens), BATCH):
        y = cls[at : at + BATCH]
        first, second = class_logs(w, prior, found[at : at + BATCH], y)
        place = np.arange(len(y))
        log[at : at + BATCH] += (first[place, y // GROUPS] + second[place, y % GROUPS]) / np.log(10)
    starts = texts.starts_of(sizes)[:-1]
    return {
        "n_tokens": sizes,
        "n_known": np.add.reduceat((counts > 0)[tokens].astype(np.int64), starts),
        "base_score": np.add.reduceat(base[tokens], starts),
        "score": np.add.reduceat(log, starts),
    }


def score_documents(df: DataFrame, key: str = "doc_id", text: str = "text", epochs: int = EPOCHS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = df.sparkSession
    folder = scratch_path(spark, "chunks")
    chunks(df, key, text).write.option("compression", "zstd").partitionBy("round").parquet(folder)
    stored = spark.read.schema(_CHUNK).parquet(folder)
    counts, totals = count_words(stored)
    shared = spark.sparkContext.broadcast((totals, train(stored, totals, epochs)))

    def score(held: pa.Table, words: pa.Table) -> pa.Table:
        totals, w = shared.value
        out = []
        for row in held.to_pylist():
            c = np.zeros(len(row["classes"]), np.int64)
            c[words["place"].to_numpy()] = words["c"].to_numpy()
            found = score_chunk(row, c, totals, w)
            n = int(totals.tokens.sum())
            out.append(pa.table({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array([held_out(d) for d in row["doc_ids"]]),
                "n_tokens": pa.array(found["n_tokens"]), "n_known": pa.array(found["n_known"]),
                "train_tokens": pa.array(np.full(len(row["doc_ids"]), n, np.int64)),
                "base_score": pa.array(found["base_score"]), "score": pa.array(found["score"]),
            }))
        return pa.concat_tables(out)

    columns = stored.select("chunk", "doc_ids", "doc_sizes", "tokens", "classes", "hashes")
    return columns.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
