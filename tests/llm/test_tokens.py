import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholarweave.llm import bpe, idfile, packing, token_counts, wordcodes
from scholarweave.llm.queries import WORD_BPE
from tests.llm import brute
from tests.llm.conftest import awkward, awkward_rows


@pytest.fixture(scope="module")
def coded(tokenizer):
    """(doc_id, text, ids by the library) of the awkward rows."""
    return [(i, t or "", tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in awkward_rows()]


def words(n: int, seed: int):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz'éß.0́"
    for _ in range(n):
        yield "".join(rng.choice("etaoinsr") for _ in range(rng.randint(1, 14)))
        yield "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        yield rng.choice(["a", "aa", "ha", "in", "na"]) * rng.randint(1, 30)
        yield "".join(chr(rng.choice([*range(33, 0x2FFF), 0x4E2D, 0x1F600])) for _ in range(rng.randint(1, 5)))


def test_backtracking_makes_the_merges(tokenizer):
    encoder = bpe.Encoder(WORD_BPE)
    for word in [*words(1500, 1), "x" * 20_000, "hahaha" * 2000, "<|endoftext|>a<|startoftext|>", "<|endoftext|"]:
        assert encoder.encode(word) == tokenizer.encode(word, add_special_tokens=False).ids


def test_pairs_that_merge_do_not_fit():
    merges = bpe.Merges(WORD_BPE)
    assert all(merges.fits(*pair) is False for pair in list(merges.made)[::50])


def test_library_words_are_the_library(tokenizer):
    some = [w for w in words(1500, 2) if w.split() == [w]]
    assert wordcodes.library_words(WORD_BPE)(some) == [tokenizer.encode(w, add_special_tokens=False).ids for w in some]


def test_bounded_cache():
    asked = []
    cache = wordcodes.RecentWords(lambda ws: asked.extend(ws) or [w.encode() for w in ws], size=2)
    for part in (["a", "b"], ["c", "a"], ["d"], ["a", "e"], ["long" * 50], ["long" * 50]):
        assert cache(part) == [w.encode() for w in part]
    assert len(cache._young) <= 4 and len(cache._old) <= 4 and asked.count("long" * 50) == 2


def test_digests(spark, tokenizer, coded):
    found = bpe.digests(awkward(spark), WORD_BPE).collect()
    want = Counter(
        (i, len(ids), brute_sha(brute.id_bytes(ids)), brute.sha256(tokenizer.decode(ids, skip_special_tokens=False)))
        for i, _, ids in coded
    )
    assert Counter(map(tuple, found)) == want


def brute_sha(raw: bytes) -> str:
    import hashlib

    return hashlib.sha256(raw).hexdigest()


def test_encode_and_decode_tables(spark, tokenizer, coded):
    ids = bpe.encode_documents(awkward(spark), WORD_BPE)
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids.collect()) == Counter((i, tuple(x)) for i, _, x in coded)
    back = bpe.decode_documents(ids, WORD_BPE).collect()
    want = Counter((i, tokenizer.decode(x, skip_special_tokens=False)) for i, _, x in coded)
    assert Counter(map(tuple, back)) == want
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode_documents(none, WORD_BPE).collect()] == ["", ""]


@pytest.mark.parametrize("n", [0, 1, 100, 4096, 10_000])
@pytest.mark.parametrize("most", [1, 2, 300, 49_408, 1 << 31, (1 << 64) - 1])
def test_simple8b_round_trip(n, most):
    rng = np.random.default_rng(n)
    values = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
    values[rng.random(n) < 0.5] //= np.uint64(1 + most // 3)
    coded = idfile.encode_ids(values)
    assert (idfile.decode_ids(coded) == values).all()
    if n > 8192:
        assert (idfile.decode_ids(coded, 1, 2) == values[4096:8192]).all()
    assert len(coded["words"]) <= 8 * n and (most < 1 << 60 or n == 0 or len(coded["escapes"]) > 0)


def test_id_files(spark, coded, tmp_path):
    folder = str(tmp_path / "ids")
    idfile.write_ids(awkward(spark), WORD_BPE, folder)
    rows = sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    starts = np.cumsum([0, *(len(x) + 1 for _, _, x in rows)])
    want = Counter((i, int(s), len(x) + 1, zlib.crc32(brute.id_bytes([*x, 1]))) for (i, _, x), s in zip(rows, starts))
    assert Counter(map(tuple, idfile.read_checksums(spark, folder).collect())) == want
    again = idfile.read_documents(spark, folder).where("doc_id = 13").first()
    assert again.ids == [*next(x for i, _, x in coded if i == 13), 1]


def test_files_of_many_partitions(spark, documents, tokenizer, tmp_path):
    folder = str(tmp_path / "ids")
    idfile.write_ids(documents.repartition(7), WORD_BPE, folder)
    found = idfile.read_checksums(spark, folder).orderBy("doc_id").collect()
    ids = [[*tokenizer.encode(r.text, add_special_tokens=False).ids, 1] for r in documents.orderBy("doc_id").collect()]
    assert [r.start for r in found] == [0, *np.cumsum([len(x) for x in ids])[:-1].tolist()]
    assert [r.ids_crc32 for r in found] == [zlib.crc32(brute.id_bytes(x)) for x in ids]


@pytest.mark.parametrize("frequent", [3, token_counts.FREQUENT])
def test_counts(spark, coded, frequent):
    found = token_counts.count_tokens(awkward(spark), WORD_BPE, frequent=frequent).collect()
    want = Counter((i, len(t.encode()), len(x), len(x) > 2048) for i, t, x in coded)
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == want
    assert sum(r.n_looked_up for r in found) > 0


def test_frequent_words(spark):
    docs = spark.createDataFrame([(i, "the the, of Été " + str(i)) for i in range(50)], "doc_id long, text string")
    assert set(token_counts.frequent_words(docs, 4)) == {"the", ",", "of", "été"}


def test_one_id_with_many_rows_is_split_over_files(spark, tmp_path):
    folder = str(tmp_path / "ids")
    docs = spark.createDataFrame([(7 if i % 3 else i, "same text" if i % 2 else f"text {i}") for i in range(900)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        idfile.write_ids(docs.repartition(6), WORD_BPE, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r.n for r in spark.read.parquet(folder).selectExpr("part", "size(doc_ids) AS d").groupBy("part").agg(F.sum("d").alias("n")).collect()]
    assert len(sizes) >= 3 and max(sizes) < 500
    found = idfile.read_checksums(spark, folder).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted(7 if i % 3 else i for i in range(900))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]


def test_equal_rows_do_not_fill_one_packing_group(spark, monkeypatch):
    docs = spark.createDataFrame([(7, "the same text") for _ in range(3000)], "doc_id long, text string")
    groups = []
    pack = packing.pack_pieces
    monkeypatch.setattr(packing, "pack_pieces", lambda pieces, window: groups.append(pieces) or pack(pieces, window, 100))
    found = packing.pack_documents(docs, WORD_BPE).collect()
    sizes = Counter(r.sequence_id >> packing._GROUP_BITS for r in found)
    assert len(found) == 3000 and len(sizes) > 20 and max(sizes.values()) < 200


def test_packing(spark, coded):
    found = packing.pack_documents(awkward(spark), WORD_BPE).collect()
    check_packing(found, [(i, [*x, 1]) for i, _, x in coded])


def check_packing(found, documents):
    """Every id is in one piece, sequences are gapless and at most 2048 long."""
    fills: dict[int, int] = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills.get(r.sequence_id, 0) and 0 < r.length <= 2048
        fills[r.sequence_id] = r.offset + r.length
    assert max(fills.values(), default=0) <= 2048
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found)
    want = Counter(
        (i, at, len(x[at : at + 2048]), zlib.crc32(brute.id_bytes(x[at : at + 2048])), len(x))
        for i, x in documents
        for at in range(0, len(x), 2048)
    )
    assert pieces == want
    return fills


def test_packing_is_tight_and_repeatable(spark, documents, tokenizer):
    found = packing.pack_documents(documents, WORD_BPE).collect()
    ids = [(r.doc_id, [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]) for r in documents.collect()]
    fills = check_packing(found, ids)
    assert brute.padding(fills.values()) < 0.02 * sum(fills.values())
    again = packing.pack_documents(documents.repartition(5), WORD_BPE).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_best_fit_against_a_plain_search():
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 2048) for _ in range(800)), reverse=True)
    rooms: list[int] = []
    for length, number, offset in zip(lengths, *packing.best_fit(lengths)):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            assert rooms[number] == min(fitting)
        else:
            rooms.append(2048)
            assert number == len(rooms) - 1
        assert offset == 2048 - rooms[number]
        rooms[number] -= length


def test_groups_are_bounded(spark):
    pieces = spark.range(1000).selectExpr(
        "id % 3 AS doc_id", "id AS start", "2048 AS length", "id AS ids_crc32", "4096 AS doc_tokens"
    )
    found = packing.pack_pieces(pieces, group_pieces=100).collect()
    groups = Counter(r.sequence_id >> 32 for r in found)
    assert len({r.sequence_id for r in found}) == 1000 and len(groups) == 10 and max(groups.values()) < 160


def test_empty_tables(spark, tmp_path):
    none = awkward(spark, [])
    assert bpe.digests(none, WORD_BPE).count() == 0
    idfile.write_ids(none, WORD_BPE, str(tmp_path / "none"))
    assert idfile.read_checksums(spark, str(tmp_path / "none")).count() == 0
    assert token_counts.count_tokens(none, WORD_BPE).count() == 0
    assert packing.pack_documents(none, WORD_BPE).count() == 0
