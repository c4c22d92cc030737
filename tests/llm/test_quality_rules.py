import argparse
import base64
import os
import random
import string
from collections import Counter
from pathlib import Path

import pytest
import zstandard

from scholarweave.llm import quality_rules as Q
from tests.llm import brute
from tests.llm.conftest import PROSE, awkward, awkward_rows

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def compare(rows, found):
    want = Counter((i, *brute.base_quality(t)) for i, t in rows)
    assert Counter((r.doc_id, *(r[n] for n in NAMES)) for r in found) == want


def test_base_on_awkward_rows(spark):
    compare(awkward_rows(), Q.score_documents(awkward(spark)).collect())


def test_base_on_the_table(spark, documents):
    found = Q.score_documents(documents).collect()
    compare([(r.doc_id, r.text) for r in documents.collect()], found)
    assert all(not r.kept for r in found if r.base_failed)


def test_bands(spark):
    noise = base64.b85encode(os.urandom(9000)).decode()
    cases = {
        1: PROSE, 3: " ".join(noise[i : i + 40] for i in range(0, len(noise), 40)),
        4: " ".join(f"{i % 10}a" for i in range(5000)), 5: " ".join(str(i)[-1] * 30 for i in range(12)),
    }
    rows = {r.doc_id: r for r in Q.score_documents(awkward(spark, list(cases.items()))).collect()}
    assert rows[1].kept and rows[1].ratio > 0.5
    assert not rows[3].kept and not rows[3].base_failed and rows[3].n_chunks_outside == rows[3].n_chunks > 1
    assert not rows[4].kept and not rows[5].kept


def test_hidden_repetition_shows_in_chunks():
    import zstandard

    rules = Q.Rules(chunk_bytes=1024, max_chunks_outside=0.2)
    rng = random.Random(1)
    prose = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(8000)).encode()[:40_000]
    text = prose[:20_000] + b"ab " * 7000 + prose[20_000:]
    ratio, chunks, outside, good = Q.compression(text, rules, zstandard.ZstdCompressor(level=3))
    assert ratio > 0.2 and 15 <= outside < chunks and not good


def noise(kind, n, rng):
    tokens = lambda alphabet: " ".join("".join(rng.choices(alphabet, k=8)) for _ in range(n // 8 + 1)).encode()
    digits = rng.randbytes(n).hex()
    return {
        "base64": lambda: base64.encodebytes(rng.randbytes(n)),
        "printable": lambda: "".join(rng.choices(string.printable[:95], k=n)).encode(),
        "tokens": lambda: tokens(string.ascii_letters + string.digits),
        "lower": lambda: tokens(string.ascii_lowercase),
        "hex lines": lambda: "\n".join(digits[i : i + 64] for i in range(0, len(digits), 64)).encode(),
        "hex pairs": lambda: rng.randbytes(n).hex(" ").encode(),
    }[kind]()[:n]


FROM = {"base64": 100, "printable": 100, "tokens": 100, "lower": 1024, "hex lines": 1280, "hex pairs": 3072}


@pytest.mark.parametrize("kind", FROM)
def test_noise_of_every_band_is_told(kind):
    rules, rng, compressor = Q.Rules(), random.Random(kind), zstandard.ZstdCompressor(level=3)
    least = [b[0] for b in rules.bands if b[0] >= FROM[kind]]
    sizes = {*least, *(n - 1 for n in least[1:]), 6000, 8192, 10_000, 100_000}
    kept = {n: sum(Q.compression(noise(kind, n, rng), rules, compressor)[3] for _ in range(20)) for n in sizes}
    assert all(k <= 2 for k in kept.values()), kept


def test_documents_and_code_stay(documents):
    rules, rng, compressor = Q.Rules(), random.Random(2), zstandard.ZstdCompressor(level=3)
    code = [Path(m.__file__).read_bytes() for m in (argparse, random, string)]
    prose = [r.text.encode() for r in documents.collect() if r.text and not brute.base_quality(r.text)[5]]
    for least in [b[0] for b in rules.bands]:
        for parts in (code, prose):
            cuts = []
            for _ in range(100):
                part = rng.choice([p for p in parts if len(p) >= least])
                at = rng.randrange(len(part) - least + 1)
                cuts.append(part[at : at + least])
            noisy = [c for c in cuts if not Q.compression(c, rules, compressor)[3] and len(compressor.compress(c)) > 0.4 * len(c)]
            assert len(noisy) <= 3, (least, len(noisy))


def test_two_noisy_chunks_of_a_long_text_and_a_noisy_tail_count(documents):
    rules, rng, compressor = Q.Rules(), random.Random(4), zstandard.ZstdCompressor(level=3)
    texts = [r.text for r in documents.collect() if r.text and not brute.base_quality(r.text)[5]]
    prose = " ".join(dict.fromkeys(texts)).encode()[: 30 * 4096]
    before, good = Q.compression(prose, rules, compressor)[2:]
    assert before == 0 and good
    hidden = prose[: 10 * 4096] + noise("base64", 2 * 4096, rng) + prose[12 * 4096 :]
    assert Q.compression(hidden, rules, compressor)[2] >= 2 and not Q.compression(hidden, rules, compressor)[3]
    tail = Q.compression(prose + noise("base64", 3500, rng), rules, compressor)
    assert tail[1] == 31 and tail[2] == before + 1


def test_keep_good_keeps_columns(spark):
    docs = awkward(spark)
    kept = Q.keep_good(docs)
    assert kept.schema == docs.schema
    want = Counter(r.doc_id for r in Q.score_documents(docs).collect() if r.kept)
    assert Counter(r.doc_id for r in kept.collect()) == want and want[7] == 2


def test_empty_table(spark):
    assert Q.score_documents(awkward(spark, [])).count() == 0 and Q.keep_good(awkward(spark, [])).count() == 0
