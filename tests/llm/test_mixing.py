import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tilewright.llm")

from tilewright.llm import mixing_model as mixing  # noqa: E402
from tilewright.llm import textkit  # noqa: E402


def tokens(text):
    return brute.words((text or "").translate({c: c + 32 for c in range(65, 91)})) + [None]


def base(rows):
    counts = Counter(t for doc, text, *_ in rows if zlib.crc32(str(doc).encode()) % 7 != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return n, {
        r[0]: (
            zlib.crc32(str(r[0]).encode()) % 7 == 2,
            len(tokens(r[1])),
            sum(counts[t] > 0 for t in tokens(r[1])),
            sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(r[1])),
        )
        for r in rows
    }


@pytest.mark.parametrize("frequent", [1 << 18, 40])
def test_counts_and_base(spark, monkeypatch, frequent):
    monkeypatch.setattr(mixing, "FREQUENT", frequent)
    rows = brute.fixture(n=120)
    got = {r.doc_id: r for r in mixing.score(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()}
    n, want = base(rows)
    for doc, (hold, n_tokens, n_known, score) in want.items():
        r = got[doc]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (hold, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(score, rel=1e-9)
    hold = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in hold) > sum(r.base_score for r in hold)


def test_probabilities_sum_to_one():
    """Over all codes, after any two tokens, whatever was learned."""
    text = pa.array(["a b a b c", "b b b b", "c a b x y z a a"])
    cells, match = np.zeros(mixing._CELLS, dtype=np.int64), np.zeros(mixing._MATCH, dtype=np.int64)
    (w,) = textkit.words(text)
    stream, first, _ = mixing.token_stream(w)
    codes = mixing.Codes(stream, first)
    np.add.at(cells, codes.before * mixing.LEAVES + codes.code, 1)
    np.add.at(cells, (mixing.BEFORE + codes.earlier) * mixing.LEAVES + codes.code, 1)
    match += np.bincount(codes.run * (mixing.CODE_BITS + 1) + codes.agree, minlength=mixing._MATCH)
    mixer = mixing.Mixer(mixing.Tables(cells, match))
    for _ in range(5):
        mixer.learn(codes)
    mixer.prepare()
    heads = np.arange(mixing.LEAVES, dtype=np.uint64) << np.uint64(64 - mixing.CODE_BITS)
    for pair in (stream[:2], stream[5:7]):
        three = np.concatenate([np.append(pair, h) for h in heads])
        every = mixing.Codes(three, np.arange(0, len(three) + 1, 3))
        p = np.exp(mixer.log_probabilities(every)[2::3])
        assert p.sum() == pytest.approx(1, abs=1e-9)


def test_odd_tables(spark):
    assert mixing.score(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    rows = [(None, None, None, None, None, None), (16, "only held out", "en", "s", 1, "k"), (16, "", "en", "s", 1, "k")]
    got = mixing.score(spark.createDataFrame(rows, brute.SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [("16", 1), ("16", 4), ("None", 1)]
    assert all(math.isfinite(r.score) for r in got)
