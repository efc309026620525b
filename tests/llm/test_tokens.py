import random
import zlib

import brute
import numpy as np
import pytest

pytest.importorskip("tilewright.llm")

import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tilewright.llm import packing, token_files, tokens  # noqa: E402

ODD = [
    "", " ", "a  b", " a", "a ", "it's 's 're I'LL  x\n\n y\t\tz \n a", "<|endoftext|> a", "naïve é́", "\x1c a\x85b\xa0c", "日本 語",
    "x\r\n y", "½ a²b", "ǅ İstanbul", "don't'", "a\n b", "\n", "a \n b", "--- ... !!", "_x_ 12 345", "ÀÉ öß ŉ", "a­b", "\x00 z",
]


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(vocabulary):
    library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    encoder = tokens.Encoder(vocabulary)
    for text in ODD + [r[1] for r in brute.fixture() if r[1]]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want, text[:40]


def ids_of(vocabulary, text, end):
    return Tokenizer.from_file(public_tokenizers.path(vocabulary)).encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    rows = brute.fixture() + [(None, "no id", "en", "s", 1, "k"), (8, "twice", "en", "s", 1, "k"), (8, "again twice", "en", "s", 1, "k")]
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(4)
    parts = token_files.write_token_files(docs, str(tmp_path), length=64)
    got = sorted(map(tuple, token_files.read_token_files(spark, str(tmp_path), parts).collect()), key=lambda r: r[1])
    start, want, stream = 0, [], []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = ids_of("byte_bpe_50k.json", r[1], 0)
        want.append((r[0], start, len(ids), crc(ids)))
        start += len(ids)
        stream.append(ids)
    assert got == want
    reader = token_files.read_sequences(str(tmp_path), parts[0][0])
    ids, mask = token_files.sequence(reader, 1)
    flat = [i for ids in stream for i in ids]
    assert ids.tolist() == flat[64:128] and all(mask.to_pylist())
    assert ids.base is not None


def test_token_files_of_an_empty_table(spark, tmp_path):
    parts = token_files.write_token_files(spark.createDataFrame([], brute.SCHEMA), str(tmp_path))
    assert parts == [] and token_files.read_token_files(spark, str(tmp_path), parts).count() == 0


def test_lower_bound_and_fit():
    rnd = random.Random(3)
    for _ in range(200):
        lengths = np.array([rnd.randint(1, 30) for _ in range(rnd.randint(1, 8))])
        bins, offsets = packing.best_fit_decreasing(lengths, 30)
        spans = sorted(zip(bins, offsets, lengths))
        for (b, o, n), (c, p, _) in zip(spans, spans[1:]):
            assert p == (o + n if b == c else 0)
        assert all(sum(n for c, _, n in spans if c == b) <= 30 for b in bins)
        best = optimum(lengths.tolist(), 30)
        sizes, counts = np.unique(lengths, return_counts=True)
        assert packing.lower_bound(sizes, counts, 30) <= best <= bins.max() + 1


def optimum(lengths, capacity):
    best = [len(lengths)]

    def place(i, loads):
        if len(loads) >= best[0] and i < len(lengths):
            return
        if i == len(lengths):
            best[0] = min(best[0], len(loads))
            return
        for j in range(len(loads)):
            if loads[j] + lengths[i] <= capacity:
                place(i + 1, loads[:j] + [loads[j] + lengths[i]] + loads[j + 1 :])
        place(i + 1, loads + [lengths[i]])

    place(0, [])
    return best[0]


def check_packing(rows, got, capacity):
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text, *_ in rows:
        ids = ids_of("word_bpe_49k.json", text, 1)
        cut = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
        own = sorted(by_doc.pop(doc), key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == [(i, i * capacity, len(c), crc(c)) for i, c in enumerate(cut)]
    assert not by_doc
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packing(spark):
    rows = brute.fixture(n=80)
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    pieces = packing.token_pieces(docs, capacity=256).cache()
    total = sum(r.length for r in pieces.collect())
    for group in (100_000, 25):
        placed = pieces.join(packing.pack(pieces, 256, group_size=group), "row").collect()
        n = check_packing(rows, placed, 256)
        assert n <= -(-total // 256) * 1.1 + 2
    assert packing.packed_pieces(spark.createDataFrame([], brute.SCHEMA)).count() == 0
    same = spark.createDataFrame([(5, "a", "en", "s", 1, "k"), (5, None, "en", "s", 1, "k")], brute.SCHEMA)
    assert sorted((r.doc_id, r.length) for r in packing.packed_pieces(same).collect()) == [(5, 1), (5, 2)]
