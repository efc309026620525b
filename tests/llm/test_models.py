import random

import brute
import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tilewright.llm")

from tilewright.llm import quality_model  # noqa: E402


def labelled(n=900):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "ti"]) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        w = [word() for _ in range(rnd.randint(20, 120))]
        if not good:
            kind = i % 3
            w = [x + rnd.choice(["$$$", "***"]) for x in w] if kind == 0 else [x.upper() + "!!" for x in w] if kind == 1 else [w[0]] * 30 + [w[1]] * 30
        docs.append((i, " ".join(w), "en", "s", 1, "k"))
        labels.append((i, int(good), 0))
    return docs, labels


def test_quality_model(spark):
    docs, labels = labelled()
    d = spark.createDataFrame(docs, brute.SCHEMA).repartition(4)
    table = spark.createDataFrame(labels + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality_model.score(d, table).collect()}
    truth = dict((i, q) for i, q, _ in labels)
    import zlib

    hold = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([(got[i] >= quality_model.THRESHOLD) == bool(truth[i]) for i in hold])
    assert right > 0.95 and len(hold) > 100
    # labels of held-out rows don't matter
    other = [(i, q if i not in set(hold) else 1 - q, t) for i, q, t in labels]
    again = {r.doc_id: r.score for r in quality_model.score(d, spark.createDataFrame(other, "doc_id long, quality int, toxic int")).collect()}
    assert again == got


def test_quality_model_of_odd_tables(spark):
    schema = "doc_id long, quality int, toxic int"
    docs = spark.createDataFrame([(1, None, None, None, None, None), (2, "", "en", "s", 1, "k"), (2, "a b", "en", "s", 1, "k")], brute.SCHEMA)
    got = quality_model.score(docs, spark.createDataFrame([(1, 1, 0)], schema))
    assert [r.score for r in got.collect()] == [1.0, 1.0, 1.0]
    assert got.columns == [*docs.columns, "score"]
    assert quality_model.score(docs.limit(0), spark.createDataFrame([], schema)).count() == 0


def test_pooling_in_small_slices_gives_the_same(monkeypatch):
    import tracemalloc

    from tilewright.llm import textkit

    texts = ["", "a b a b\n7", "   "] + ["Word %d of 9 words, A b C\n" % (i % 5) * 400 for i in range(100)]
    data, offsets = textkit.ragged(pa.array(texts))
    vectors = np.random.default_rng(4).random((quality_model.FEATURES, quality_model.WIDTH)).astype(np.float32)
    monkeypatch.setattr(quality_model, "SLICE_BYTES", 1 << 30)
    whole = quality_model.pooled(data, offsets, vectors)
    monkeypatch.undo()
    tracemalloc.start()
    assert np.array_equal(quality_model.pooled(data, offsets, vectors), whole)
    # the texts are a megabyte
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()
