import os
import zlib

import brute
import numpy as np
import pytest

pytest.importorskip("tilewright.llm")

import corpus_pipeline  # noqa: E402
from test_models import labelled  # noqa: E402
from test_tokens import check_packing  # noqa: E402

from tilewright.llm import decontamination, quality_model  # noqa: E402


def test_stages(spark, tmp_path):
    """Every stage against a plain version on the rows that it got."""
    docs, labels = labelled()
    items = [(i, " ".join(docs[i * 9 + 1][1].split()[:15])) for i in range(4)]
    extra = brute.fixture(n=50)
    extra = [(10_000 + r[0], *r[1:]) for r in extra] + [(20_000, (docs[0][1] + " " + items[0][1].upper()), "en", "s", 1, "k")]
    spark.createDataFrame(docs + extra, brute.SCHEMA).drop("kept").write.parquet(os.path.join(tmp_path, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(tmp_path, "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(tmp_path, "benchmark.parquet"))
    folder = str(tmp_path)

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "near duplicates", "benchmark decontamination", "best-fit packing"
    ]
    read = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [[tuple(r) for r in read.collect()]]
    current = read
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, current, folder).write.parquet(f"{folder}/out{k}")
        current = spark.read.parquet(f"{folder}/out{k}")
        if k < 4:
            assert current.columns == read.columns
            rows.append([tuple(r) for r in current.collect()])
    by_id = [{r[0]: r for r in part} for part in rows]

    scores = {r.doc_id: r.score for r in quality_model.score(read, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert set(by_id[1]) == {d for d in by_id[0] if scores[d] >= quality_model.THRESHOLD}
    hold = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(i in by_id[1]) == bool(dict((d, q) for d, q, _ in labels)[i]) for i in hold]) > 0.95

    want = brute.dedup_lines(rows[1])
    assert {d: r[1] for d, r in by_id[2].items()} == {d: v[0] for d, v in want.items()}
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in rows[2])

    want = brute.near_duplicates(rows[2])
    assert set(by_id[3]) == {d for d, (_, _, kept) in want.items() if kept}

    normal = [decontamination.normal(t) for _, t in items]
    clean = {
        d for d, r in by_id[3].items()
        if all(brute.edit_distance_in(i, decontamination.normal(r[1])) > len(i) // 20 for i in normal)
    }
    assert set(by_id[4]) == clean and len(clean) < len(by_id[3])

    n = check_packing(rows[4], current.collect(), 4096)
    total = sum(r.length for r in current.collect())
    assert n <= -(-total // 4096) + 1
