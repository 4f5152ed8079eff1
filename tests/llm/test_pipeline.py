import numpy as np
from test_near_duplicates import classes_by_brute_force
from test_packing import ids_of
from test_personal_data import brute as personal
from test_winnowing import brute as contaminated

import corpus_pipeline as C


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_every_stage_against_brute_force(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    steps = [docs]
    for name, stage in C.STAGES:
        out = stage(spark, steps[-1], d)
        out.write.parquet(str(tmp_path / name))
        steps.append(spark.read.parquet(str(tmp_path / name)))
    for step in steps[1:-1]:
        assert step.columns == docs.columns and step.dtypes == docs.dtypes
    raw, spoken, single, clean, redacted = (by_id(s) for s in steps[:-1])
    gone = set(raw) - set(spoken)
    assert len(gone) <= 0.05 * len(raw)
    classes = classes_by_brute_force([(i, r["text"]) for i, r in spoken.items()])
    assert set(single) == set(classes.values())
    assert set(clean) == {i for i, r in single.items() if not contaminated(r["text"], items)[1]}
    assert set(redacted) == set(clean)
    for i, r in redacted.items():
        assert not personal(r["text"]) and r["n_chars"] == len(r["text"])
        if not personal(clean[i]["text"]):
            assert r["text"] == clean[i]["text"]
    pieces = {}
    for r in steps[-1].collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
    assert set(pieces) == set(redacted)
    for i, parts in pieces.items():
        assert sum((ids for _, ids in sorted(parts)), []) == ids_of(redacted[i]["text"])


def test_run_gives_the_last_stage(spark, docs_of, tmp_path):
    docs_of([(1, "the and that with this house", "en"), (2, None), (1, "the and that with this house", "en")]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "x y")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = C.run(spark, str(tmp_path)).collect()
    assert [r["doc_id"] for r in rows] == [1] and rows[0]["sequence_id"] == 0
