"""Every stage and the row helpers with columns named like the operators' own."""

from pyspark.sql import functions as F

import corpus_pipeline as C
from rankloom.llm import language_spans as L
from rankloom.llm import personal_data as P
from rankloom.llm.common import in_parts, rows_with, without_ids


def extra(docs):
    names = ["_slot", "_row", "_id", "_wanted", "_own", "_hash", "_clean", "_text_hash", "_doc", "spans", "base", "bands", "members", "text_key", "class_id", "marks", "key", "pos", "salt", "lang_pred", "score"]
    return docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})


def test_row_helpers_keep_columns(docs_of):
    docs = extra(docs_of([(i, f"text {i}") for i in range(6)] + [(None, "x")]))
    ids = docs_of([(2, ""), (None, "")]).select("doc_id")
    kept = rows_with(docs, ids).collect()
    assert sorted((r["doc_id"] or 0, r["_slot"]) for r in kept if r["doc_id"]) == [(2, "_slot2")] and len(kept) == 2
    rest = without_ids(docs, ids)
    assert rest.columns == docs.columns and sorted(r["_slot"] for r in rest.collect()) == [f"_slot{i}" for i in (0, 1, 3, 4, 5)]


def test_every_stage_keeps_columns(spark, docs_of, tmp_path):
    en, de = "the house and the garden that we have with some of the old things ", "das haus und der garten den wir haben mit vielen alten sachen "
    rows = [(i, f"{(en, de)[i % 2]} {'abcdefghij'[i] * 5} mail a{i}@example.com now", ("en", "de")[i % 2]) for i in range(10)] + [(20, None, "en")]
    docs = extra(docs_of(rows))
    spark.createDataFrame([(1, "nothing of this kind at all in here to be found anywhere")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for at, (name, stage) in enumerate(C.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert all(r["_slot"] == f"_slot{r['doc_id']}" and r["spans"] == f"spans{r['doc_id']}" for r in docs.collect())
    assert docs.count() > 0 and all("[EMAIL]" in r["text"] for r in docs.collect())
    C.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_redaction_without_a_length_column(docs_of):
    docs = docs_of([(1, "mail me@example.com")]).drop("n_chars")
    assert P.redacted(docs).collect()[0]["text"] == "mail [EMAIL]"


def test_signs_are_no_letters(docs_of):
    model = L.learn(docs_of([(i, "das haus und der garten", "de") for i in range(5)] + [(9, "the house and the garden", "en")]))
    ask = docs_of([(1, "²"), (2, "½ ① 12 _"), (3, "İSTANBUL und das haus the house and the garden of İ"), (4, "ª")])
    got = {r["doc_id"]: r for r in L.predictions(ask, model, ["doc_id"]).collect()}
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (1, 2)] == [("und", 0.0)] * 2 and got[4]["lang_pred"] != "und"
    assert got[3]["spans"][-1]["end"] == len("İSTANBUL und das haus the house and the garden of İ")
    assert len(L.words_in("İSTANBUL und")) == 2
    assert sorted(r["doc_id"] for r in L.accepted(ask, model).collect()) == [3, 4]


def test_parts_cover_a_column_once():
    import pyarrow as pa

    column = pa.array(["a" * n if n % 3 else None for n in range(50)] + ["b" * 1000])
    places = list(in_parts(column, 7, 100))
    assert places[0][0] == 0 and places[-1][1] == len(column) and all(a[1] == b[0] for a, b in zip(places, places[1:]))
    assert places[-1] == (50, 51)
    assert list(in_parts(pa.array([], pa.string()), 5)) == []
