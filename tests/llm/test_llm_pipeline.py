import random

import corpus_pipeline as pipe
import pytest
from llm_fixtures import frame, prose
from test_llm_filters import plain_spans, similarity, windows_of
from test_llm_near_duplicates import brute, edited

from ballotlens.llm import common as C
from ballotlens.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables with planted cases, and the documents' rows."""
    rng = random.Random(21)
    rows = [(i, prose(rng, rng.randint(30, 200))) for i in range(150)]
    labels = [(i, 0) for i in range(150)]
    for i in range(200, 300):
        w = prose(rng, rng.randint(20, 120)).split()
        for _ in range(3):
            w.insert(rng.randrange(len(w)), "grum" + prose(rng, 1))
        rows.append((i, " ".join(w)))
        labels.append((i, 1))
    for k in range(5):
        text = prose(rng, 150)
        rows += [(400 + 10 * k + j, edited(rng, text, j)) for j in range(5)]
    items = [(k, prose(rng, 30)) for k in range(4)]
    rows += [(500 + k, f"{prose(rng, 40)} {t} {prose(rng, 40)}") for k, t in items]
    rows += [(600 + k, f"{prose(rng, 40)} me{k}@mail.example.org {prose(rng, 40)}") for k in range(5)]
    rows += [(700, None), (701, ""), (None, prose(rng, 50)), (None, None), (702, prose(rng, 8000))]
    rows += [(None, rows[-3][1]), (5, rows[5][1])]
    path = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark, corpus, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 150)
    path, rows, items = corpus
    docs = C.documents(spark, path)
    stages = dict(pipe.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]

    clean = stages["toxicity"](spark, docs, path)
    gone = {r[0] for r in rows} - {r.doc_id for r in clean.collect()}
    assert len(gone & set(range(200, 300))) >= 95 and len(gone - set(range(200, 300))) <= 3
    assert clean.columns == docs.columns

    single = stages["near_duplicates"](spark, docs, path)
    component = brute(rows)
    got = pairs(single)
    assert sorted(i for i, _ in got if i is not None) == sorted(i for i, c in component.items() if i == c)
    assert [t for i, t in got if i is None] == [t for t in dict.fromkeys(t for i, t in rows if i is None)] or \
        sorted(str(t) for i, t in got if i is None) == sorted({str(t) for i, t in rows if i is None})
    assert single.columns == docs.columns

    fresh = stages["decontamination"](spark, docs, path)
    hit = lambda t: any(similarity(windows_of(t)[a:a + 30], windows_of(b)) >= 0.8
                        for _, b in items for a in range(max(1, len(windows_of(t)) - 29)))
    assert pairs(fresh) == sorted(((i, t) for i, t in rows if not hit(t)), key=str) and fresh.columns == docs.columns

    private = stages["personal_data"](spark, docs, path)
    texts = dict(rows)
    for r in private.collect():
        if r.doc_id is not None and not plain_spans(texts[r.doc_id] or ""):
            assert r.text == texts[r.doc_id]
        elif r.doc_id is not None:
            assert not plain_spans(r.text) and "[EMAIL]" in r.text and r.n_chars == len(r.text)
    assert private.count() == len(rows) and private.columns == docs.columns
    assert stages["packing"](spark, docs, path).filter("piece = 0").count() == len(rows)


def test_run_and_empty_tables(spark, corpus, monkeypatch, tmp_path):
    monkeypatch.setattr(toxicity, "STEPS", 30)
    path, rows, _ = corpus
    out = pipe.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipe.run(spark, str(tmp_path)).count() == 0
