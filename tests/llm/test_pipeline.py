from __future__ import annotations

import random

import pytest
from brute import DOCUMENTS, near_components, odd_rows

import corpus_pipeline as P
from caremarts.llm import toxicity as X
from caremarts.llm.queries import vocabulary


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(12)
    text = lambda n: " ".join(f"w{rnd.randrange(4000)}" for _ in range(n))
    item = "the benchmark asks which of these answers is the right one and why"
    rows, labels = [], []
    for i in range(300):
        t = text(rnd.randint(20, 120))
        if i % 6 == 0:
            t += " vilething nastyone"
        labels.append((i, 1, int(i % 6 == 0)))
        rows.append((i, t))
    rows += [(400, rows[1][1]), (401, rows[1][1] + " extra"), (402, text(40) + " " + item + " " + text(20))]
    rows += [(403, text(30) + " password=hunter22 " + text(30)), (404, None), (405, ""), (406, "")]
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(full, DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_rows_that_stay_and_what_they_become(spark, sf_dir):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = X.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    left = {r.doc_id: r.text for r in X.score(docs, net).where("not toxic_flag").collect()}
    assert not any("vilething" in (t or "") for t in left.values()) and len(left) > 245
    left = {i: left[i] for i, (_, c) in near_components(left).items() if i == c}
    left.pop(402)
    left[403] = left[403].replace("password=hunter22", "[secret]")
    got = {r.doc_id: r for r in P.run(spark, sf_dir).collect()}
    assert got.keys() == left.keys() and not {400, 401} & got.keys()
    for i, t in left.items():
        assert got[i].ids == library.encode(t or "", add_special_tokens=False).ids, t


def test_stages_keep_the_columns_and_bear_odd_rows(spark, sf_dir):
    docs = odd_rows(spark).selectExpr("*", "1 as matches", "2 as Score")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} >= {None, 1, 2, 3, 4, 5, 7, 8}, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
    one = P.drop_near_duplicates(spark, docs, sf_dir).groupBy("doc_id").count()
    assert {r.doc_id: r["count"] for r in one.collect()}.get(7) == 1
    assert P.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
