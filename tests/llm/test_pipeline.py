"""The pipeline's stages on planted documents and on odd rows."""

import random

import pytest

import corpus_pipeline
from snapmart.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The given documents and labels with planted ones; ids from 10**6 on."""
    root = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(8)
    given = "/root/testdata/sf0.1"
    words = [w for r in table(spark, given, "documents").where("lang = 'en'").limit(200).collect() for w in r.text.split()]
    words = [w for w in words if w.isalpha() and w.islower()]
    clean = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    toxic = [" ".join(rng.choices([*words, *["idiot", "scum", "moron", "trash"] * (len(words) // 20)], k=120)) for _ in range(6)]
    near = [" ".join([*clean[0].split()[:-1], f"end{i}"]) for i in range(30)]
    junk = [" ".join(w + "&&&" for w in rng.choices(words, k=120)), None, "", "short"]
    private = [clean[1] + " write a.b@mail.example.com or 4111 1111 1111 1111"]
    texts = clean + toxic + near + [clean[2]] * 20 + junk + private
    rows = [(10**6 + i, t, "en", None, None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = table(spark, given, "documents").where("doc_id % 4 = 1").unionByName(spark.createDataFrame(rows, SCHEMA))
    docs.write.parquet(f"{root}/documents.parquet")
    table(spark, given, "labels").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages_take_effect(spark, folder):
    docs = table(spark, folder, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes
        docs = corpus_pipeline.written(out, name)
        kept[name] = {r.doc_id - 10**6: r.text for r in docs.where("doc_id >= 1000000").collect()}
    clean, toxic, near, copies, junk, private = range(12), range(12, 18), range(18, 48), range(48, 68), range(68, 72), 72
    assert {*clean, *toxic, *near, *copies, private} == set(kept["quality_rules"]) and not set(junk) & set(kept["quality_rules"])
    assert set(kept["toxicity_ftrl"]) == {*clean, *near, *copies, private}
    assert set(kept["jaccard_join"]) == set(clean)
    assert set(kept["pii_crf"]) == set(clean)
    packed = corpus_pipeline.packing_stage(spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_personal_data_is_replaced(spark, folder):
    docs = table(spark, folder, "documents").where("doc_id = 1000072")
    row = corpus_pipeline.personal_data_stage(spark, docs, folder).first()
    assert row.text.endswith("write [EMAIL] or [CARD]") and row.n_chars == len(row.text)


def test_empty_table_runs_through(spark, folder, tmp_path):
    table(spark, folder, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, folder, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
