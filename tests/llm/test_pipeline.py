"""The pipeline, stage by stage, against what each stage must do on its own input."""

import re

import corpus_pipeline
import pytest

from starkeel.llm import decontaminate, language_id, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage was given and what it kept."""
    out = tmp_path_factory.mktemp("pipeline")
    docs, tables = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(out / name))
        new = spark.read.parquet(str(out / name))
        tables.append((docs, new))
        docs = new
    return dict(zip((n for n, _ in corpus_pipeline.STAGES), tables, strict=True))


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_in_order(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "near_dedup", "decontamination", "bpe"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(kept[n][1].columns == columns for n in list(kept)[:-1])


def test_toxicity_stage(spark, kept):
    docs, new = kept["toxicity"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    expected = [r["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] < queries.TOXIC]
    assert ids(new) == sorted(expected)


def test_language_stage(kept):
    docs, new = kept["language_id"]
    scored = language_id.predict(docs, language_id.fit(docs)).collect()
    expected = [
        r["doc_id"] for r in scored if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_LANGUAGE_SHARE
    ]
    assert ids(new) == sorted(expected)


def test_near_dedup_stage(kept):
    docs, new = kept["near_dedup"]
    sets = {}
    for r in docs.collect():
        words = re.findall(r"[^\x20\t-\r]+", r["text"].translate({c: c + 32 for c in range(65, 91)}))
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                old, least = {group[a], group[b]}, min(group[a], group[b])
                group = {i: least if g in old else g for i, g in group.items()}
    assert ids(new) == sorted(set(group.values()))


def test_decontamination_stage(spark, kept):
    docs, new = kept["decontamination"]
    items = [decontaminate.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaking = {r["doc_id"] for r in docs.collect() if any(i in decontaminate.normal(r["text"]) for i in items)}
    gone = set(ids(docs)) - set(ids(new))
    assert leaking <= gone
    found = decontaminate.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert gone == {r["doc_id"] for r in found.collect()}


def test_bpe_stage_and_run(spark, kept):
    docs, new = kept["bpe"]
    assert ids(docs) == ids(new)
    assert corpus_pipeline.ORACLE_SQL is None
    run = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, run.select(*key).collect())) == sorted(map(tuple, new.select(*key).collect()))


def test_stages_on_empty_and_awkward_tables(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words here", "en", "s", 1), (3, "some words here", "en", "s", 1)]
    for name, data in (("none", []), ("few", rows)):
        root = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
        got = corpus_pipeline.run(spark, str(root)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == ([] if name == "none" else ["3", "None"])
