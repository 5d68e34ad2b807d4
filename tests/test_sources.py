"""Saved artefacts in every layout, sampler caps against their SQL, first-n without moving text."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tokscope.sinks import files
from tokscope.sources import corpus, results

HEAD = ",".join(f.name for f in results.RESULTS_SCHEMA.fields)
LINE = "hin,Hindi,Devanagari,1,2,3,1.5,0.1,4.0,0.0,0.5,1.0,2.0,Good,written"


def test_results_as_plain_files_and_folders(spark, tmp_path):
    for name in ("results_alpha.csv", "results_org_results_model_7b.csv", "other.csv"):
        (tmp_path / name).write_text(f"{HEAD}\n{LINE}\n")
    (tmp_path / "results_folder").mkdir()
    (tmp_path / "results_folder" / "part-0.csv").write_text(f"{HEAD}\n{LINE}\n")
    got = results.load_results(spark, str(tmp_path)).collect()
    assert sorted(r.model for r in got) == ["alpha", "folder", "org_model_7b"]
    assert {r.fertility for r in got} == {1.5}


def test_no_results_is_an_error(spark, tmp_path):
    (tmp_path / "other.csv").write_text(HEAD + "\n")
    with pytest.raises(AnalysisException):
        results.load_results(spark, str(tmp_path)).collect()


def test_long_model_ids_stay_apart(spark, tmp_path):
    (tmp_path / "results_x.csv").write_text(f"{HEAD}\n{LINE}\n")
    row = results.load_results(spark, str(tmp_path))
    ids = ["an-organisation/a-tokenizer-with-many-sizes-7b", "an-organisation/a-tokenizer-with-many-sizes-70b"]
    both = row.withColumn("model", F.explode(F.array(*map(F.lit, ids))))
    files.write_results_csv(both, str(tmp_path / "out"))
    assert sorted(r.model for r in results.load_results(spark, str(tmp_path / "out")).collect()) == sorted(
        i.replace("/", "_").replace("-", "_") for i in ids)


@pytest.mark.parametrize("text", ['["a", "b\\"c", "\\u0915"]', '[\n  "a",\n  "b\\"c",\n  "\\u0915"\n]\n',
                                  '{"token": "a"}\n{"token": "b\\"c"}\n{"token": "\\u0915"}\n'])
def test_token_lists_as_array_and_as_lines(spark, tmp_path, text):
    (tmp_path / "list.json").write_text(text)
    assert [r.token for r in results.read_token_list_json(spark, str(tmp_path / "list.json")).collect()] == ["a", 'b"c', "\u0915"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "en" if i % 3 else "de", "x" * (i % 40)) for i in range(400)] + [(1000, None, "y" * 30), (1001, "fr", None)]
    return spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(5)


def brute(docs, cap, least, cap_first):
    out, n = set(), {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        keep = len((r.text or "").strip()) > least
        if cap_first or keep:
            n[r.lang] = n.get(r.lang, 0) + 1
        if keep and (cap is None or n[r.lang] <= cap):
            out.add(r.doc_id)
    return out


@pytest.mark.parametrize("cap", [1, 7, 150, 10_000, None])
def test_caps_above_and_below_the_rows(docs, cap):
    for fn, first in ((corpus.ingest_cap_before_filter, True), (corpus.ingest_cap_after_filter, False)):
        assert {r.doc_id for r in fn(docs, cap=cap).collect()} == brute(docs, cap, 20, first)


def test_first_n_moves_only_keys(docs):
    capped = corpus.first_n_per_group(docs, 7, "lang", "doc_id")
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    for cut in [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_part" in x]:
        assert "text" not in cut


def test_scans_keep_their_splits_by_default(spark):
    df = spark.range(100).repartition(3)
    was = spark.conf.get("spark.tokscope.scan.partitions", None)
    try:
        spark.conf.unset("spark.tokscope.scan.partitions")
        assert corpus.balanced(df) is df
    finally:
        if was:
            spark.conf.set("spark.tokscope.scan.partitions", was)


def test_cluster_sessions_need_a_shared_folder():
    from tokscope.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    session = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(session)
    assert os.environ is not None


def test_scratch_tables_can_be_removed(spark, monkeypatch):
    from tokscope import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    kept = session.materialised(spark.range(3), "drop-test")
    assert kept.count() == 3 and os.path.isdir(kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0])
    folder = kept.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert session.drop_scratch(spark) == 1 and not os.path.exists(folder)


def test_first_n_spreads_a_hot_group(spark):
    """All rows of one language, with nulls beside it: the join with the cutoff deals them to many tasks, not to the language's one."""
    rows = spark.range(0, 4000).select(F.when(F.col("id") % 50 == 0, None).otherwise("hot").alias("lang"), F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = corpus.first_n_per_group(rows, 3000, "lang", "doc_id").select("lang", "doc_id", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    first = [i for i in range(4000) if i % 50][:3000]
    assert sorted(r.doc_id for r in got) == sorted(first + list(range(0, 4000, 50)))
    tasks = [r.task for r in got if r.lang]
    assert max(tasks.count(t) for t in set(tasks)) < 1500
