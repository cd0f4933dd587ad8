import corpus_pipeline
from tests.llm.helpers import awkward, empty
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_near_dup import brute as groups
from tests.llm.test_secrets import brute as found
from widelog.llm import decontaminate, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        if name != "source_mixing":
            assert out.columns == COLUMNS
        rows = out.collect()
        before, after = {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in rows}
        kept[name] = after
        if name == "quality_classifier":
            model = quality.trained(spark, small)
            good = {r["doc_id"] for r in quality.scored(docs, model).filter("__quality >= 0.3").collect()}
            assert set(after) == good and 0.6 * len(before) < len(after) < len(before)
        elif name == "near_duplicates":
            want = {i for i, (_, c) in groups({i: r["text"] for i, r in before.items()}).items() if c == i}
            assert set(after) == want and all(after[i] == before[i] for i in want)
        elif name == "benchmark_decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
            for i, r in before.items():
                n, hit, *_ = hits(r["text"], items)
                assert (i in after) == (hit <= 0.5 * n)
                if i in after:
                    left = hits(after[i]["text"], [])[0]
                    assert left == n - hit and (hit or after[i] == r)
        elif name == "secret_scans":
            assert set(after) == set(before)
            for i, r in before.items():
                assert (after[i]["text"] == r["text"]) == (not found(r["text"])) and not found(after[i]["text"])
                assert after[i]["n_chars"] == len(after[i]["text"])
        else:
            assert set(after) <= set(before) and out.columns == [*COLUMNS, "replica"]
        docs = spark.createDataFrame(rows, out.schema)


def test_run_is_the_stages_in_order(spark, small):
    docs = corpus_pipeline.run(spark, small)
    assert docs.columns == [*COLUMNS, "replica"] and docs.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_duplicates", "benchmark_decontamination", "secret_scans", "source_mixing"]


def test_awkward_and_empty_documents(spark, small):
    for docs in (awkward(spark).select(*COLUMNS), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, small).collect(), docs.schema if _ != "source_mixing" else None or stage(spark, docs, small).schema)
    assert docs.count() == 0


def test_mostly_benchmark_documents_leave():
    machine = decontaminate.SuffixAutomaton([("1", b"a b c d e f g h i j".split())])
    assert decontaminate.cut(b"a b c d e f g h i j k", machine, 0.5) is None
