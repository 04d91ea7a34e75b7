"""What stages hold beside the executor's heap: sizes of Arrow batches, copies of texts, arrays of a walk."""

import tracemalloc

import corpus_pipeline
from bisque.llm import common, op04_sentencepiece, op09_quality

SF = "/root/testdata/sf0.001"
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


def test_stages_of_workers_have_run_when_they_return(spark):
    """Whoever writes their results later, with the session's own batches, does not run the workers again."""
    docs, stages = common.table(spark, SF, "documents"), dict(corpus_pipeline.STAGES)
    for name in corpus_pipeline.WRITTEN:
        before = [spark.conf.get(k) for k in BATCH]
        out = stages[name](spark, docs, SF)
        assert "MapInArrow" not in out._jdf.queryExecution().toString(), name
        assert [spark.conf.get(k) for k in BATCH] == before


def test_small_batches_bound_rows_and_bytes(spark):
    long = spark.range(0, 60, 1, 1).selectExpr("repeat('x', 1000000) as text")

    def count(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    with common.small_batches(spark):
        sizes = [r.n for r in long.mapInArrow(count, "n long").collect()]
    assert sum(sizes) >= 60_000_000 and max(sizes) < 6_000_000


def test_a_kept_text_goes_to_the_worker_once(spark):
    docs = spark.createDataFrame([(1, "one line with words enough to stay. " * 9), (2, None), (3, "")], "doc_id long, text string")
    out = op09_quality.clean_lines(docs)
    assert "__text__" not in out._jdf.queryExecution().analyzed().toString()
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted((r.doc_id, r.text) for r in docs.collect())


def test_memory_of_new_segments_is_bounded():
    e = op04_sentencepiece.Encoder(op04_sentencepiece.Pieces(op04_sentencepiece.read_model()))
    letters = "abcdefghij"
    words = ["".join(letters[int(c)] for c in f"{i * 7919 % 10**8:08d}") for i in range(30_000)]
    e.encode(" ".join(words[:300]))
    tracemalloc.start()
    got = e.packed(" ".join(words))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45_000_000, peak
    assert e.decode(op04_sentencepiece.np.frombuffer(got, "i4").tolist()) == " ".join(words)
