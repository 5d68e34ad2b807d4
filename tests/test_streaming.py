"""A file stream over several files, restarted from its checkpoint, equals the batch result."""

from pyspark.sql import functions as F

from tokscope.streaming import corpus_stream as cs


def test_restart_and_batch_equality(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.lit(w) for w in ("some", "longer", "text", "to", "keep")],
                                  F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, "de").otherwise("en").alias("lang"),
                                  F.lit("s").alias("source"), F.lit(1).cast("bigint").alias("n_chars"))
    half = docs.where("doc_id < 30")
    half.repartition(3).write.parquet(src)

    def run():
        stream = cs.cleaned_stream(cs.read_documents_stream(spark, src, max_files_per_trigger=1))
        cs.complete_to_table(cs.running_stats(stream), out, ck)
        return sorted(tuple(r) for r in cs.latest_table(spark, out).collect())

    batch = lambda d: sorted(tuple(r) for r in cs.running_stats(cs.cleaned_stream(d)).collect())
    assert run() == batch(half)
    assert run() == batch(half)                         # nothing new: the table stays
    docs.where("doc_id >= 30").repartition(2).write.mode("append").parquet(src)
    assert run() == batch(docs)


def _docs(spark, ids):
    return spark.createDataFrame([(i, f"document number {i} of the stream {'x' * (i % 5)}", "en" if i % 4 else "de", "s", 1) for i in ids],
                                 cs.DOCUMENTS_SCHEMA)


def test_cap_over_files_and_a_restart(spark, tmp_path):
    """Files arrive in the order of ids, one a micro-batch, some after a restart: the batch cap's rows, and no more."""
    from tokscope.sources import corpus
    from tokscope.streaming import caps
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for part in (range(0, 40), range(40, 80)):
        for a in range(part.start, part.stop, 20):
            _docs(spark, range(a, a + 20)).coalesce(1).write.mode("append").parquet(src)
        caps.ingest_capped(cs.read_documents_stream(spark, src, max_files_per_trigger=1), out, ck, cap=25, shards=4)
        want = corpus.ingest_cap_before_filter(_docs(spark, range(part.stop)), cap=25)
        assert sorted(map(tuple, caps.kept(spark, out).collect())) == sorted(map(tuple, want.collect()))
    taken = {r.lang: r.n for r in spark.read.parquet(f"{out}/taken/batch=3").collect()}
    assert taken == {"en": 25, "de": 20}
    caps.take_batch(_docs(spark, range(60, 80)), 3, out, 25)            # the last batch again
    assert {r.lang: r.n for r in spark.read.parquet(f"{out}/taken/batch=3").collect()} == taken
    state = spark.read.format("statestore").load(ck).selectExpr("key.lang", "key.shard").distinct().collect()
    assert len([r for r in state if r.lang == "en"]) > 1                # a language's documents are counted in several shards


def test_cap_after_the_filter(spark, tmp_path):
    from tokscope.sources import corpus
    from tokscope.streaming import caps
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    docs = _docs(spark, range(30)).withColumn("text", F.when(F.col("doc_id") % 2 == 0, "short").otherwise(F.concat(F.lit("  "), "text")))
    docs.coalesce(1).write.parquet(src)
    caps.ingest_capped(cs.read_documents_stream(spark, src), out, ck, cap=5, after_filter=True)
    assert sorted(map(tuple, caps.kept(spark, out).collect())) == sorted(map(tuple, corpus.ingest_cap_after_filter(docs, cap=5).collect()))


def test_frequency_table_of_a_stream(spark, tmp_path):
    """Batches, merges, a batch that runs again, documents taken back; training starts from the table."""
    from tokscope.operators import bpe, vocab
    from tokscope.streaming import frequencies as fr
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    docs = _docs(spark, range(60)).select("text")

    def same(want):
        return sorted(map(tuple, fr.table(spark, out).collect())) == sorted(map(tuple, want.select("token", "freq").collect()))

    _docs(spark, range(30)).repartition(3).write.parquet(src)
    stream = cs.read_documents_stream(spark, src, max_files_per_trigger=1).select("text")
    fr.keep_up_to_date(stream, out, ck, merge_every=2)
    _docs(spark, range(30, 60)).repartition(2).write.mode("append").parquet(src)
    fr.keep_up_to_date(stream, out, ck, merge_every=2)
    assert same(vocab.pretoken_frequencies(docs))
    assert fr._numbers(spark, f"{out}/merged") == [1, 3] and fr._numbers(spark, f"{out}/changes")[-1] == 4
    last = _docs(spark, range(1000, 1010)).select("text")
    fr.add_batch(last, 5, out, merge_every=100)
    fr.add_batch(last, 5, out, merge_every=100)                         # a batch that runs again
    fr.add_batch(last, 3, out, merge_every=100)                         # one that a merge holds already
    assert same(vocab.pretoken_frequencies(docs.unionByName(last)))
    fr.add_batch(last.withColumn("sign", F.lit(-1)), 6, out, merge_every=100)
    assert same(vocab.pretoken_frequencies(docs))
    a, b = bpe.words_of_pretokens(fr.table(spark, out)), bpe.word_frequencies(docs)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert bpe.train(a, max_merges=3).merge_list == bpe.train(b, max_merges=3).merge_list
