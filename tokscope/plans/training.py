"""Training plan: corpus -> words -> BPE model, kept as a saved tokenizer under the shared checkpoint directory and loaded by
later queries, of this session or another that has the same folder."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from tokscope.operators import bpe, store
from tokscope.session import ensure_checkpoint_dir, input_key, remove
from tokscope.sources import corpus

FORMAT = 1      # of saved trainings; a new one does not find the old ones

#: models of this process by path
_MODELS: dict[str, bpe.BpeModel] = {}


def training_words(spark: SparkSession, sf_dir: str):
    """Training ingest (cap before filter, length > 20) over the Indic view,
    pre-tokenized, counted per model word."""
    docs = corpus.ingest_cap_before_filter(corpus.documents(spark, sf_dir, indic=True))
    return bpe.word_frequencies(docs)


def store_dir(spark: SparkSession) -> str:
    """The folder of saved tokenizers: directly under ``spark.checkpoint.dir``, which other applications share (the context's own
    checkpoint folder is a new one for each)."""
    own = ensure_checkpoint_dir(spark)
    return f"{(spark.conf.get('spark.checkpoint.dir', None) or own).rstrip('/')}/tokenizers"


def saved_tokenizer(spark: SparkSession, sf_dir: str, max_merges: int | None = None) -> str:
    """Path of the tokenizer trained on the table as it is now (its files, with sizes and times, name it); trained if it isn't there.
    The run's own tables lie beside it, so that a driver which is lost while training goes on from the last snapshot."""
    settings = {"format": FORMAT, "vocab_size": bpe.VOCAB_SIZE, "min_frequency": bpe.MIN_FREQUENCY, "max_merges": max_merges}
    files = input_key(spark, f"{sf_dir}/documents.parquet")[1]
    name = "bpe-" + hashlib.sha256(repr((files, sorted(settings.items(), key=str))).encode()).hexdigest()[:16]
    path = f"{store_dir(spark)}/{name}"
    if not store.is_saved(spark, path):
        model = bpe.train(training_words(spark, sf_dir), max_merges=max_merges, folder=f"{path}-run")
        store.save(model, store_dir(spark), name, settings)
        remove(spark, f"{path}-run")
    return path


def trained_model(spark: SparkSession, sf_dir: str, max_merges: int | None = None) -> bpe.BpeModel:
    """The model of the whole training: to the vocabulary size or the frequency floor of the trainer, unless ``max_merges`` is given."""
    path = saved_tokenizer(spark, sf_dir, max_merges)
    key = f"{spark.sparkContext.applicationId} {path}"
    if key not in _MODELS:
        _MODELS[key] = store.load(spark, path)
    return _MODELS[key]
