"""tokscope: corpus and tokenizer analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns); options are
keyword arguments. Heavy work stays inside Spark: scans, joins, grouping,
windows and shuffles. Python code runs on the driver only to build small,
size-bounded dimension tables (language metadata, code-point ranges, merge
lists) and inside tasks as Arrow-batched helpers where SQL cannot express
the semantics (BPE encode of unseen words).
"""

__version__ = "0.1.0"
