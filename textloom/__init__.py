"""textloom: Spark-native text-corpus preparation and training-log analytics.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark SQL expressions, joins, aggregations, windows and
Structured Streaming.  Arrow-batched pandas code appears only where Spark has
no expression (Unicode NFD, per-word tokenizer helpers, unigram EM, LCS).
"""

from textloom.session import get_spark, checkpoint_dir, scratch_path  # noqa: F401

__version__ = "0.1.0"
