"""Incremental skill extraction: new posting files -> (posting_id, skill) appends.

The batch preparation (J33) is stateless per posting, so as a stream it is a
plain ``readStream`` -> clean -> stream-static walk of the (broadcast,
size-checked) phrase trie, built once -> per-batch distinct -> parquet. A batch owns the
folder ``epoch=<id>`` and overwrites it, so a batch that is repeated after a failure
replaces its own output: readers see every posting once. The per-batch ``distinct``
needs no state because a posting's rows arrive in one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hirescope.operators.skills import build_lexicon, extract_skills, phrase_trie
from hirescope.plans.prepare import clean_postings


def start_skill_stream(spark: SparkSession, source_dir: str, schema: T.StructType, lexicon_raw: DataFrame,
                       out_dir: str, checkpoint_dir: str, fmt: str = "parquet", max_len: int = 4,
                       available_now: bool = False, negative: str = "drop") -> StreamingQuery:
    trie = phrase_trie(build_lexicon(lexicon_raw, 1, max_len))
    postings = spark.readStream.format(fmt).schema(schema).load(source_dir)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        clean = clean_postings(batch, negative)
        extract_skills(clean, trie).write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch_id}")

    w = postings.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
