"""k-mer counts over a stream of FASTA files: counts are of one contig each, so every micro-batch appends its own rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import kmers


def count_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, size: int = 5) -> StreamingQuery:
    """Reads new files of (contig, sequence) Parquet in a folder and appends (contig, kmer, n); a batch that is run again replaces its own rows."""
    stream = spark.readStream.schema("contig string, sequence string").parquet(folder)

    def append(rows: DataFrame, batch: int) -> None:
        kmers.count(rows, size).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
