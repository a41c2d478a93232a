"""Storage efficiency: bytes of a table as compressed delimited text versus
Parquet (the landing format against the warehouse format)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (via the path's Hadoop filesystem)."""
    from ..sinks.paths import size_bytes
    return size_bytes(spark, path)


def storage_report(df: DataFrame, scratch: str, name: str = "table",
                   text_codec: str = "snappy", parquet_codec: str = "snappy") -> dict:
    spark = df.sparkSession
    text_path, pq_path = f"{scratch}/{name}_text", f"{scratch}/{name}_parquet"
    (df.write.mode("overwrite").option("sep", ",").option("quote", "")
       .option("compression", text_codec).csv(text_path))
    df.write.mode("overwrite").option("compression", parquet_codec).parquet(pq_path)
    text_b, pq_b = folder_bytes(spark, text_path), folder_bytes(spark, pq_path)
    return {"table": name, "rows": spark.read.parquet(pq_path).count(), "text_bytes": text_b,
            "parquet_bytes": pq_b, "ratio_pct": round(100.0 * text_b / pq_b, 1) if pq_b else None}
