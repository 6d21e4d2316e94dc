"""Stateless stages on a stream: the same functions, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from noria.operators.corpus import analysis_projection
from noria.operators.nouns import Tagger, extract_nouns


def stream_nouns(stream: DataFrame, tagger: Tagger, out: str, checkpoint: str, text_col: str = "abstract") -> StreamingQuery:
    """Nouns of every document of a stream, appended as Parquet; ends when what is there has been read."""
    found = extract_nouns(tagger.tag(analysis_projection(stream, "doc_id", text_col)))
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
