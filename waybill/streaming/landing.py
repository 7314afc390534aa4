"""Checking extracts as their files arrive.

Materializing is a projection without state, so the batch expression runs
unchanged on a stream and needs no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.materializing import flag_rows
from ..plans.entities import EntitySpec
from ..sources.sinks import ACCEPTED


def materialize_stream(
    extracts: DataFrame,
    mapping: dict[str, str | None],
    entity: EntitySpec,
    path: str,
    checkpoint: str,
    dataset_id: str = "stream",
    order_col: str = "_ix",
    once: bool = True,
) -> StreamingQuery:
    """Append the checked rows of a text stream to ``path``, as the pipeline does.

    The stream needs an ``order_col`` of its own, such as an arrival time or a
    sequence number. ``once`` handles what is there and stops.
    """
    flagged = flag_rows(extracts, mapping, entity, dataset_id, order_col).withColumn(
        ACCEPTED, F.col("reject_reason").isNull()
    )
    writer = (
        flagged.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(ACCEPTED)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
