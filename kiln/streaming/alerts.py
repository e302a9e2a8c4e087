"""S3: score sensor rows on a stream with a saved pipeline and keep alerts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts(stream: DataFrame, pipeline_path: str, alert_value: float = 1.0) -> DataFrame:
    """Stateless: every row is transformed by the saved pipeline; rows predicted
    as ``alert_value`` are the alerts."""
    model = PipelineModel.load(pipeline_path)
    return model.transform(stream).filter(F.col("prediction") == alert_value)
