"""ledgerline: retail order-line quality, cleaning, star-schema marts and
per-series forecasting, expressed as ordinary Spark DataFrame plans."""

from ledgerline.config import PipelineConfig

__all__ = ["PipelineConfig"]
