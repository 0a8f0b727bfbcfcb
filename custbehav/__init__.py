"""Customer-behaviour analytics on e-commerce events, as Spark DataFrame jobs."""

from custbehav.config import PipelineConfig

__all__ = ["PipelineConfig"]
