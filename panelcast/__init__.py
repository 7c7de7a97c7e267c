"""panelcast: probabilistic demand forecasting on large daily panels, expressed as Spark DataFrame jobs.

Layout
------
``schema``     table schemas, quantile levels and the names used by every operator
``session``    session defaults, checkpointing, scratch locations, size-checked broadcast
``sources``    readers and writers
``functions``  column expressions (no shuffles)
``operators``  DataFrame -> DataFrame operators
``plans``      compositions: feature table, walk-forward validation, evaluation
"""

from panelcast.schema import PANEL, QUANTILES, Panel

__all__ = ["PANEL", "QUANTILES", "Panel"]
