"""demandcast: weekly demand analytics on Spark.

Transactions and a consumer panel are linked on a keyed customer hash, the
panel is raked to population margins, transactions are rolled up to
SKU x region x week features, quantile forecasts are produced, blended,
looked up in batch and scored. Every operator is a DataFrame -> DataFrame
(or Column -> Column) function; nothing is collected to the driver except
scalars (iteration diagnostics of the raking loop).
"""

from demandcast.session import get_session, resolve_checkpoint_dir

__all__ = ["get_session", "resolve_checkpoint_dir"]
