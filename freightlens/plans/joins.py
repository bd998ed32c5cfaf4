"""Joins of a fact with the provider and route dimensions.

No broadcast hint and no size check of our own: Catalyst broadcasts a side
that its statistics show to be below ``spark.sql.autoBroadcastJoinThreshold``
bytes, adaptive execution does so for a side that turns out small at run time,
and splits skewed partitions of a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dims(fact: DataFrame, providers: DataFrame | None = None, routes: DataFrame | None = None,
              how: str = "inner") -> DataFrame:
    """``fact ⋈ providers USING provider_id ⋈ routes USING route_id``.

    Inner joins drop NULL and unmatched keys, as in the reference.  Call it
    after aggregating the fact by ids whenever possible, so the label
    columns are attached to few rows.
    """
    out = fact
    if providers is not None:
        out = out.join(providers, "provider_id", how)
    if routes is not None:
        out = out.join(routes, "route_id", how)
    return out
