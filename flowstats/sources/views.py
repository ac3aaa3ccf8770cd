"""Temp views under the names the original SQL used, for users of `spark.sql`.

`http` and `tcp` are the records; `urls` is the per-(group, url) aggregate
that the original per-group queries selected from. Registering a view
stores only its plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowstats.operators import http as http_ops


def register_views(http: DataFrame | None = None, tcp: DataFrame | None = None) -> list[str]:
    """Register the given record frames (and `urls` for HTTP); returns the view names."""
    names = []
    if http is not None:
        http.createOrReplaceTempView("http")
        http_ops.url_totals(http).createOrReplaceTempView("urls")
        names += ["http", "urls"]
    if tcp is not None:
        tcp.createOrReplaceTempView("tcp")
        names.append("tcp")
    return names
