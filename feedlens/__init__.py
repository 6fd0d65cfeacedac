"""feedlens: Spark-native analytics for paginated JSON event-pricing feeds.

Layers
------
sources/    scan and flatten feed pages; role views over the driver tables
functions/  column-expression helpers (offsets, keys, timestamps, rounding)
operators/  table builders, merges, data-quality suite, reports, scoring, KPIs
plans/      end-to-end batch pipeline and the registry of named queries
streaming/  incremental file-stream ingest (Structured Streaming)
"""

from feedlens.config import Params

__all__ = ["Params"]
