"""tessera: a Spark-native medallion engine for social-content analytics.

Bronze (raw NDJSON) -> silver (deduplicated posts, last write wins) -> gold
(enrichment results, dimensions, star-schema views, graph edges), written as
DataFrame operators that Catalyst plans and Spark distributes.
"""

__version__ = "0.1.0"
