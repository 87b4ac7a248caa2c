"""learnmetrics: member and behaviour analytics for an online-learning site, on PySpark.

Batch ETL (JSON ingest with reject routing, wide member table, SCD-2 payment history,
head-count and top-N reports, behaviour-log cleaning, daily video users) and two
Structured Streaming jobs (new VIPs per day and region, repeat order-page visitors
who did not pay). Everything is DataFrame/SQL expressions; there are no Python UDFs.
"""

from learnmetrics.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
