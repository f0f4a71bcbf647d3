"""Observed and audited partitioned writes, tables, views, publishing, raw landing."""

from wattflow.sinks.files import land_raw, read_audit, write_audited, write_partitioned
from wattflow.sinks.tables import PublishRefused, create_view, ensure_namespace, materialize, publish

__all__ = ["PublishRefused", "create_view", "ensure_namespace", "land_raw", "materialize", "publish", "read_audit",
           "write_audited", "write_partitioned"]
