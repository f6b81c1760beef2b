"""Sources and sinks."""

from cellwise.sources.files import (
    append_split, explode_records, load_model, payload_schema, read_csv, read_payloads, read_records,
    rejected_payloads,
    read_split, read_table, save_model, stamp,
)
from cellwise.sources.lineage import check_schema, dataset_fingerprint, schema_signature
from cellwise.sources.versions import appended_since, batch_versions

__all__ = [
    "append_split", "explode_records", "load_model", "payload_schema", "read_csv",
    "read_payloads", "read_records", "read_split", "rejected_payloads", "read_table", "save_model", "stamp", "check_schema",
    "dataset_fingerprint", "schema_signature", "appended_since", "batch_versions",
]
