from .files import extract_orders, run_metadata, write_raw_sidecar, write_records  # noqa: F401
