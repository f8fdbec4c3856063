from abtest_spark.sources.layers import export_csv, layer_path, read_layer, write_layer
from abtest_spark.sources.raw import load_raw, raw_from_events, read_raw, read_table

__all__ = [
    "export_csv",
    "layer_path",
    "read_layer",
    "write_layer",
    "load_raw",
    "raw_from_events",
    "read_raw",
    "read_table",
]
