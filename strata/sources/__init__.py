"""Sources and sinks: typed CSV / JSON / parquet reads, checked ingest, layer folders and publication by manifest."""

from strata.sources.io import Checked, read_checked, read_table, write_table
from strata.sources.layers import LAYERS, layer_path, publish_layer, read_layer
from strata.sources.publication import Publication, manifest, retire

__all__ = ["LAYERS", "Checked", "Publication", "layer_path", "manifest", "publish_layer", "read_checked", "read_layer", "read_table", "retire", "write_table"]
