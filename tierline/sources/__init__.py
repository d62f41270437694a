from tierline.sources.catalog import (
    count_tables,
    create_layers,
    list_layer,
    publish_table,
    register_table,
)
from tierline.sources.csv import ingest_raw, malformed_lines
from tierline.sources.files import (
    append_load,
    layer_path,
    read_footers,
    read_loads,
    read_table,
    write_table,
)
from tierline.sources.versions import (
    current_path,
    current_version,
    drop_versions,
    new_version,
    publish,
    version_path,
    versions,
)

__all__ = [
    "append_load",
    "count_tables",
    "create_layers",
    "current_path",
    "current_version",
    "drop_versions",
    "ingest_raw",
    "layer_path",
    "list_layer",
    "malformed_lines",
    "new_version",
    "publish",
    "publish_table",
    "read_footers",
    "read_loads",
    "read_table",
    "register_table",
    "version_path",
    "versions",
    "write_table",
]
