from starloom.sources.delimited import read_delimited
from starloom.sources.diagnose import bad_delimited_lines, bad_json_lines, by_reason
from starloom.sources.figures import LoadFigures, within_lengths
from starloom.sources.json_files import load_json_paths, read_json_auto, read_json_paths
from starloom.sources.manifest import source_manifest
from starloom.sources.tables import (
    LoadSpec,
    create_tables,
    drop_tables,
    insert_into,
    load_append,
    load_tables,
    require,
    reset,
    use,
)

__all__ = [
    "LoadFigures",
    "LoadSpec",
    "bad_delimited_lines",
    "bad_json_lines",
    "by_reason",
    "create_tables",
    "drop_tables",
    "insert_into",
    "load_append",
    "load_json_paths",
    "load_tables",
    "read_delimited",
    "read_json_auto",
    "read_json_paths",
    "require",
    "reset",
    "source_manifest",
    "use",
    "within_lengths",
]
