from vitalgrid.sources.catalog import add_runs, create_catalog, register_functions
from vitalgrid.sources.ledger import entries, new_files
from vitalgrid.sources.readers import (
    LINE_FEEDS,
    LISTING,
    pick_input,
    read_feature_list,
    read_history,
    read_labelled,
    read_predictions,
    read_processed,
    read_rows,
    read_training,
    read_vitals,
)
from vitalgrid.sources.runs import manifests, recover, unfinished
from vitalgrid.sources.writers import (
    write_feature_list,
    write_labelled,
    write_predictions,
    write_processed,
    write_run,
)

__all__ = [
    "LINE_FEEDS",
    "LISTING",
    "add_runs",
    "create_catalog",
    "entries",
    "manifests",
    "new_files",
    "pick_input",
    "read_feature_list",
    "read_history",
    "read_labelled",
    "read_predictions",
    "read_processed",
    "read_rows",
    "read_training",
    "read_vitals",
    "recover",
    "register_functions",
    "unfinished",
    "write_feature_list",
    "write_labelled",
    "write_predictions",
    "write_processed",
    "write_run",
]
