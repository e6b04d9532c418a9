"""Copy directory trees between filesystems as Spark jobs.

A listing is a table, a copy plan is a join of two listings, and a copy is a
distributed stage that leaves one report row per file and directory.
"""

import sys

from pyspark import cloudpickle

# Executors get the task functions by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from treeferry.functions.paths import (  # noqa: E402
    EXCLUDE_PATTERNS,
    ancestor_dependencies,
    classify_file_type,
    dependent_copies,
    exclude_paths,
    is_directory,
    is_file,
    map_destination,
    qualify_path,
    uri_is_child,
)
from treeferry.operators.balance import (  # noqa: E402
    assign_batch_partition,
    balance_by_bytes,
    batch_index,
    batch_partition_offsets,
    route_batches,
)
from treeferry.operators.copying import (  # noqa: E402
    CopyFailed,
    create_directories,
    delete_paths,
    execute_copy,
    recover_copies,
)
from treeferry.operators.folders import expand_folder_ids, folder_ancestors, folder_dictionary, folder_paths
from treeferry.operators.planning import (  # noqa: E402
    compare_manifests,
    copy_plan,
    directories_of,
    distinct_copies,
    expand_copies,
    verify_lengths,
)
from treeferry.operators.reporting import (  # noqa: E402
    copy_report,
    manifest_summary,
    report_summary,
)
from treeferry.plans.copy_tree import copy_tree  # noqa: E402
from treeferry.sources.kept import keep_manifest, kept_manifest  # noqa: E402
from treeferry.sources.listing import list_tree, walk_tree  # noqa: E402
from treeferry.sources.manifests import (  # noqa: E402
    destination_manifest,
    source_manifest,
    to_destination_manifest,
    to_source_manifest,
    with_dependencies,
)

from treeferry.sources.tree_source import scan_tree  # noqa: E402

__all__ = [
    "EXCLUDE_PATTERNS",
    "CopyFailed",
    "ancestor_dependencies",
    "assign_batch_partition",
    "balance_by_bytes",
    "batch_index",
    "batch_partition_offsets",
    "classify_file_type",
    "compare_manifests",
    "copy_plan",
    "copy_report",
    "copy_tree",
    "create_directories",
    "delete_paths",
    "dependent_copies",
    "destination_manifest",
    "directories_of",
    "distinct_copies",
    "exclude_paths",
    "execute_copy",
    "expand_copies",
    "expand_folder_ids",
    "folder_ancestors",
    "folder_dictionary",
    "folder_paths",
    "is_directory",
    "is_file",
    "keep_manifest",
    "kept_manifest",
    "list_tree",
    "manifest_summary",
    "map_destination",
    "qualify_path",
    "recover_copies",
    "report_summary",
    "route_batches",
    "scan_tree",
    "source_manifest",
    "to_destination_manifest",
    "to_source_manifest",
    "uri_is_child",
    "verify_lengths",
    "walk_tree",
    "with_dependencies",
]
