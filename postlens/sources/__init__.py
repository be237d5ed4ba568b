from .arrays import array_records
from .postings import corrupt_records, read_postings, training_extract
from .results import insights, read_result, write_result
from .shared import few_tasks, materialize, remove_tables, shared_dir, temporary_tables
from .versions import current_version, new_version, publish, remove_old_versions

__all__ = [
    "array_records",
    "corrupt_records",
    "current_version",
    "few_tasks",
    "insights",
    "materialize",
    "new_version",
    "publish",
    "read_postings",
    "read_result",
    "remove_old_versions",
    "remove_tables",
    "shared_dir",
    "temporary_tables",
    "training_extract",
    "write_result",
]
