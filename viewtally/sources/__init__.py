from .access_log import parse_access_log, split_ids
from .logs import scan_dim, scan_jdbc, scan_log
from .merge import merge_sources, project_whitelist
from .sinks import checkpoint_step, snapshot_day, write_day, write_day_jdbc

__all__ = [
    "checkpoint_step", "merge_sources", "parse_access_log", "project_whitelist",
    "scan_dim", "scan_jdbc", "scan_log", "snapshot_day", "split_ids",
    "write_day", "write_day_jdbc",
]
