from gridstats.sinks.csv import require_absent, write_csv, write_monthly_report
from gridstats.sinks.points import write_point_lines, write_points
from gridstats.sinks.publish import publication, read_manifest
from gridstats.sinks.source import POINT_FORMAT, read_commits, read_lines, save_points

__all__ = [
    "POINT_FORMAT",
    "publication",
    "read_commits",
    "read_lines",
    "read_manifest",
    "require_absent",
    "save_points",
    "write_csv",
    "write_monthly_report",
    "write_point_lines",
    "write_points",
]
