from chronoferry.streaming.copy import copy_to_endpoint, copy_to_files, run_to_end, start_stream, stream_files
from chronoferry.streaming.follow import append_growing, append_matches, follow_logs
from chronoferry.streaming.merge import copy_merged, merge_stream, merged_points
from chronoferry.streaming.progress import ProgressLines, with_progress
from chronoferry.streaming.split import copy_with_rejects, each_batch

__all__ = [
    "ProgressLines",
    "append_growing",
    "append_matches",
    "copy_merged",
    "copy_to_endpoint",
    "copy_to_files",
    "copy_with_rejects",
    "each_batch",
    "follow_logs",
    "merge_stream",
    "merged_points",
    "run_to_end",
    "start_stream",
    "stream_files",
    "with_progress",
]
