from chronoferry.operators.merge import merge_points
from chronoferry.operators.paging import explode_batches, fetch_page, number_rows, page_batches, page_index
from chronoferry.operators.points import explode_points, point_maps, rejected_rows, to_points
from chronoferry.operators.progress import milestones, slice_totals
from chronoferry.operators.ranges import TimeRange, find_range, in_range, range_frame
from chronoferry.operators.slices import slice_counts, time_slices, with_slice

__all__ = [
    "TimeRange",
    "explode_batches",
    "explode_points",
    "fetch_page",
    "find_range",
    "in_range",
    "merge_points",
    "milestones",
    "number_rows",
    "page_batches",
    "page_index",
    "point_maps",
    "range_frame",
    "rejected_rows",
    "slice_counts",
    "slice_totals",
    "time_slices",
    "to_points",
    "with_slice",
]
