from chronoferry.sources.endpoint import native_url
from chronoferry.sources.files import read_files, scan
from chronoferry.sources.jdbc import JdbcSource, find_jdbc_range, read_jdbc, slice_conditions

__all__ = ["JdbcSource", "find_jdbc_range", "native_url", "read_files", "read_jdbc", "scan", "slice_conditions"]
