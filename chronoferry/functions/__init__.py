from chronoferry.functions.columns import named, time_value
from chronoferry.functions.timestamps import epoch_ms, epoch_us, instant, parse_timestamp, timestamp_text

__all__ = ["epoch_ms", "epoch_us", "instant", "named", "parse_timestamp", "time_value", "timestamp_text"]
