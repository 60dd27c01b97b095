"""Column expressions (Column -> Column), all JVM-side built-ins."""

from .keys import NAMESPACE_OID, concat_key, md5_key, uuid5
from .numeric import percent, ratio, round_dec, safe_ratio
from .text import id_from_path, nan_to_null, null_tokens
from .time import epoch_to_ts, format_ts, parse_ts, shift_hours, ts_to_epoch

__all__ = [
    "NAMESPACE_OID", "concat_key", "md5_key", "uuid5",
    "percent", "ratio", "round_dec", "safe_ratio",
    "id_from_path", "nan_to_null", "null_tokens",
    "epoch_to_ts", "format_ts", "parse_ts", "shift_hours", "ts_to_epoch",
]
