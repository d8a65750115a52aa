from terrace.functions.casts import (is_reject, spark_type, stamp_to_timestamp,
                                     timestamp_to_stamp, typed, typed_projection)

__all__ = ["day_stamp", "is_reject", "spark_type", "stamp_to_timestamp",
           "timestamp_to_stamp", "typed", "typed_projection"]
