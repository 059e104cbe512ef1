from recurra.functions.calendar import month_start, next_billing_date, not_after_day
from recurra.functions.decode import (decode_decimal, decode_epoch_date, decode_flag,
                                      decode_timestamp, encode_decimal_base64,
                                      encode_epoch_date, encode_epoch_millis)
from recurra.functions.numeric import relative_gap, safe_divide, threshold_status
from recurra.functions.text import money_text, padded_id, percent_text

__all__ = [
    "month_start", "next_billing_date", "not_after_day",
    "decode_decimal", "decode_epoch_date", "decode_flag", "decode_timestamp",
    "encode_decimal_base64", "encode_epoch_date", "encode_epoch_millis",
    "relative_gap", "safe_divide", "threshold_status",
    "money_text", "padded_id", "percent_text",
]
