from ledgerlake.functions.casts import (nan_to_null, to_double, to_nullable_long,  # noqa: F401
                                        to_strict_long, to_truthy_bool, to_upper_string)
from ledgerlake.functions.dates import (day_name_padded, is_weekend, month_name_padded,  # noqa: F401
                                        month_shift, strict_timestamp, timestamp_text)
from ledgerlake.functions.numeric import (allocate_cents, div_round_half_up,  # noqa: F401
                                          ratio_or_null, round_half_up, safe_ratio, to_cents)
from ledgerlake.functions.text import (blank_to_null, clean_special, left,  # noqa: F401
                                       normalize_text, pg_concat, regex_extract_or_null,
                                       strict_concat, strip_whitespace, transliterate,
                                       trim_spaces, upper_trim)
