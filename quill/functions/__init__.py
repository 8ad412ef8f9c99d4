"""Column-expression helpers: text masks, money, exact numbers, dates."""

from quill.functions.dates import (AS_OF, days_between, in_month, in_year, to_day,
                                   years_between)
from quill.functions.money import fixed2, grouped, money
from quill.functions.numeric import (cents, dec, from_units, mean_rounded, round0, round_ratio,
                                     trunc0, units)
from quill.functions.text import (concat0, day_de_month, full_name, has_word_starting,
                                  lit_concat, mail_domain, mask_id, month_name_es,
                                  national_id, title_case)

__all__ = [
    "AS_OF", "cents", "from_units", "units", "concat0", "day_de_month", "days_between", "dec", "fixed2",
    "full_name", "grouped", "has_word_starting", "in_month", "in_year", "lit_concat",
    "mail_domain", "mask_id", "mean_rounded", "money", "month_name_es", "national_id",
    "round0", "round_ratio", "title_case", "to_day", "trunc0", "years_between",
]
