from .contract import violations
from .rates import half_even_percent, rate_or_zero
from .stages import count_if, stage_rank
from .useragent import classify, client_columns

__all__ = ["violations", "half_even_percent", "rate_or_zero", "count_if",
           "stage_rank", "classify", "client_columns"]
