from panelforge.functions.numeric import clip_keep_null, finite_or_null, log1p_or_null, safe_div
from panelforge.functions.rolling import (
    asset_window,
    forward_fill,
    lag,
    lead,
    rolling,
    rolling_mean,
    rolling_std,
    rolling_sum,
)
from panelforge.functions.ewm import ewm_mean
from panelforge.functions.windows import Rolled, rolling_columns

__all__ = [
    "Rolled",
    "asset_window",
    "clip_keep_null",
    "ewm_mean",
    "finite_or_null",
    "forward_fill",
    "lag",
    "lead",
    "log1p_or_null",
    "rolling",
    "rolling_columns",
    "rolling_mean",
    "rolling_std",
    "rolling_sum",
    "safe_div",
]
