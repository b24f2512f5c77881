from tidemark.plans.series import BAR_SERIES, Layout, SeriesSpec, layout, over_series

__all__ = ["BAR_SERIES", "Layout", "SeriesSpec", "layout", "over_series"]
