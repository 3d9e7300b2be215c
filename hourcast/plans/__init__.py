from .ordering import coarse_block, with_row_index  # noqa: F401
from .halo import series_select  # noqa: F401
from .blocked import blocked_cumsum, blocked_fill, blocked_fill_both  # noqa: F401
