from .streams import (event_stream, hourly_counts, run_available_now, sliding_demand, stream_features,  # noqa: F401
                      stream_history, stream_monitor)
