from .events import dirty_requests, hot_flow, order_flow, read_table

__all__ = ["dirty_requests", "hot_flow", "order_flow", "read_table"]
