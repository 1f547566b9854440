from tablewright.plans.customer_orders import customer_order_summary, expected_summary
from tablewright.plans.load import load_and_verify

__all__ = ["customer_order_summary", "expected_summary", "load_and_verify"]
