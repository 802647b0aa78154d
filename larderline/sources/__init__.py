"""Reading raw tables, deriving them from order data, and writing results."""
