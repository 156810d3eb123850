"""End-to-end plans, driver-table bindings and the query catalog."""
