"""Composed runs: the mart handle, run ledger and statistics, stepped loads,
the whole-mart refresh, operations by table name, fixtures and the registered
checks."""
