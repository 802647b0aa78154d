"""Business tables composed from the operators: staging, marts, forecasts, reorders."""
