"""The four forecasting jobs, put together from the operators."""
