"""The three jobs, put together from the operators."""
