"""DataFrame -> DataFrame operators.  All lazy; none collects."""
