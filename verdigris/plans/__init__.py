"""Job compositions, and the registered queries with their reference SQL."""
