"""DataFrame operators between a message scan and a table write."""
