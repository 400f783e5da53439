"""DataFrame-to-DataFrame operators, grouped by the section of the inventory."""
