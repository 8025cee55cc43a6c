"""DataFrame -> DataFrame operators (joins, grouping, windows, ordered operators)."""
