"""Generic DataFrame operators: keys, columns, bands and limits are arguments."""
