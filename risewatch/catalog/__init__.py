"""Every operator as a named query over the given tables, with its SQL twin."""
