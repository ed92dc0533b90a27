"""Every operator as a query over the star tables, and its SQL counterpart."""
