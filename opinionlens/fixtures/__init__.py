"""The given tables as posts, and every operator as a query over them."""
